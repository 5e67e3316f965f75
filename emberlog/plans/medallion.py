"""Three-stage batch job: topic log -> bronze -> silver -> gold tables.

Each stage writes its table (idempotent dynamic partition overwrite) and the
next stage re-reads it from storage, so the lineage is cut at every stage
and a lost executor only recomputes the current stage.  Row counts are taken
with ``observe`` during the write, bronze's from the footers of its files.

A run takes in an offset range of the log (all of it by default) under one
ingest time and rebuilds only the event days that came in: silver reads these
days from bronze, whatever ingest day they lie under, and keeps one row per
key across ingest days and ranges, so records read twice do not count twice.
Each range is its own bronze partition: the same range again on one ingest day
replaces itself, and any other range leaves its rows alone.  (Without ``keys``
nothing is de-duplicated, so ranges that overlap count their rows twice.)
Events without a readable time belong to the day they first came in; they lie
in a part of their own of each range (``~untimed``), placed by ``first_seen``.  ``days``
(X2) rebuilds a range of event days from stored bronze and reads no log.
Tables that span all history (device inventory, top threat IPs, policy
traffic) are kept up by event day: a run stores the mergeable states of the
days it touched (``operators.states``) and puts the states of all days
together, so untouched days of silver are not read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import gold as G
from ..operators.bronze import FULL_KEYS, dedup_first, to_bronze
from ..operators.silver import to_silver
from ..schemas import TOPIC_RAW, table_schema
from ..sources.tables import (ALL_OFFSETS, INDEX, INDEX_PARTITIONS, NULL_PARTITION, PARTITIONS, add_partition, drop_partition, ensure_tables, overwrite_partitions,
                              partition_values, scan, with_partition)
from ..sources.topics import read_topics
from . import first_seen

GOLD_TABLES = {
    "fg_kpi_hourly": G.gold_kpi_hourly,
    "fg_device_inventory": G.gold_device_inventory,
    "fg_top_threat_ips": G.gold_top_threat_ips,
    "fg_sdwan_performance": G.gold_sdwan_performance,
    "fg_policy_traffic": G.gold_policy_traffic,
    "fg_protocol_stats": G.gold_protocol_stats,
}
# Marks the part of an offset range that holds its events without a time.
UNTIMED = "~untimed"
# Reports by event day, and which silver rows give one a row at all.
DAY_SCOPED = {"fg_kpi_hourly": "true", "fg_sdwan_performance": "latency > 0", "fg_protocol_stats": "true"}


# Reports over all history, as states by event day.
ALL_HISTORY = {"fg_device_inventory": G.DEVICE_INVENTORY, "fg_top_threat_ips": G.TOP_THREAT_IPS, "fg_policy_traffic": G.POLICY_TRAFFIC}


@dataclass
class StageReport:
    counts: dict[str, int] = field(default_factory=dict)

    def __str__(self) -> str:
        return ", ".join(f"{k}={v}" for k, v in self.counts.items())


def _write_counted(df: DataFrame, name: str, path: str, parts: list[str],
                   report: StageReport, fmt: str) -> None:
    obs = Observation(name)
    overwrite_partitions(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, parts, fmt)
    report.counts[name] = int(obs.get["rows"])


def _in_days(df: DataFrame, days: list[dt.date]) -> DataFrame:
    """Rows of these event days: a filter on a partition column, so other files are not read."""
    return df.where(F.col("event_date").isin(days))


def silver_of_days(bronze: DataFrame, days: list[dt.date], keys, fallback) -> DataFrame:
    """Silver rows of some event days, one per key over all ingest days."""
    rows = _in_days(bronze, days)
    if keys:
        rows = dedup_first(rows, keys, ["kafka_offset", "kafka_topic", "ingested_at"])
    return to_silver(rows.drop("ingest_date", "offset_range", "event_date"), fallback)


def offset_range(since: int | None, until: int | None) -> str:
    """The name of an offset range as a partition value."""
    if since is None and until is None:
        return ALL_OFFSETS
    return f"{'start' if since is None else since}_{'end' if until is None else until}"


def _range_folder(paths, today: dt.date, offsets: str) -> str:
    return f"{paths['fg_events_raw']}/ingest_date={today}/offset_range={offsets}"


def _dates(values) -> set[dt.date]:
    return {dt.date.fromisoformat(v) for v in values if v != NULL_PARTITION}


def _replace_range(spark, rows: DataFrame, paths, today, offsets: str, fmt) -> tuple[int, set[dt.date]]:
    """Write one offset range of bronze; returns its rows and the event days that it has or had.

    What the range held goes first, so a range that is taken again with fewer
    days leaves nothing behind.  (A run that fails here is repeated from the log.)
    """
    folder = _range_folder(paths, today, offsets)
    before = set()
    if fmt == "parquet":
        before = _dates(partition_values(spark, folder))
        drop_partition(spark, folder)
    overwrite_partitions(rows, paths["fg_events_raw"], list(PARTITIONS["fg_events_raw"]), fmt)
    # No column is read, so these counts come from the files' footers: one row for each day.
    counts = {r["event_date"]: r["count"] for r in scan(spark, paths["fg_events_raw"], fmt, "fg_events_raw").where(
        (F.col("ingest_date") == F.lit(today)) & (F.col("offset_range") == offsets)).groupBy("event_date").count().collect()}
    return sum(counts.values()), before | {day for day in counts if day}


def _place_untimed(spark, paths, today: dt.date, offsets: str, keys, fmt) -> set[dt.date]:
    """Move the events without a time of a range from bronze's null day to the day each was first seen on.

    The entries of the index come first: they leave out what other runs wrote,
    so the whole step can be repeated after a failure at any place.
    """
    staged = scan(spark, paths["fg_events_raw"], fmt, "fg_events_raw").where(
        (F.col("ingest_date") == F.lit(today)) & (F.col("offset_range") == offsets) & F.col("event_date").isNull())
    index = scan(spark, paths[INDEX], fmt, INDEX).where(
        ~((F.col("ingest_date") == F.lit(today)) & (F.col("offset_range") == offsets)))
    with first_seen.long_in_lists(spark):
        placed = first_seen.with_first_seen(staged, index, keys)
        overwrite_partitions(first_seen.entries(placed.where(~F.col("known")), keys), paths[INDEX], INDEX_PARTITIONS, fmt,
                             options=first_seen.write_options)
        rows = placed.drop("known").withColumns({"offset_range": F.lit(offsets + UNTIMED), "event_date": F.to_date("first_seen")})
        names = scan(spark, paths["fg_events_raw"], fmt, "fg_events_raw").columns
        _, days = _replace_range(spark, rows.select(*names), paths, today, offsets + UNTIMED, fmt)
    drop_partition(spark, f"{_range_folder(paths, today, offsets)}/event_date={NULL_PARTITION}")
    return days


def _unfinished(spark, paths) -> list[tuple[dt.date, str]]:
    """Ranges whose events without a time still wait in the null day (of a run that failed)."""
    root = paths["fg_events_raw"]
    return [(dt.date.fromisoformat(day), offsets) for day in partition_values(spark, root)
            for offsets in partition_values(spark, f"{root}/ingest_date={day}")
            if NULL_PARTITION in partition_values(spark, f"{root}/ingest_date={day}/offset_range={offsets}")]


def _take_in(spark, topic_log, paths, since, until, ingest_ts, fallback, keys, topics, report, fmt) -> list[dt.date]:
    """Write bronze; returns the event days that came in (one row per day on the driver)."""
    if isinstance(topic_log, str):  # a stored log: only files that hold the range are opened
        log = read_topics(spark, list(topics), topic_log, since=since, until=until)
    else:
        log = topic_log
        if since is not None:
            log = log.where(F.col("offset") >= since)
        if until is not None:
            log = log.where(F.col("offset") < until)
    rows = to_bronze(log, ingest_ts=ingest_ts, keys=keys, topics=topics).withColumn("first_seen", F.lit(None).cast("timestamp"))
    today = spark.range(1).select(F.to_date(ingest_ts)).first()[0]
    offsets = offset_range(since, until)
    indexed = fallback is None and bool(keys) and fmt == "parquet"
    days: set[dt.date] = set()
    if indexed:
        for day, left in _unfinished(spark, paths):
            days |= _place_untimed(spark, paths, day, left, keys, fmt)
    bronze, _ = with_partition(rows, "fg_events_raw", F.lit(None).cast("timestamp") if indexed else _arrival(fallback), offsets)
    report.counts["fg_events_raw"], came = _replace_range(spark, bronze, paths, today, offsets, fmt)
    if indexed:
        days |= _place_untimed(spark, paths, today, offsets, keys, fmt)
    return sorted(days | came)


def _arrival(fallback):
    """The time of an event without a readable one."""
    return F.coalesce("first_seen", "ingested_at") if fallback is None else fallback


def run_medallion(spark: SparkSession, topic_log: DataFrame | str | None, root: str,
                  days=None, since: int | None = None, until: int | None = None,
                  fallback=None, keys=FULL_KEYS, fmt: str = "parquet",
                  ingest_ts=None, topics=(TOPIC_RAW,), reports=tuple(GOLD_TABLES)) -> StageReport:
    """Run bronze, silver and gold; return per-table row counts.

    ``topic_log``: a DataFrame, or the path of a stored log.  ``since`` /
    ``until``: offsets taken from the log.  ``days``: (first, last)
    event day to rebuild instead.  ``reports``: the gold tables to build.  ``fallback``: time of events without a
    readable one (default: when they first came in, as the first-seen index
    knows it, so that reading them again on another day counts them once).
    """
    paths = ensure_tables(spark, root, fmt=fmt)
    report = StageReport()
    # One instant for the whole run: a run over midnight is one ingest day.
    if ingest_ts is None:
        ingest_ts = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    if days:
        first, last = (dt.date.fromisoformat(str(d)) for d in days)
        touched = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
    else:
        touched = _take_in(spark, topic_log, paths, since, until, ingest_ts, fallback, keys, topics, report, fmt)
    if not touched:
        return report

    silver = silver_of_days(scan(spark, paths["fg_events_raw"], fmt, "fg_events_raw"), touched, keys, _arrival(fallback))
    silver, parts = with_partition(silver, "fg_events_clean")
    # A day that lost its last bronze row is not in what is written, so it is removed.
    held = scan(spark, paths["fg_events_raw"], fmt, "fg_events_raw")
    _drop_days(spark, paths, "fg_events_clean", touched, held, fmt)
    _write_counted(silver, "fg_events_clean", paths["fg_events_clean"], parts, report, fmt)

    stored = scan(spark, paths["fg_events_clean"], fmt, "fg_events_clean")
    for table in reports:
        fn = GOLD_TABLES[table]
        if table in ALL_HISTORY and fmt == "parquet":
            out = history_of(spark, paths, table, touched)
            _write_counted(out, table, paths[table], [], report, fmt)
            continue
        src = _in_days(stored, touched) if table in DAY_SCOPED else stored
        out, parts = with_partition(fn(src.drop("event_date")), table)
        if table in DAY_SCOPED:
            _drop_days(spark, paths, table, touched, stored.where(DAY_SCOPED[table]), fmt)
        _write_counted(out, table, paths[table], parts, report, fmt)
    return report


def _states_folder(paths, table: str) -> str:
    return f"{paths[table]}_states"


def store_states(spark, paths, table: str, touched: list[dt.date]) -> None:
    """Write the states of ``touched`` days, and of silver days that have none yet; a day's states replace its former ones."""
    folder, report = _states_folder(paths, table), ALL_HISTORY[table]
    silver = scan(spark, paths["fg_events_clean"], table="fg_events_clean")
    held = _dates(partition_values(spark, folder))
    missing = _dates(partition_values(spark, paths["fg_events_clean"])) - held
    days = sorted(missing | set(touched))
    for day in held & set(touched):
        drop_partition(spark, f"{folder}/event_date={day}")
    overwrite_partitions(report.partial(_in_days(silver, days), ("event_date",)), folder, ["event_date"])
    for day in days:
        add_partition(spark, f"{folder}/event_date={day}")


def history_of(spark, paths, table: str, touched: list[dt.date]) -> DataFrame:
    """A report over all history: the stored states of all days after those of ``touched`` are brought up to date."""
    store_states(spark, paths, table, touched)
    report = ALL_HISTORY[table]
    none = report.partial(spark.createDataFrame([], table_schema("fg_events_clean")), ("event_date",))
    states = spark.read.schema(none.schema).parquet(_states_folder(paths, table))
    return report.finish(report.merge(states))


def _drop_days(spark, paths, table: str, days: list[dt.date], source: DataFrame, fmt: str) -> None:
    """Remove those of ``days`` from a parquet table that it holds but ``source`` (with event_date) has no rows of."""
    if fmt != "parquet":
        return
    stored = _dates(partition_values(spark, paths[table])) & set(days)
    if not stored:
        return
    alive = {r[0] for r in _in_days(source, sorted(stored)).select("event_date").distinct().collect()}
    for day in stored - alive:
        drop_partition(spark, f"{paths[table]}/{next(iter(PARTITIONS[table]))}={day}")
