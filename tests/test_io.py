"""Sources/sinks: JSON topic log on parquet, CSV reader, streaming serving append."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from emberlog.operators.bronze import FULL_KEYS, to_bronze
from emberlog.operators.parse_net import parse_network_records, records_from_lines
from emberlog.operators.serving import load_table
from emberlog.plans import flows
from emberlog.session import shared_dir
from emberlog.sources.lines import read_network_csv
from emberlog.sources.topics import read_topics, write_topics
from emberlog.schemas import FIREWALL_TOPICS
from emberlog.plans import medallion
from emberlog.plans.registered import run_ts
from emberlog.sources.tables import overwrite_partitions, scan
from emberlog.streaming.ingest import merge_latest, read_latest, start_fanout, start_serving

SF = "/root/testdata/sf0.001"


def test_json_topic_log_roundtrip_equals_typed(spark):
    root = shared_dir(spark, "topics")
    write_topics(flows.batch_topic_log(spark, SF, json=True), root)
    log = read_topics(spark, FIREWALL_TOPICS, root)
    via_json = to_bronze(log, keys=FULL_KEYS).drop("ingested_at")
    typed = to_bronze(flows.batch_topic_log(spark, SF), keys=FULL_KEYS).drop("ingested_at")
    assert via_json.count() == typed.count() > 0
    assert via_json.exceptAll(typed).count() == 0


def test_malformed_json_dropped_in_bronze(spark):
    log = spark.createDataFrame([("fg_raw_all", 0, 1, "nope"),
                                 ("fg_raw_all", 0, 2, '{"device_id":"d","srcport":"x","event_id":"e"}')],
                                "topic string, partition int, offset long, value string")
    rows = to_bronze(log).collect()
    assert len(rows) == 1 and rows[0].srcport is None


def test_network_csv_reader(spark):
    root = shared_dir(spark, "netcsv")
    recs_lines = records_from_lines(flows.network_lines(spark, SF))
    # small fixture file (sf0.001): one header line first, as a device export
    body = [r.value for r in flows.network_lines(spark, SF).orderBy("line_no").collect()
            if not r.value.startswith("timestamp;")]
    os.makedirs(root + "/csv", exist_ok=True)
    with open(root + "/csv/export.csv", "w", encoding="utf-8") as f:
        f.write("timestamp;device_id;program;msg\n" + "\n".join(body) + "\n")
    recs_csv = read_network_csv(spark, root + "/csv")
    a = parse_network_records(recs_csv).drop("event_id").drop("ts")
    b = parse_network_records(recs_lines).drop("event_id").drop("ts")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_streaming_serving_append_equals_batch(spark):
    root = shared_dir(spark, "serving")
    write_topics(flows.rt_topic_log(spark, SF, json=True), root + "/topics")
    q = start_serving(spark, root + "/topics", "t_security", root + "/t_security",
                      root + "/chk", available_now=True, max_per_trigger=3)
    q.awaitTermination()
    streamed = spark.read.parquet(root + "/t_security").drop("ingested_at", "event_month")
    batch = load_table(flows.rt_topic_log(spark, SF), "t_security").drop("ingested_at")
    assert streamed.count() == batch.count() > 0
    # a time that cannot be read becomes "now", which differs between the two
    fixed = lambda df: df.where(F.col("ts") < "2025-01-01")
    assert fixed(streamed).exceptAll(fixed(batch)).count() == fixed(batch).exceptAll(fixed(streamed)).count() == 0
    assert set(os.listdir(root + "/t_security")) >= {"_spark_metadata"}
    assert all(".zstd." in f for d, _, names in os.walk(root + "/t_security") for f in names if f.endswith(".parquet"))


def test_line_files_equal_in_memory_lines(spark):
    from emberlog.operators.parse_batch import parse_batch_lines
    from emberlog.sources.lines import non_blank, read_lines
    root = shared_dir(spark, "lines")
    flows.firewall_lines(spark, SF).select("value").write.text(root + "/in")
    from_files = parse_batch_lines(non_blank(read_lines(spark, root + "/in"))).drop("ingested_at")
    in_memory = flows.batch_events(spark, SF).drop("ingested_at", "line_no")
    assert from_files.count() == in_memory.count() > 0
    assert from_files.exceptAll(in_memory).count() == 0


def test_views_queryable_with_sql(spark):
    from emberlog.operators.views import register_views
    from emberlog.plans.registered import run_ts
    tables = flows.serving_tables(spark, SF, run_ts())
    names = register_views(spark, tables)
    assert len(names) == 11
    n = spark.sql("SELECT count(*) FROM v_top_threat_ips").collect()[0][0]
    assert 0 < n <= 50
    assert spark.sql("SELECT sum(nb_events) FROM v_network_log_types").collect()[0][0] == \
        tables["t_network_logs"].count()


def test_encoded_log_is_not_decoded_in_its_own_plan(spark):
    with pytest.raises(ValueError, match="typed_log"):
        to_bronze(flows.batch_topic_log(spark, SF, json=True))


def test_streamed_batch_profile_feeds_bronze(spark):
    """A log that the fan-out wrote: lines keep their order, equal lines are told apart."""
    root = shared_dir(spark, "fanout")
    line = 'FG1;1;3;5;t;2024-01-01 00:00:00;p;"logid={} action=deny";{}'
    os.makedirs(root + "/in")
    for name, ids in (("a", [1, 2, 2, 3]), ("b", [4, 2])):
        with open(f"{root}/in/{name}.log", "w", encoding="utf-8") as f:
            f.write("\n".join(line.format(i, i) for i in ids) + "\n\n")
    start_fanout(spark, root + "/in", root + "/topics", root + "/chk", profile="batch", available_now=True).awaitTermination()
    log = read_topics(spark, FIREWALL_TOPICS, root + "/topics")
    raw = log.where("topic = 'fg_raw_all'")
    assert raw.count() == raw.select("partition", "offset").distinct().count() == 6
    got = to_bronze(log, keys=FULL_KEYS).orderBy("event_id").collect()
    assert [r.event_id for r in got] == ["1", "2", "3", "4"]
    assert [r.kafka_offset for r in got] == [0, 1, 3, 0]


def _devices(spark, *rows):
    t = lambda d: dt.datetime(2024, 1, d)
    return spark.createDataFrame([(d, p, "x", t(a), t(b), n) for d, p, a, b, n in rows],
                                 "device_id string, program string, tag string, first_seen timestamp, last_seen timestamp, total_events long")


def test_device_merge_survives_new_checkpoints_and_replays(spark):
    root = shared_dir(spark, "devices")
    rows = lambda: sorted((r.device_id, r.program) for r in read_latest(spark, root).collect())
    assert read_latest(spark, root) is None
    merge_latest(spark, _devices(spark, ("a", "p", 1, 1, 1)), root, 0, query="one")
    merge_latest(spark, _devices(spark, ("b", "p", 1, 1, 1), ("a", "q", 2, 2, 1)), root, 1, query="one")
    assert rows() == [("a", "q"), ("b", "p")]
    merge_latest(spark, _devices(spark, ("z", "p", 1, 1, 1)), root, 1, query="one")      # replay
    assert rows() == [("a", "q"), ("b", "p")]
    merge_latest(spark, _devices(spark, ("c", "p", 1, 1, 1), ("a", "old", 1, 1, 1)), root, 0, query="two")  # new checkpoint
    assert rows() == [("a", "q"), ("b", "p"), ("c", "p")]
    for n in range(1, 6):
        merge_latest(spark, _devices(spark, ("c", f"p{n}", 1, 1 + n, 1)), root, n, query="two")
    assert rows() == [("a", "q"), ("b", "p"), ("c", "p5")]
    # a batch rewrites the buckets it touches, and files that no commit names are removed
    assert len(glob.glob(f"{root}/v=*/bucket=*")) <= 5 and len(glob.glob(f"{root}/commits/*.json")) == 2


def test_device_merge_accumulates(spark):
    root = shared_dir(spark, "devices")
    merge_latest(spark, _devices(spark, ("a", "p", 3, 3, 1), ("a", "q", 4, 4, 1)), root, 0, accumulate=True, query="x")
    merge_latest(spark, _devices(spark, ("a", "r", 2, 2, 5)), root, 1, accumulate=True, query="x")
    r = read_latest(spark, root).collect()[0]
    assert (r.program, r.first_seen.day, r.last_seen.day, r.total_events) == ("q", 2, 4, 7)


def test_partition_writes_make_few_files(spark):
    root = shared_dir(spark, "files")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(20000).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("day"))
        overwrite_partitions(df.repartition(16, "id"), root + "/t", ["day"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(glob.glob(root + "/t/day=*/*.zstd.parquet")) <= 20
    assert scan(spark, root + "/t").count() == 20000


def test_medallion_days_counts_and_pruning(spark):
    root = shared_dir(spark, "medallion")
    log = flows.batch_topic_log(spark, SF, only=["fg_raw_all"])
    days = [F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp") for d in (1, 2)]
    first = medallion.run_medallion(spark, log, root, fallback=run_ts(), ingest_ts=days[0])
    silver = lambda: scan(spark, root + "/silver/fg_events_clean")
    n = silver().count()
    assert first.counts["fg_events_clean"] == n == first.counts["fg_events_raw"] > 0
    assert first.counts["fg_kpi_hourly"] == scan(spark, root + "/gold/fg_kpi_hourly").count()
    again = medallion.run_medallion(spark, log, root, fallback=run_ts(), ingest_ts=days[1])
    bronze = scan(spark, root + "/bronze/fg_events_raw")
    assert bronze.count() == 2 * first.counts["fg_events_raw"]
    assert again.counts["fg_events_clean"] == silver().count() == n
    day = silver().agg(F.min("event_date")).first()[0]
    rerun = medallion.run_medallion(spark, None, root, days=(day, day), fallback=run_ts())
    assert "fg_events_raw" not in rerun.counts and 0 < rerun.counts["fg_events_clean"] < n
    plan = medallion.silver_of_days(bronze, [day], FULL_KEYS, run_ts())._jdf.queryExecution().executedPlan().toString()
    scan_line = plan[plan.index("FileScan parquet"):]
    assert "event_date" in scan_line[scan_line.index("PartitionFilters"):scan_line.index("PushedFilters")]


def test_medallion_ranges_of_one_ingest_day(spark):
    root, whole = shared_dir(spark, "medallion"), shared_dir(spark, "medallion")
    log = flows.batch_topic_log(spark, SF, only=["fg_raw_all"])
    run = lambda to, **k: medallion.run_medallion(spark, log, to, fallback=run_ts(), ingest_ts=run_ts(), **k)
    stored = lambda to, table: sorted(map(str, scan(spark, f"{to}/{table}").collect()))
    run(whole)
    # Both ranges hold rows of one event day, so that the second could replace the first.
    day = medallion.with_partition(to_bronze(log, run_ts(), FULL_KEYS), "fg_events_raw", run_ts())[0].groupBy("event_date").agg(
        F.min("kafka_offset").alias("a"), F.max("kafka_offset").alias("b"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).first()
    middle = (day.a + day.b) // 2
    first, second = run(root, until=middle), run(root, since=middle)
    bronze = scan(spark, root + "/bronze/fg_events_raw")
    n = first.counts["fg_events_raw"] + second.counts["fg_events_raw"]
    assert first.counts["fg_events_raw"] > 0 < second.counts["fg_events_raw"] and bronze.count() == n
    for table in ("silver/fg_events_clean", "gold/fg_kpi_hourly", "gold/fg_device_inventory"):
        assert stored(root, table) == stored(whole, table), table
    run(root, since=middle)  # a range read again replaces itself
    run(root, until=middle - 1)  # and a smaller one with the same start takes nothing away
    assert scan(spark, root + "/bronze/fg_events_raw").where(F.col("offset_range") != f"start_{middle - 1}").count() == n
    assert stored(root, "silver/fg_events_clean") == stored(whole, "silver/fg_events_clean")


def _untimed_log(spark, keys=range(60)):
    """Events of one device; a third of them without a readable time."""
    rows = [("fg_raw_all", 0, k, f"d{k % 4}", "bad" if k % 3 == 0 else f"2024-01-{1 + k % 9:02d} 10:00:00", None if k % 6 else f"s{k}", None if k == 9 else f"e{k}", k) for k in keys]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, device_id string, ts string, seq string, event_id string, total_bytes long")


REPORTS = ("fg_kpi_hourly", "fg_device_inventory")
GOLD_FOLDERS = [f"gold/{t}" for t in REPORTS]


def _stored(spark, root, table, *drop):
    return sorted(map(str, scan(spark, f"{root}/{table}").drop(*drop).collect()))


@pytest.mark.parametrize("probes", [2048, 1])
def test_events_without_a_time_count_once_over_ingest_days(spark, monkeypatch, probes):
    from emberlog.plans import first_seen
    monkeypatch.setattr(first_seen, "PROBES", probes)
    once, root = shared_dir(spark, "medallion"), shared_dir(spark, "medallion")
    log, day = _untimed_log(spark), lambda n: F.lit(f"2024-03-0{n} 05:06:07").cast("timestamp")
    medallion.run_medallion(spark, log, once, ingest_ts=day(1), reports=REPORTS)
    medallion.run_medallion(spark, log, root, ingest_ts=day(1), reports=REPORTS)
    for n in (2, 3, 3):
        counts = medallion.run_medallion(spark, log, root, ingest_ts=day(n), reports=REPORTS).counts
        assert counts["fg_events_clean"] == 60
    medallion.run_medallion(spark, log, root, since=20, until=40, ingest_ts=day(4), reports=REPORTS)
    assert _stored(spark, root, "silver/fg_events_clean", "ingested_at") == _stored(spark, once, "silver/fg_events_clean", "ingested_at")
    for table in GOLD_FOLDERS:
        assert _stored(spark, root, table) == _stored(spark, once, table), table
    index = scan(spark, f"{root}/bronze/fg_first_seen")
    assert index.count() == index.select("key").distinct().count() == 20
    # An index entry of a later day is never the first: a new key of day 5 keeps its own time.
    more = _untimed_log(spark, range(55, 64))
    medallion.run_medallion(spark, more, root, ingest_ts=day(5), reports=REPORTS)
    firsts = {r.event_id: str(r.event_time) for r in scan(spark, f"{root}/silver/fg_events_clean").where("event_id in ('e57', 'e60', 'e63')").collect() if r.event_id in ("e57", "e60", "e63")}
    assert firsts == {"e57": "2024-03-01 05:06:07", "e60": "2024-03-05 05:06:07", "e63": "2024-03-05 05:06:07"}


def test_untimed_events_of_a_failed_run_are_placed_by_the_next(spark, monkeypatch):
    once, root = shared_dir(spark, "medallion"), shared_dir(spark, "medallion")
    log, day = _untimed_log(spark), lambda n: F.lit(f"2024-03-0{n} 05:06:07").cast("timestamp")
    medallion.run_medallion(spark, log, once, ingest_ts=day(1), reports=REPORTS)
    place = medallion._place_untimed

    def fail(*a):
        raise OSError("lost")

    monkeypatch.setattr(medallion, "_place_untimed", fail)
    with pytest.raises(OSError):
        medallion.run_medallion(spark, log, root, ingest_ts=day(1), reports=REPORTS)
    monkeypatch.setattr(medallion, "_place_untimed", place)
    medallion.run_medallion(spark, log.where("offset >= 30"), root, since=30, ingest_ts=day(2), reports=REPORTS)
    medallion.run_medallion(spark, None, root, days=("2024-01-01", "2024-03-02"), reports=REPORTS)
    for table in GOLD_FOLDERS:
        assert _stored(spark, root, table) == _stored(spark, once, table), table


def test_a_range_taken_again_with_fewer_days_leaves_none_behind(spark):
    root = shared_dir(spark, "medallion")
    day = F.lit("2024-03-01 05:06:07").cast("timestamp")
    medallion.run_medallion(spark, _untimed_log(spark), root, ingest_ts=day, reports=REPORTS)
    medallion.run_medallion(spark, _untimed_log(spark, [1, 2]), root, ingest_ts=day, reports=REPORTS)
    assert scan(spark, f"{root}/bronze/fg_events_raw").count() == 2
    assert scan(spark, f"{root}/silver/fg_events_clean").count() == 2
    assert medallion.run_medallion(spark, _untimed_log(spark), root, since=10 ** 9, ingest_ts=day, reports=REPORTS).counts == {"fg_events_raw": 0}


def test_the_index_is_read_by_bucket_and_hash(spark):
    from emberlog.plans import first_seen
    root = shared_dir(spark, "medallion")
    medallion.run_medallion(spark, _untimed_log(spark), root, ingest_ts=F.lit("2024-03-01").cast("timestamp"), reports=REPORTS)
    index = scan(spark, f"{root}/bronze/fg_first_seen", table="fg_first_seen")
    one = index.limit(1)
    plan = first_seen.probe(index, one)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")] and "key_hash" in plan[plan.index("PushedFilters"):plan.index("ReadSchema")]


def test_shared_folder_is_required_off_local_masters(spark):
    from emberlog import session

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]"})()

    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Cluster(), "x")


def test_tables_are_created_with_declared_columns(spark):
    from emberlog.operators.gold import GOLD
    from emberlog.schemas import table_schema
    from emberlog.sources.tables import PARTITIONS, create_statement, ensure_tables, with_partition
    root = shared_dir(spark, "tables")
    paths = ensure_tables(spark, root)
    assert ensure_tables(spark, root) == paths
    for table, path in paths.items():  # empty tables have their declared columns
        assert scan(spark, path, table=table).count() == 0
    silver = flows.silver(spark, SF, run_ts())
    made = {"fg_events_raw": flows.bronze(spark, SF), "fg_events_clean": silver} | {f"fg_{k}": fn(silver) for k, fn in GOLD.items()}
    for table in PARTITIONS:
        own, parts = with_partition(made[table], table, run_ts())
        declared = table_schema(table)
        assert [(f.name, f.dataType) for f in own.schema] == [(f.name, f.dataType) for f in declared], table
        statement = create_statement(f"gold.{table}", table, "iceberg")
        assert all(f"`{f.name}` {f.dataType.simpleString()}" in statement for f in declared)
        assert ("PARTITIONED BY" in statement) == bool(parts)
    assert "bucket(16, device_id)" in create_statement("silver.fg_events_clean", "fg_events_clean", "iceberg")
