"""Serving-table loads: topic records -> typed rows of an append table.

Each load is a stateless projection per record (it works on a batch or a
streaming DataFrame alike): decode the JSON with the table's declared schema,
fill absent fields with ''/0, parse ``ts`` best-effort (else the fallback,
"now" by default), stamp the insert time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.timeparse import best_effort, best_effort_ts, fallback_ts, now
from ..schemas import (DEVICES_FIELDS, NETWORK_FIELDS, PERFORMANCE_FIELDS,
                       RAW_EVENTS_FIELDS, SECURITY_FIELDS, TOPIC_DEVICES,
                       TOPIC_NETWORK, TOPIC_PERFORMANCE, TOPIC_RAW,
                       TOPIC_SECURITY, TOPIC_TRAFFIC, TRAFFIC_FIELDS,
                       queue_schema)
from ..sources.topics import records

# table -> (topic, declared fields)
TABLES = {
    "t_security": (TOPIC_SECURITY, SECURITY_FIELDS),
    "t_traffic": (TOPIC_TRAFFIC, TRAFFIC_FIELDS),
    "t_performance": (TOPIC_PERFORMANCE, PERFORMANCE_FIELDS),
    "t_raw_events": (TOPIC_RAW, RAW_EVENTS_FIELDS),
    "t_network_logs": (TOPIC_NETWORK, NETWORK_FIELDS),
}


def _topic(log: DataFrame, topic: str) -> DataFrame:
    return log.where(F.col("topic") == topic) if "topic" in log.columns else log


def load_table(log: DataFrame, table: str, fallback=None,
               ingest_ts: Column | None = None, flag: bool = False) -> DataFrame:
    """Rows of ``table`` from its topic in ``log`` (topic-log rows).

    ``flag`` adds ``ts_fell_back``: the record's time was in no known shape.
    """
    topic, fields = TABLES[table]
    d = records(_topic(log, topic), queue_schema(fields), keep=())
    cols = []
    for name, typ in fields:
        c = F.col(name)
        if name == "ts":
            cols.append(best_effort_ts(c, fallback).alias(name))
        elif name == "ingested_at":
            cols.append((ingest_ts if ingest_ts is not None
                         else now()).cast("timestamp").alias(name))
        elif isinstance(typ, StringType):
            cols.append(F.coalesce(c, F.lit("")).alias(name))
        else:
            cols.append(F.coalesce(c, F.lit(0).cast(typ)).cast(typ).alias(name))
    if flag:
        cols.append(best_effort(F.col("ts")).isNull().alias("ts_fell_back"))
    return d.select(*cols)


def time_quality(log: DataFrame, table: str) -> DataFrame:
    """By device: records, and those whose time fell back to now."""
    rows = load_table(log, table, flag=True)
    return rows.groupBy("device_id").agg(F.count(F.lit(1)).alias("records"), F.count_if("ts_fell_back").alias("fell_back"))


def load_devices(log: DataFrame, seen_ts: Column | str | None = None,
                 fallback=None, ingest_ts: Column | None = None) -> DataFrame:
    """Device-inventory rows: first_seen = last_seen = seen time, count 1.

    ``seen_ts`` None stamps the insert time (the serving default); ``"event"``
    uses the event's own ``ts`` (best effort, else ``fallback``), which makes
    the latest-per-device result reproducible.
    """
    schema = queue_schema([("device_id", StringType()), ("program", StringType()),
                           ("tag", StringType()), ("ts", StringType()),
                           ("ingested_at", StringType())])
    d = records(_topic(log, TOPIC_DEVICES), schema, keep=())
    if seen_ts is None:
        seen = F.current_timestamp()
    elif isinstance(seen_ts, str) and seen_ts == "event":
        seen = best_effort_ts(F.col("ts"), fallback)
    else:
        seen = seen_ts
    dev = F.coalesce(F.col("device_id"), F.lit(""))
    ing = ingest_ts if ingest_ts is not None else F.current_timestamp()
    out = d.where(F.octet_length(dev) > 0).select(
        dev.alias("device_id"),
        F.coalesce(F.col("program"), F.lit("")).alias("program"),
        F.coalesce(F.col("tag"), F.lit("")).alias("tag"),
        seen.cast("timestamp").alias("first_seen"),
        seen.cast("timestamp").alias("last_seen"),
        F.lit(1).cast("long").alias("total_events"),
        ing.cast("timestamp").alias("ingested_at"),
    )
    return out.select(*[n for n, _ in DEVICES_FIELDS])


def month_partition(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Add the ``yyyyMM`` partition column used by the serving tables."""
    return df.withColumn("event_month", F.date_format(F.col(ts_col), "yyyyMM"))


__all__ = ["TABLES", "fallback_ts", "load_devices", "load_table", "month_partition"]
