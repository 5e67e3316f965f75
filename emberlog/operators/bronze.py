"""Bronze: topic log -> flat typed events, de-duplicated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import BRONZE_COLUMNS, MESSAGE_FIELDS, MESSAGE_SCHEMA, TOPIC_RAW
from ..sources.topics import records

# Parity key (the message's event_id) and the key the pipeline profile uses.
PARITY_KEYS = ("event_id",)
FULL_KEYS = ("device_id", "ts", "seq", "event_id")


# The survivor of a key: the first record by offset, then topic name, then
# partition (a record of a topic log is identified by the three).
SURVIVOR_ORDER = ("kafka_offset", "kafka_topic", "_partition")


def dedup_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the first row by the columns ``order``.

    ``row_number() = 1`` over the key: Catalyst plans a *partial* window
    group limit before the shuffle (each map task keeps only its best row
    per key), so a key holding a third of all rows is reduced inside every
    input task and only one row per task and key crosses the network.  The
    survivor does not depend on partitioning or row order; null keys form
    one group.  (No self-join: a join over the parser's deep projection
    lineage would make the optimizer push it down expression by expression.)
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def flatten(log: DataFrame, ingest_ts: Column | None = None,
            keep_partition: bool = False) -> DataFrame:
    """Decode the message (JSON or typed log) and flatten to the bronze columns."""
    d = records(log, MESSAGE_SCHEMA)
    ing = ingest_ts if ingest_ts is not None else F.current_timestamp()
    fields = [n for n, _ in MESSAGE_FIELDS if n != "ingested_at"]
    extra = [F.col("partition").alias("_partition")] if keep_partition else []
    return d.select(ing.cast("timestamp").alias("ingested_at"),
                    F.col("topic").alias("kafka_topic"),
                    F.col("offset").cast("long").alias("kafka_offset"),
                    *fields, *extra).select(*BRONZE_COLUMNS, *[e for e in
                                            (["_partition"] if keep_partition else [])])


def to_bronze(log: DataFrame, ingest_ts: Column | None = None,
              keys=PARITY_KEYS, topics=(TOPIC_RAW,)) -> DataFrame:
    """Topic log -> bronze rows (non-blank device_id, one row per key).

    Every event is on the raw topic, so that topic alone is read by default;
    ``topics=FIREWALL_TOPICS`` reads all and de-duplicates the copies.
    """
    flat = flatten(log.where(F.col("topic").isin(*topics)), ingest_ts, keep_partition=True)
    flat = flat.where(F.col("device_id").isNotNull() & (F.trim("device_id") != ""))
    if keys:
        flat = dedup_first(flat, keys, SURVIVOR_ORDER)
    return flat.drop("_partition")
