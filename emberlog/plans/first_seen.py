"""First-seen index: when an event without a readable time came in first.

Such an event has no day of its own.  Its day is that of the run that read it
first, so a later run that reads it again has to find that run: the index holds
one entry per de-duplication key, with the time it was first taken in.  It is
partitioned by a bucket of the key's hash and by the run that wrote the entry
(ingest date and offset range, so a run that is repeated replaces its own
entries and does not see them).  Files are sorted by hash and carry Parquet
Bloom filters on it: a run with few such keys asks for their hashes, and row
groups whose filter lacks them all are not read; a run with many joins the
buckets that its keys fall into.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.silver import event_time

BUCKETS = 16
PROBES = 2048  # up to so many keys are asked for by hash, more are joined
IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"


def key_hash(keys) -> Column:
    return F.xxhash64(*keys)


def own_time() -> Column:
    """The event's time as the record states it, else null."""
    return event_time(F.lit(None).cast("timestamp"))


def entries(rows: DataFrame, keys) -> DataFrame:
    """``rows`` (keys, first_seen, ingest_date, offset_range) as index entries."""
    h = key_hash(keys)
    key = F.to_json(F.struct(*(F.col(k).alias(f"k{n}") for n, k in enumerate(keys))))
    return rows.select(h.alias("key_hash"), key.alias("key"), "first_seen", F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"), "ingest_date", "offset_range")


def write_options(writer):
    """A Bloom filter on the hash in every file."""
    return writer.option("parquet.bloom.filter.enabled#key_hash", "true").option("parquet.bloom.filter.adaptive.enabled", "true")


@contextmanager
def long_in_lists(spark: SparkSession) -> Iterator[None]:
    """Push lists of up to ``PROBES`` values to Parquet as they are, so that they meet the Bloom filters."""
    before = spark.conf.get(IN_LIST)
    spark.conf.set(IN_LIST, str(PROBES))
    try:
        yield
    finally:
        spark.conf.set(IN_LIST, before)


def probe(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The part of ``index`` that may hold the entries ``wanted`` (a bounded number of hashes or buckets passes the driver)."""
    hashes = [r[0] for r in wanted.select("key_hash").distinct().limit(PROBES + 1).collect()]
    if len(hashes) > PROBES:
        buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]
        return index.where(F.col("bucket").isin(buckets))
    return index.where(F.col("bucket").isin(sorted({h % BUCKETS for h in hashes})) & F.col("key_hash").isin(hashes))


def with_first_seen(rows: DataFrame, index: DataFrame, keys) -> DataFrame:
    """``rows`` with ``first_seen``: the earliest time that ``index`` knows of the key, or ``ingested_at``; ``known``: it was in the index."""
    wanted = entries(rows.withColumn("first_seen", F.col("ingested_at")), keys)
    earliest = probe(index, wanted).groupBy("key_hash", "key").agg(F.min("first_seen").alias("earliest"))
    key = F.to_json(F.struct(*(F.col(k).alias(f"k{n}") for n, k in enumerate(keys))))
    keyed = rows.drop("first_seen").withColumns({"key_hash": key_hash(keys), "key": key})
    return (keyed.join(earliest, ["key_hash", "key"], "left")
            .withColumn("known", F.col("earliest").isNotNull())
            .withColumn("first_seen", F.coalesce(F.least("earliest", "ingested_at"), F.col("ingested_at")))
            .drop("key_hash", "key", "earliest"))
