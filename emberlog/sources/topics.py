"""Topic logs: JSON records keyed by topic, on Kafka or on parquet.

The topic log has the columns of a Kafka read -- ``topic, partition, offset,
value`` (value = JSON text).  With ``fmt="kafka"`` the same functions use the
Kafka source/sink (needs the Kafka connector on the classpath, not shipped in
this environment: that path is option plumbing, untested here).  The default
``parquet`` form stores the log partitioned by topic, so reading one topic
prunes the others at planning time.

A stored log has an offset index beside it (``_offsets``, which readers of the
log skip): the smallest and largest offset and the number of records of each
file, topic and partition.  A read of an offset range opens the files that hold
it, and files that the index does not know yet.  Files hold ``RECORDS_PER_FILE``
records at most, so a stream that admits so many files admits so many records.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import TOPIC_LOG_SCHEMA


# Marks a value column that was encoded in the plan at hand (lost in storage).
IN_PLAN = "encoded_in_plan"


RECORDS_PER_FILE = 16_384
OFFSETS = "_offsets"
STAGED = "_staged"  # micro-batches on their way into the topics' folders; readers of the log skip it
OFFSETS_SCHEMA = "file string, topic string, partition int, first long, last long, records long"


def encode(df: DataFrame, topic_col: str = "topic", offset_col: str | None = "line_no",
           partition: Column | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Routed rows -> topic log rows (``to_json`` of every other column).

    ``offset_col`` gives the record position (a source offset); ``partition``
    the log partition (default 0).  Null fields are omitted from the JSON,
    like a JSON encoder that skips absent keys.
    """
    skip = {topic_col, *(exclude or [])}
    if offset_col:
        skip.add(offset_col)
    payload = [c for c in df.columns if c not in skip]
    return df.select(
        F.col(topic_col).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        (F.col(offset_col) if offset_col else F.monotonically_increasing_id())
        .cast("long").alias("offset"),
        F.to_json(F.struct(*payload)).alias("value", metadata={IN_PLAN: True}),
    )


def typed_log(routed: DataFrame, topic_col: str = "topic", offset_col: str = "line_no",
              partition: Column | None = None) -> DataFrame:
    """Routed rows as an in-plan topic log with a *typed* payload.

    Same coordinates as ``encode`` (topic, partition, offset) but the payload
    stays as columns.  Used when producer and consumer run in one plan: no
    JSON round trip, and filters on payload fields stay simple.  Consumers
    accept both forms through ``records``.
    """
    payload = [c for c in routed.columns if c not in (topic_col, offset_col)]
    return routed.select(
        F.col(topic_col).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        F.col(offset_col).cast("long").alias("offset"), *payload)


def records(log: DataFrame, schema: StructType,
            keep=("topic", "partition", "offset")) -> DataFrame:
    """Payload of a topic log as ``schema`` columns.

    A JSON log (``value`` column) is decoded; a typed log is projected to the
    schema (absent fields null, others cast), which is what decoding its JSON
    would give.
    """
    if "value" in log.columns:
        return decode(log, schema, keep)
    have = set(log.columns)
    cols = [(F.col(f.name).cast(f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return log.select(*[F.col(k) for k in keep], *cols)


def decode(log: DataFrame, schema: StructType, keep=("topic", "partition", "offset")) -> DataFrame:
    """Topic log -> typed columns (``from_json``, PERMISSIVE).

    A malformed record becomes an all-null row; a mistyped field is null.
    Records encoded in the same plan are refused: the optimizer would inline
    the whole parser into every decoded field.  Store the log between them,
    or hand it on as a ``typed_log``.
    """
    if log.schema["value"].metadata.get(IN_PLAN):
        raise ValueError("write the topic log before decoding it, or use typed_log")
    data = F.from_json(F.col("value").cast("string"), schema)
    return log.select(*[F.col(k) for k in keep], data.alias("_d")).select(*keep, "_d.*")


def write_topics(log: DataFrame, path_or_servers: str, fmt: str = "parquet",
                 mode: str = "append") -> None:
    """Publish topic-log rows: one write for all topics."""
    if fmt == "kafka":
        (log.select("topic", F.col("value").cast("string").alias("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", path_or_servers).save())
        return
    (log.write.mode(mode).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .partitionBy("topic").format(fmt).save(path_or_servers))
    index_offsets(log.sparkSession, path_or_servers)


# -- the offset index -----------------------------------------------------------

def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _name(file: str) -> str:
    """A file's name below the log: the topic's folder and the file."""
    return "/".join(file.rsplit("/", 2)[1:])


def by_sink(spark: SparkSession, path: str) -> bool:
    """Whether Spark's own file sink began the log: what it holds is then named by the sink's list above the topics."""
    return _exists(spark, f"{path}/_spark_metadata")


def by_placing(spark: SparkSession, path: str) -> bool:
    """Whether micro-batches were placed in it (``streaming.ingest.place_batch``), whose files a sink's list would hide."""
    return _exists(spark, f"{path}/{STAGED}")


def offset_index(spark: SparkSession, path: str) -> DataFrame:
    """file, topic, partition, first, last, records; empty where nothing is indexed."""
    if _exists(spark, f"{path}/{OFFSETS}"):
        return spark.read.schema(OFFSETS_SCHEMA).parquet(f"{path}/{OFFSETS}")
    return spark.createDataFrame([], OFFSETS_SCHEMA)


def _log_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Name -> path of the log's files (the listing that any read of the log plans with)."""
    return {_name(f): f for f in spark.read.schema(TOPIC_LOG_SCHEMA).parquet(path).inputFiles()}


def index_offsets(spark: SparkSession, path: str) -> int:
    """Add the files that are not in the index yet; returns their number.

    Only topic, partition and offset of the new files are read.  Two writers may
    index a file twice, which changes no answer.
    """
    files = _log_files(spark, path)
    known = {r[0] for r in offset_index(spark, path).select("file").distinct().toLocalIterator()}
    new = [f for name, f in files.items() if name not in known]
    if new:
        rows = spark.read.schema(TOPIC_LOG_SCHEMA).option("basePath", path).parquet(*new)
        file = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+)$", 1)
        (rows.groupBy(file.alias("file"), "topic", "partition")
         .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("records"))
         .coalesce(1).write.mode("append").parquet(f"{path}/{OFFSETS}"))
    return len(new)


def files_of_range(spark: SparkSession, path: str, topics: list[str], since: int | None, until: int | None) -> list[str]:
    """The log's files that hold offsets of [since, until) of the topics, and those the index does not know."""
    index = offset_index(spark, path)
    inside = F.col("topic").isin(*topics)
    if since is not None:
        inside &= F.col("last") >= since
    if until is not None:
        inside &= F.col("first") < until
    marks = {r[0]: r[1] for r in index.groupBy("file").agg(F.max(inside.cast("int"))).toLocalIterator()}
    folders = {f"topic={t}" for t in topics}
    return sorted(f for name, f in _log_files(spark, path).items() if marks.get(name, 1) and name.split("/")[0] in folders)


def kafka_offsets(partitions: dict[str, list[int]], offset: int | None, default: int) -> str:
    """``startingOffsets`` / ``endingOffsets``: one offset for every partition (default -2 earliest, -1 latest)."""
    return json.dumps({t: {str(p): default if offset is None else offset for p in ps} for t, ps in partitions.items()})


def read_topics(spark: SparkSession, topics: list[str], path_or_servers: str,
                fmt: str = "parquet", min_partitions: int | None = None,
                since: int | None = None, until: int | None = None,
                partitions: dict[str, list[int]] | None = None) -> DataFrame:
    """Batch read of several topics: all offsets, or those of [since, until).

    The range is given to the source: the parquet form opens only the files
    that hold it, Kafka starts and ends there (``partitions`` names the
    partitions of each topic, which Kafka wants to be told).
    """
    if fmt == "kafka" and (since is not None or until is not None):
        if not partitions:
            raise ValueError("an offset range of Kafka topics needs their partitions")
        r = (spark.read.format("kafka").option("kafka.bootstrap.servers", path_or_servers).option("subscribe", ",".join(topics))
             .option("startingOffsets", kafka_offsets(partitions, since, -2)).option("endingOffsets", kafka_offsets(partitions, until, -1)))
        return r.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    if fmt == "kafka":
        r = (spark.read.format("kafka")
             .option("kafka.bootstrap.servers", path_or_servers)
             .option("subscribe", ",".join(topics))
             .option("startingOffsets", "earliest")
             .option("endingOffsets", "latest"))
        if min_partitions:
            r = r.option("minPartitions", str(min_partitions))
        return r.load().select("topic", "partition", "offset",
                               F.col("value").cast("string").alias("value"))
    reader = spark.read.schema(TOPIC_LOG_SCHEMA).format(fmt)
    if since is None and until is None:
        df = reader.load(path_or_servers)
    else:
        files = files_of_range(spark, path_or_servers, topics, since, until)
        df = reader.option("basePath", path_or_servers).load(files) if files else spark.createDataFrame([], TOPIC_LOG_SCHEMA)
        df = df.where(F.col("offset").between(since if since is not None else -1 << 63, (until if until is not None else 1 << 63) - 1))
    return df.where(F.col("topic").isin(*topics)).select("topic", "partition", "offset", "value")


def names_of_share(k: int, of: int) -> str:
    """Glob of the file names of share ``k`` of ``of`` (10 at most): every name, of any shape and length, is in one share.

    A name goes by its tenth character, where Spark's files have the last digit of
    the number of the task that wrote them; names without a digit there go to share 0.
    """
    if not 0 <= k < of <= 10:
        raise ValueError(f"no share {k} of {of}: a log has 10 shares at most")
    before, digits = "?" * 9, "0123456789"
    if k:
        return f"{before}[{digits[k::of]}]*"
    others = "".join(d for d in digits if int(d) % of)
    short = ",".join("?" * n for n in range(1, 10))
    return f"{{{before}[^{others}]*,{short}}}" if others else "*"


def stream_topic(spark: SparkSession, topics: list[str], path_or_servers: str,
                 fmt: str = "parquet", max_per_trigger: int | None = None,
                 max_records: int | None = None, share: tuple[int, int] | None = None) -> DataFrame:
    """Continuous read of topics (offsets tracked by the query checkpoint).

    ``max_records``: the most records that a micro-batch takes in (of a stored
    log ``RECORDS_PER_FILE`` at least, as files are taken whole).  A stored log is
    read by the folders of its topics, into which files come whole.  ``share``
    ``(k, n)``: of the files of a stored log the k-th of n shares (as one consumer
    of a group reads some partitions of a topic); n stays while a checkpoint lives.
    """
    if share and fmt == "kafka":
        raise ValueError("shares are of a stored log's files; Kafka deals its partitions out itself")
    if max_records:
        max_per_trigger = max_records if fmt == "kafka" else max_records // RECORDS_PER_FILE
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", path_or_servers)
             .option("subscribe", ",".join(topics))
             .option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return r.load().select("topic", "partition", "offset",
                               F.col("value").cast("string").alias("value"))
    r = spark.readStream.format(fmt)
    if share:
        r = r.option("pathGlobFilter", names_of_share(*share))
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max(1, max_per_trigger)))
    if fmt == "parquet" and not by_sink(spark, path_or_servers):
        # Only the folders of these topics: a micro-batch made of files of other topics costs as much as any.
        fields = StructType([f for f in TOPIC_LOG_SCHEMA if f.name != "topic"])
        of = F.lit(topics[0]) if len(topics) == 1 else F.regexp_extract("_metadata.file_path", "topic=([^/]*)/[^/]*$", 1)
        return r.schema(fields).load(f"{path_or_servers}/topic={{{','.join(topics)}}}").select(of.alias("topic"), "partition", "offset", "value")
    df = r.schema(TOPIC_LOG_SCHEMA).load(path_or_servers)
    return df.where(F.col("topic").isin(*topics)).select("topic", "partition", "offset", "value")
