"""Structured Streaming: continuous ingest, fan-out, serving appends, latest-per-key.

* ``start_fanout``: text lines (file source, or any line stream) -> parser ->
  predicate fan-out -> JSON topic log (parquet partitioned by topic, or
  Kafka).  One read of the source per micro-batch; the expansion is map-side.
* ``start_network``: network-device CSV files -> classify and enrich -> topic.
* ``start_serving``: one topic -> its serving table, appended; by one stream or
  by several that take a share of the topic's files each.
* ``start_bronze``: raw topic -> bronze table, de-duplicated within a watermark
  (the record that arrives first stays, at once).
* ``start_bronze_held``: the same with the batch job's survivor: records wait as
  state until the watermark passes them, the smallest (offset, topic,
  partition) of a key leaves.
* ``start_device_latest``: device topic -> latest row per device, merged per
  micro-batch into a bucketed table.  A commit record names the files of each
  bucket and the last batch of each streaming query, so a replayed batch
  changes nothing, a new checkpoint starts its own count of batches, and a
  batch rewrites only the buckets that it touches.

Offsets/progress live in each query's checkpoint, which must be on shared,
fault-tolerant storage (see ``session.shared_dir``).  The serving
loads are stateless projections; the device table is the only merge and the
keys of ``start_bronze`` the only state.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scoring import BATCH
from ..operators.bronze import FULL_KEYS, flatten
from ..operators.latest import latest_by_key
from ..operators.parse_batch import parse_batch_lines
from ..operators.parse_net import enrich_network, parse_network_records
from ..operators.parse_rt import parse_rt_lines
from ..operators.route import route
from ..operators.serving import TABLES, load_devices, load_table, month_partition
from ..operators.silver import event_time, event_time_of_ts
from ..schemas import FIREWALL_TOPICS, TOPIC_DEVICES, TOPIC_NETWORK, TOPIC_RAW
from ..sources.lines import stream_lines, stream_network_csv
from ..sources.topics import RECORDS_PER_FILE, STAGED, by_placing, by_sink, encode, stream_topic


# Fixed value: records that a serving table takes in at a time.
BLOCK_RECORDS = 65_536


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer


def start_fanout(spark: SparkSession, lines_path: str, topic_path: str, checkpoint: str,
                 profile: str = "realtime", fmt: str = "parquet",
                 max_files: int | None = None, available_now: bool = False,
                 interval: str | None = None, positions: bool = True) -> StreamingQuery:
    """Parse lines by ``profile`` ("realtime" or "batch") and publish to the topics.

    ``positions``: offsets rise with the lines of a file; without, they are
    hashes (see ``stream_lines``).  Files are cut either way.
    """
    lines = stream_lines(spark, lines_path, max_files, positions=positions)
    keep = ["line_no", "split"]
    parsed = parse_batch_lines(lines, keep=keep) if profile == BATCH else parse_rt_lines(lines, id_mode="uuid", keep=keep)
    log = encode(route(parsed, profile), offset_col="line_no", partition=F.col("split"), exclude=["split"])
    return _publish(log, topic_path, checkpoint, fmt, available_now, interval)


def _publish(log: DataFrame, topic_path: str, checkpoint: str, fmt: str,
             available_now: bool, interval: str | None) -> StreamingQuery:
    if fmt == "kafka":
        w = (log.select("topic", "value").writeStream.format("kafka")
             .option("kafka.bootstrap.servers", topic_path))
    elif fmt == "parquet" and not by_sink(log.sparkSession, topic_path):
        def _place(batch: DataFrame, batch_id: int) -> None:
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            place_batch(batch, topic_path, batch_id, query)

        w = log.writeStream.foreachBatch(_place)
    else:
        w = (log.writeStream.format(fmt).partitionBy("topic").option("path", topic_path)
             .option("compression", "zstd").option("maxRecordsPerFile", RECORDS_PER_FILE))
    w = _trigger(w.option("checkpointLocation", checkpoint).outputMode("append"), available_now, interval)
    # A task holds one file of each topic open, of RECORDS_PER_FILE records at most, instead of sorting all copies by topic.
    spark, before = log.sparkSession, log.sparkSession.conf.get(OPEN_FILES, None)
    spark.conf.set(OPEN_FILES, str(len(FIREWALL_TOPICS) + 1))
    try:
        return w.start()  # the query runs in a copy of the session
    finally:
        spark.conf.unset(OPEN_FILES) if before is None else spark.conf.set(OPEN_FILES, before)


def place_batch(batch: DataFrame, path: str, batch_id: int, query: str, by: str = "topic", most: int = RECORDS_PER_FILE) -> None:
    """Put one micro-batch of the streaming query ``query`` into its topics' folders, or those of another column ``by``.

    All its files are written aside first and take their name as a whole by one
    rename; then each file is moved into its topic's folder.  A replay writes
    nothing again but moves what is left, so a reader of a folder meets every
    record once.  A file holds ``most`` records at most (0: any number).
    """
    folder = f"{path.rstrip('/')}/{STAGED}/{query}"
    fs, whole, jvm = _fs(batch.sparkSession, f"{folder}/{batch_id}")
    at = jvm.org.apache.hadoop.fs.Path

    def move(a, b):
        if not fs.rename(a, b):
            raise OSError(f"cannot move {a} to {b}")

    if not fs.exists(whole):
        draft = f"{folder}/draft-{batch_id}"
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
         .option("maxRecordsPerFile", most).partitionBy(by).parquet(draft))
        move(at(draft), whole)
        for other in fs.listStatus(at(folder)):  # the checkpoint has the batches before, so none is replayed
            if other.getPath().getName() != str(batch_id):
                fs.delete(other.getPath(), True)
    for topic in (t.getPath() for t in fs.listStatus(whole) if t.isDirectory()):
        to = at(f"{path.rstrip('/')}/{topic.getName()}")
        fs.mkdirs(to)
        for file in fs.listStatus(topic):
            move(file.getPath(), at(to, file.getPath().getName()))


def start_network(spark: SparkSession, csv_path: str, topic_path: str, checkpoint: str,
                  fmt: str = "parquet", fallback=None, max_files: int | None = None,
                  available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Network-device records from CSV files to the network topic."""
    records = stream_network_csv(spark, csv_path, max_files)
    events = enrich_network(parse_network_records(records, fallback=fallback), fallback)
    # CSV rows have no position either; the record's own id stands in.
    events = events.withColumns({"topic": F.lit(TOPIC_NETWORK), "position": F.xxhash64("event_id")})
    log = encode(events, offset_col="position")
    return _publish(log, topic_path, checkpoint, fmt, available_now, interval)


def start_serving(spark: SparkSession, topic_path: str, table: str, table_path: str,
                  checkpoint: str, fmt: str = "parquet", fallback=None,
                  available_now: bool = False, interval: str | None = None,
                  max_per_trigger: int | None = None, max_records: int | None = BLOCK_RECORDS,
                  share: tuple[int, int] | None = None) -> StreamingQuery:
    """One topic -> its serving table, in blocks of at most ``max_records`` records (``max_per_trigger``: files, or Kafka offsets, instead).

    ``share`` ``(k, n)`` makes it one of n consumers that run side by side, each
    with a checkpoint of its own, and load the table together; see ``stream_topic``.
    Spark's file sink has one writer, so their micro-batches are placed.
    """
    log = stream_topic(spark, [TABLES[table][0]], topic_path, fmt, max_per_trigger, None if max_per_trigger else max_records, share)
    rows = month_partition(load_table(log, table, fallback))
    if share and by_sink(spark, table_path):
        raise ValueError(f"Spark's file sink began {table_path} and goes on alone")
    if share or by_placing(spark, table_path):
        def _place(batch: DataFrame, batch_id: int) -> None:
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            place_batch(batch, table_path, batch_id, query, by="event_month", most=0)

        w = rows.writeStream.foreachBatch(_place)
    else:
        w = (rows.writeStream.format("parquet").partitionBy("event_month")
             .option("path", table_path).option("compression", "zstd"))
    return _trigger(w.option("checkpointLocation", checkpoint).outputMode("append"), available_now, interval).start()


def start_bronze(spark: SparkSession, topic_path: str, table_path: str, checkpoint: str,
                 keys=FULL_KEYS, delay: str = "7 days", fmt: str = "parquet",
                 available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Raw topic -> bronze, one row per key within ``delay`` of event time.

    The keys seen are state, held for ``delay``; a record older than that
    against the newest event counts as late and is left to the batch job,
    which de-duplicates without a horizon.  (RocksDB keeps it out of the heap.)
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    log = stream_topic(spark, [TOPIC_RAW], topic_path, fmt)
    rows = flatten(log).where(F.col("device_id").isNotNull() & (F.trim("device_id") != ""))
    rows = (rows.withColumn("event_time", event_time(F.col("ingested_at")))
            .withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("event_time"))
    w = (rows.withColumn("ingest_date", F.to_date("ingested_at")).writeStream.format("parquet")
         .partitionBy("ingest_date").option("path", table_path).option("compression", "zstd")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, available_now, interval).start()


def start_bronze_held(spark: SparkSession, topic_path: str, table_path: str, checkpoint: str,
                      keys=FULL_KEYS, delay: str = "7 days", fmt: str = "parquet",
                      available_now: bool = False, interval: str | None = None,
                      max_per_trigger: int | None = None) -> StreamingQuery:
    """Raw topic -> bronze, of each key the record that the batch job keeps, once it is ``delay`` old.

    The records of a key share its time where ``ts`` is readable; where only
    ``eventtime`` is, those within ``delay`` of one another are one session.
    State is one record for each key that the watermark has not passed (RocksDB,
    out of the heap).  A record older than the watermark is late and left to the
    batch job.  One without a readable time has none that a watermark could
    pass: it leaves at once, and the batch job de-duplicates and places it.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    none = F.lit(None).cast("timestamp")
    flat = flatten(stream_topic(spark, [TOPIC_RAW], topic_path, fmt, max_per_trigger), keep_partition=True).withColumn("event_time", event_time(none))
    present = F.col("device_id").isNotNull() & (F.trim("device_id") != "")
    order = ["kafka_offset", "kafka_topic", "_partition"]
    record = F.struct(*order, *(c for c in flat.columns if c not in order and c != "event_time"))
    # Blank devices go after the aggregation: a filter before it would be pushed
    # below the watermark, which is to see every time.
    gap = F.when(event_time_of_ts().isNotNull(), "1 second").otherwise(delay)
    timed = (flat.where(F.col("event_time").isNotNull()).withColumn("gap", gap).withWatermark("event_time", delay)
             .groupBy(F.session_window("event_time", F.col("gap")), *keys).agg(F.min(record).alias("record")).select("record.*").where(present))
    untimed = flat.where(F.col("event_time").isNull() & present)
    columns = [c for c in untimed.columns if c not in ("_partition", "event_time")]
    rows = timed.select(*columns).unionByName(untimed.select(*columns))
    w = (rows.withColumn("ingest_date", F.to_date("ingested_at")).writeStream.format("parquet")
         .partitionBy("ingest_date").option("path", table_path).option("compression", "zstd")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, available_now, interval).start()


# --- latest-per-key merge into a bucketed parquet table ------------------------

BUCKETS = 32


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _commits(spark: SparkSession, root: str) -> list[str]:
    fs, p, jvm = _fs(spark, f"{root.rstrip('/')}/commits")
    if not fs.exists(p):
        return []
    return sorted(n for st in fs.listStatus(p) if (n := st.getPath().getName()).endswith(".json"))


def _commit_record(spark: SparkSession, root: str) -> dict:
    """The newest commit: version, path of each bucket, last batch of each streaming query."""
    names = _commits(spark, root)
    if not names:
        return {"version": 0, "buckets": {}, "batches": {}}
    rows = spark.read.text(f"{root.rstrip('/')}/commits/{names[-1]}", wholetext=True).collect()
    return json.loads(rows[0].value)


def _commit(spark: SparkSession, root: str, record: dict) -> None:
    """Write the record under a temporary name and rename it: it is there whole or not at all."""
    name = f"{root.rstrip('/')}/commits/{record['version']:012d}.json"
    fs, draft, jvm = _fs(spark, name + ".tmp")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    if not fs.rename(draft, jvm.org.apache.hadoop.fs.Path(name)):
        raise OSError(f"cannot commit {name}")


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The current table (None before the first commit)."""
    paths = sorted(_commit_record(spark, root)["buckets"].values())
    return spark.read.parquet(*paths) if paths else None


def _remove_superseded(spark: SparkSession, root: str, before: dict, now: dict) -> None:
    """Delete bucket files that neither of the last two commits names, and older records."""
    fs, _, jvm = _fs(spark, root)
    path = jvm.org.apache.hadoop.fs.Path
    for old in set(before.get("replaced", [])) - set(now["buckets"].values()):
        fs.delete(path(old), True)
    for name in _commits(spark, root)[:-2]:
        fs.delete(path(f"{root.rstrip('/')}/commits/{name}"), False)


def merge_latest(spark: SparkSession, batch: DataFrame, root: str, batch_id: int,
                 keys=("device_id",), version: str = "last_seen",
                 accumulate: bool = False, query: str = "") -> None:
    """Merge one micro-batch of the streaming query ``query`` (its checkpoint's id).

    Reads and rewrites only the buckets of the batch's keys, under a new
    version, never a path that is being read.  A batch that the query has
    committed is skipped.  With ``accumulate`` a new checkpoint that reads old
    records again adds them again; start it with a new table.
    """
    record = _commit_record(spark, root)
    if record["batches"].get(query, -1) >= batch_id:
        return  # replay of a committed batch
    number = record["version"] + 1
    folder = f"{root.rstrip('/')}/v={number}"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    batch = batch.withColumn("bucket", bucket).persist()
    try:
        touched = [str(r[0]) for r in batch.select("bucket").distinct().collect()]  # at most BUCKETS
        old = [record["buckets"][b] for b in touched if b in record["buckets"]]
        rows = batch.drop("bucket")
        if old:
            rows = spark.read.parquet(*old).unionByName(rows)
        merged = latest_by_key(rows, keys, version, accumulate).withColumn("bucket", bucket)
        merged.hint("rebalance", "bucket").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(folder)
    finally:
        batch.unpersist()
    now = {"version": number, "buckets": record["buckets"] | {b: f"{folder}/bucket={b}" for b in touched},
           "batches": record["batches"] | {query: batch_id}, "replaced": old}
    _commit(spark, root, now)
    _remove_superseded(spark, root, record, now)


def start_device_latest(spark: SparkSession, topic_path: str, table_root: str,
                        checkpoint: str, fmt: str = "parquet", seen_ts=None,
                        fallback=None, accumulate: bool = False,
                        available_now: bool = False,
                        interval: str | None = None) -> StreamingQuery:
    log = stream_topic(spark, [TOPIC_DEVICES], topic_path, fmt)
    devices = load_devices(log, seen_ts=seen_ts, fallback=fallback).drop("ingested_at")

    def _merge(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_latest(batch.sparkSession, batch, table_root, batch_id,
                     accumulate=accumulate, query=query or checkpoint)

    w = devices.writeStream.foreachBatch(_merge).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()
