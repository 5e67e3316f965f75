"""Steps whose tasks must not grow with the table or with a file."""

from pyspark.sql import functions as F

from emberlog.plans import flows
from emberlog.plans.registered import arrivals
from emberlog.schemas import FIREWALL_TOPICS
from emberlog.session import shared_dir
from emberlog.sources import bridge
from emberlog.sources.lines import stream_lines
from emberlog.sources.topics import encode
from emberlog.streaming.ingest import start_bronze

SF_SMALL = "/root/testdata/sf0.001"


def test_events_of_one_row_group_are_rendered_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(bridge, "MOST_PER_TASK", 100)
    root = shared_dir(spark, "events")
    whole = spark.range(1000).select(F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).alias("user_id"),
                                     F.lit("error").alias("event_type"), F.lit(1.5).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props")).coalesce(1)
    whole.write.parquet(f"{root}/events.parquet")
    for lines, plain in ((flows.firewall_lines, bridge.firewall_lines), (flows.network_lines, bridge.network_lines)):
        got = lines(spark, root)
        assert got.rdd.getNumPartitions() == 10
        assert max(r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()) < 200
        assert sorted(got.collect()) == sorted(plain(whole).collect())


def test_events_that_go_on_as_several_copies_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(bridge, "MOST_PER_TASK", 100)
    events = spark.range(1000).coalesce(1)
    assert [bridge.spread_events(events, copies).rdd.getNumPartitions() for copies in (1, 5)] == [10, 50]
    assert bridge.spread_events(events, 5).count() == 1000
    of = []
    monkeypatch.setattr(bridge, "spread_events", lambda events, copies=1: of.append(copies) or events)
    flows.bronze(spark, SF_SMALL, topics=FIREWALL_TOPICS)
    flows.bronze(spark, SF_SMALL)
    assert of == [len(FIREWALL_TOPICS), 1]


def test_streamed_lines_of_a_cut_file_rise_in_its_order(spark):
    root = shared_dir(spark, "cut-stream")
    text = {f"f{k}": [f"{k} {i} " + "x" * (i % 57) for i in range(300 * k)] for k in range(4)} | {"blank": [""] * 9000, "last": ["a", "", "b\rc", "é"]}
    for name, lines in text.items():
        with open(f"{root}/{name}.log", "w", newline="") as f:
            f.write("\n".join(lines) + ("\n" if lines and name != "last" else ""))
    conf = {"spark.sql.files.maxPartitionBytes": "3k", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "70"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = stream_lines(spark, root, positions=True).withColumn("task", F.spark_partition_id())
        df.writeStream.format("parquet").option("path", f"{root}-out").option("checkpointLocation", f"{root}-chk").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows = spark.read.parquet(f"{root}-out").orderBy("split", "line_no").collect()
    files = {}
    for r in rows:
        files.setdefault(r.split, []).append(r)
    assert len({(r.split, r.line_no) for r in rows}) == len(rows)
    assert sorted([r.value for r in f] for f in files.values()) == sorted(x for x in text.values() if x)
    assert max(len({r.task for r in f}) for f in files.values()) > 5  # no file is one task


def test_an_append_by_arrival_is_written_by_several_tasks(spark):
    root = shared_dir(spark, "arrivals")
    events = spark.range(2000).select(F.lit("fg_raw_all").alias("topic"), F.col("id").alias("line_no"), F.lit("d").alias("device_id"),
                                      F.date_format(F.timestamp_seconds(1704067200 + F.col("id") * 1000), "yyyy-MM-dd HH:mm:ss").alias("ts")).repartition(3)
    files = lambda: set(spark.read.parquet(f"{root}/topics").inputFiles())
    added, before, size = [], set(), "spark.sql.files.maxPartitionBytes"
    spark.conf.set(size, "4k")
    try:
        for _ in arrivals(spark, encode(events), f"{root}/topics"):
            added.append(len(files() - before))
            before = files()
    finally:
        spark.conf.unset(size)
    assert all(n > 1 for n in added[:5]) and added[5:] == [1, 1]
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/topics").select("offset").collect()) == [-1, -1, *range(2000)]


def test_keys_of_the_stream_are_state_out_of_the_heap(spark):
    root = shared_dir(spark, "keys")
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    (spark.createDataFrame([("fg_raw_all", 0, n, '{"device_id": "d", "ts": "2024-01-01 00:00:00", "seq": "1", "event_id": "a"}') for n in range(5)], "topic string, partition int, offset long, value string")
     .write.partitionBy("topic").parquet(f"{root}/topics"))
    query = start_bronze(spark, f"{root}/topics", f"{root}/bronze", f"{root}/chk", available_now=True)
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 1
    assert any(k.startswith("rocksdb") for p in query.recentProgress for s in p["stateOperators"] for k in s["customMetrics"])
