"""Bronze in the stream with the batch's survivor."""

import json
import os

import pytest
from pyspark.sql import functions as F

from emberlog.plans.registered import largest_blocks
from emberlog.session import shared_dir
from emberlog.sources.lines import stream_lines
from emberlog.sources.topics import names_of_share, stream_topic
from emberlog.streaming.ingest import place_batch, start_bronze_held, start_fanout, start_serving


def _append(spark, root, *records):
    rows = [("fg_raw_all", p, o, json.dumps({"device_id": d, "ts": ts, "event_id": e, "seq": "1", "message": f"m{o}"})) for o, p, d, ts, e in records]
    (spark.createDataFrame(rows, "topic string, partition int, offset long, value string").coalesce(1).write.mode("append").partitionBy("topic").parquet(root))


def test_the_smallest_record_of_a_key_leaves_when_the_watermark_passes(spark):
    root = shared_dir(spark, "held")
    day = lambda n: f"2024-01-{n:02d} 10:00:00"
    _append(spark, f"{root}/log", (9, 0, "d1", day(1), "a"), (20, 0, "d1", day(1), "b"), (21, 0, " ", day(1), "x"), (30, 0, "d9", "bad", "u"))
    _append(spark, f"{root}/log", (3, 0, "d1", day(1), "a"), (3, 1, "d1", day(3), "c"), (3, 0, "d1", day(3), "c"))

    def run():
        query = start_bronze_held(spark, f"{root}/log", f"{root}/bronze", f"{root}/chk", delay="4 days", available_now=True, max_per_trigger=1)
        query.awaitTermination()
        return query, sorted((r.event_id, r.kafka_offset, r.message) for r in spark.read.parquet(f"{root}/bronze").collect())

    query, rows = run()
    assert rows == [("u", 30, "m30")]  # no watermark has passed a timed record yet
    _append(spark, f"{root}/log", (40, 0, "d2", day(9), "d"))
    _append(spark, f"{root}/log", (41, 0, "d2", day(10), "e"))
    query, rows = run()
    assert rows == [("a", 3, "m3"), ("b", 20, "m20"), ("c", 3, "m3"), ("u", 30, "m30")]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2  # what has left is not kept
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    _append(spark, f"{root}/log", (1, 0, "d1", day(1), "a"), (50, 0, "d3", day(2), "late"))  # older than the watermark: left to the batch job
    _append(spark, f"{root}/log", (60, 0, "d4", day(30), "z"))
    _append(spark, f"{root}/log", (61, 0, "d4", day(30), "z"))
    _, rows = run()
    assert [r[:2] for r in rows] == [("a", 3), ("b", 20), ("c", 3), ("d", 40), ("e", 41), ("u", 30)]
    assert spark.read.parquet(f"{root}/bronze").where(F.trim("device_id") == "").count() == 0


def _lines(spark, root, n, name):
    line = 'FG{};1;3;5;t;2024-01-01 00:00:00;p;"logid={} action=accept status=success";{}'
    spark.createDataFrame([(line.format(i % 5, i, i),) for i in range(n)], "value string").coalesce(3).write.mode("append").text(f"{root}/{name}")


def test_a_stream_of_one_topic_has_no_micro_batches_of_other_topics(spark):
    root = shared_dir(spark, "one-topic")
    _lines(spark, root, 60, "in")
    start_fanout(spark, f"{root}/in", f"{root}/topics", f"{root}/chk-in", max_files=1, available_now=True).awaitTermination()
    query = start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/raw", f"{root}/chk", available_now=True, max_per_trigger=1)
    query.awaitTermination()
    files = len(spark.read.parquet(f"{root}/topics").where("topic = 'fg_raw_all'").select("_metadata.file_path").distinct().collect())
    assert len(spark.read.parquet(f"{root}/topics").inputFiles()) > files == len(query.recentProgress) == 3
    assert spark.read.parquet(f"{root}/raw").count() == 60
    # A topic that has no file yet, of a log that has none: its records are taken in when they come.
    early = lambda: start_serving(spark, f"{root}/late", "t_raw_events", f"{root}/late-raw", f"{root}/chk-late", available_now=True).awaitTermination()
    early()
    start_fanout(spark, f"{root}/in", f"{root}/late", f"{root}/chk-in-late", available_now=True).awaitTermination()
    early()
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/late-raw").select("device_id").distinct().collect()) == [f"FG{k}" for k in range(5)]
    assert spark.read.parquet(f"{root}/late-raw").count() == 60
    both = stream_topic(spark, ["fg_raw_all", "fg_device_inventory"], f"{root}/topics")
    both.writeStream.format("parquet").option("path", f"{root}/both").option("checkpointLocation", f"{root}/chk-both").trigger(availableNow=True).start().awaitTermination()
    assert {r[0]: r[1] for r in spark.read.parquet(f"{root}/both").groupBy("topic").count().collect()} == {"fg_raw_all": 60, "fg_device_inventory": 60}


def test_a_replayed_micro_batch_moves_what_is_left_and_writes_nothing_again(spark):
    root = shared_dir(spark, "place")
    log = lambda *offsets: spark.createDataFrame([(t, 0, o, "{}") for o in offsets for t in ("a", "b")], "topic string, partition int, offset long, value string")
    rows = lambda: sorted((r.topic, r.offset) for r in spark.read.parquet(root).collect())
    place_batch(log(1, 2), root, 0, "q")
    assert rows() == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    place_batch(log(8, 9), root, 0, "q")  # a replay whose rows differ, as ids drawn anew do
    assert rows() == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    # Stopped after the files were written and one topic was moved.
    whole = f"{root}/_staged/q/1"
    log(3).coalesce(1).write.partitionBy("topic").parquet(whole)
    (name,) = [f for f in os.listdir(f"{whole}/topic=a") if f.endswith(".parquet")]
    os.rename(f"{whole}/topic=a/{name}", f"{root}/topic=a/{name}")
    place_batch(log(7), root, 1, "q")
    assert rows() == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3)]
    # Stopped while they were written.
    log(5).write.partitionBy("topic").parquet(f"{root}/_staged/q/draft-2")
    place_batch(log(4), root, 2, "q")
    place_batch(log(4), root, 0, "another query")
    assert [o for t, o in rows() if t == "b"] == [1, 2, 3, 4, 4]
    assert sorted(os.listdir(f"{root}/_staged/q")) == ["2"]  # what the checkpoint has is kept no longer


def test_a_log_that_sparks_sink_began_goes_on_in_its_list(spark):
    root = shared_dir(spark, "by-sink")
    _lines(spark, root, 6, "old")
    stream_lines(spark, f"{root}/old", positions=True).selectExpr("'fg_raw_all' topic", "split partition", "line_no offset", "'{\"device_id\": \"old\"}' value").writeStream.format("parquet").partitionBy("topic").option(
        "path", f"{root}/topics").option("checkpointLocation", f"{root}/chk-old").trigger(availableNow=True).start().awaitTermination()
    # A file that the sink has not committed is no part of the log.
    spark.createDataFrame([(0, 99, '{"device_id": "lost"}')], "partition int, offset long, value string").write.mode("append").parquet(f"{root}/topics/topic=fg_raw_all")
    start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/raw", f"{root}/chk", available_now=True).awaitTermination()
    assert [r[0] for r in spark.read.parquet(f"{root}/raw").select("device_id").collect()] == ["old"] * 6
    # The query that began it goes on with the same sink.
    _lines(spark, root, 4, "old")
    start_fanout(spark, f"{root}/old", f"{root}/topics", f"{root}/chk-old", available_now=True).awaitTermination()
    start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/raw", f"{root}/chk", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{root}/raw").count() == 10


def test_streams_side_by_side_load_each_file_once(spark):
    root = shared_dir(spark, "shares")
    topic, table = f"{root}/topics/topic=fg_raw_all", f"{root}/raw"

    def add(*offsets, name=None):
        before = set(os.listdir(topic)) if os.path.isdir(topic) else set()
        _append(spark, f"{root}/topics", *((o, 0, f"d{o}", "2024-01-01 00:00:00" if o % 2 else "2024-02-01 00:00:00", "e") for o in offsets))
        (new,) = [f for f in set(os.listdir(topic)) - before if f.endswith(".parquet")]
        os.rename(f"{topic}/{new}", f"{topic}/{name or new}")

    def run(shares):
        queries = [start_serving(spark, f"{root}/topics", "t_raw_events", table, f"{root}/chk/{k}", available_now=True, max_per_trigger=1, share=(k, shares)) for k in range(shares)]
        assert largest_blocks(queries, 0.5) <= 3
        return [sum(p["numInputRows"] for p in q.recentProgress) for q in queries]

    rows = lambda: sorted(int(r[0][1:]) for r in spark.read.parquet(table).select("device_id").collect())
    for k in range(11):  # tasks 0 to 9 and one of six digits
        add(3 * k, 3 * k + 1, 3 * k + 2, name=f"part-{k if k < 10 else 123456:05d}-{k}.parquet")
    add(33, 34, name="x.parquet")  # shorter than the place of the digit
    add(35, name="written_by_others.parquet")
    assert run(4) == [3 * 3 + 3, 3 * 3 + 3, 2 * 3, 2 * 3]
    assert rows() == list(range(36)) and sorted(r[0] for r in spark.read.parquet(table).select("event_month").distinct().collect()) == [202401, 202402]
    add(36, name="part-00003-new.parquet")
    assert run(4) == [0, 0, 0, 1] and rows() == list(range(37))
    # Another stream goes on by placing: a list of Spark's sink would hide what is there.
    start_serving(spark, f"{root}/topics", "t_raw_events", table, f"{root}/chk-one", available_now=True).awaitTermination()
    assert rows() == sorted([*range(37)] * 2)
    # A table of the sink's stays the sink's.
    start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/sink", f"{root}/chk-sink", available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="sink"):
        start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/sink", f"{root}/chk-share", share=(0, 2))
    with pytest.raises(ValueError, match="share"):
        names_of_share(0, 11)


def test_blocks_are_seen_that_a_query_reports_no_longer(spark):
    stopped = []

    class Query:
        recentProgress = [{"numInputRows": 7}]

        def __init__(self, rounds):
            self.rounds = rounds

        def stop(self):
            stopped.append(self)

        def awaitTermination(self, timeout):
            self.rounds -= 1
            if self.rounds < 0:
                raise RuntimeError("failed")
            if not self.rounds:
                self.recentProgress = [{"numInputRows": 1}]
            return not self.rounds

    assert largest_blocks([Query(3), Query(1)]) == 7 and largest_blocks([Query(1)]) == 1 and not stopped
    with pytest.raises(RuntimeError, match="failed"):
        largest_blocks([Query(3), Query(0)])
    assert len(stopped) == 2  # none goes on alone


def test_micro_batches_share_their_compiled_code(spark):
    root = shared_dir(spark, "compiled")
    compiled = lambda: spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME().getCount()

    def run(name, **how):
        start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/{name}", f"{root}/chk-{name}", available_now=True, max_per_trigger=1, **how).awaitTermination()

    for name, how in (("sink", {}), ("placed", {"share": (0, 1)})):
        counts = []
        for n in range(2):
            for k in range(4):
                _append(spark, f"{root}/topics", (k, 0, "d", "2024-01-01 00:00:00", "e"), (k, 0, "d", "bad", "e"))  # "bad" is stored as now
            before = compiled()
            run(name, **how)
            counts.append(compiled() - before)
        assert counts[1] < 4, counts
        times = spark.read.parquet(f"{root}/{name}").where("ingested_at > current_timestamp() - interval 1 hour and (ts = '2024-01-01' or ts = ingested_at)")
        assert times.count() == spark.read.parquet(f"{root}/{name}").count() > 0
