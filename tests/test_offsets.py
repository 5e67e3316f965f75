"""Offset ranges at the source, and streams bounded by records."""

import json

import pytest
from pyspark.sql import functions as F

from emberlog.operators.bronze import FULL_KEYS, to_bronze
from emberlog.plans import flows, medallion
from emberlog.plans.registered import run_ts
from emberlog.session import shared_dir
from emberlog.sources import topics as T
from emberlog.sources.tables import scan
from emberlog.streaming.ingest import start_serving

SF = "/root/testdata/sf0.001"


def _log(spark, n=1000, start=0, topic="fg_raw_all"):
    return spark.range(start, start + n).selectExpr(f"'{topic}' AS topic", "cast(id % 3 as int) AS partition", "id AS offset", "concat('{\"device_id\":\"d', id, '\"}') AS value")


def _opened(df):
    return {T._name(r[0]) for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_range_opens_only_the_files_that_hold_it(spark):
    root = shared_dir(spark, "log")
    for k in range(5):
        T.write_topics(_log(spark, 200, 200 * k).coalesce(1), root)
    T.write_topics(_log(spark, 50, topic="fg_performance").coalesce(1), root)
    assert T.index_offsets(spark, root) == 0 and T.offset_index(spark, root).agg(F.sum("records")).first()[0] == 1050
    whole = T.read_topics(spark, ["fg_raw_all"], root)
    for since, until, files in ((400, None, 3), (None, 200, 1), (399, 401, 2), (0, 1000, 5), (5000, None, 0), (None, None, 5)):
        got = T.read_topics(spark, ["fg_raw_all"], root, since=since, until=until)
        want = whole.where(F.col("offset").between(since or 0, (until or 10**9) - 1))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        if since is not None or until is not None:
            assert len(T.files_of_range(spark, root, ["fg_raw_all"], since, until)) == files == len(_opened(got)) == len(got.inputFiles())


def test_files_that_the_index_does_not_know_are_read(spark):
    root = shared_dir(spark, "log")
    T.write_topics(_log(spark, 100).coalesce(1), root)
    _log(spark, 100, 100).coalesce(1).write.mode("append").partitionBy("topic").parquet(root)
    assert T.read_topics(spark, ["fg_raw_all"], root, since=150).count() == 50
    assert len(T.files_of_range(spark, root, ["fg_raw_all"], 500, None)) == 1
    assert T.index_offsets(spark, root) == 1 and T.files_of_range(spark, root, ["fg_raw_all"], 500, None) == []
    assert T.read_topics(spark, ["fg_raw_all"], root, since=500).count() == 0


def test_kafka_is_told_the_range(spark):
    both = {"a": [0, 1], "b": [0]}
    assert json.loads(T.kafka_offsets(both, 7, -2)) == {"a": {"0": 7, "1": 7}, "b": {"0": 7}}
    assert json.loads(T.kafka_offsets(both, None, -1)) == {"a": {"0": -1, "1": -1}, "b": {"0": -1}}
    with pytest.raises(ValueError, match="partitions"):
        T.read_topics(spark, ["a"], "host:1", "kafka", since=3)


def test_medallion_takes_a_range_of_a_stored_log(spark):
    stored, root, whole = (shared_dir(spark, "log") for _ in range(3))
    log = flows.batch_topic_log(spark, SF, json=True, only=["fg_raw_all"])
    T.write_topics(log.repartitionByRange(4, "offset"), stored)
    half = spark.read.parquet(stored).agg(F.max("offset")).first()[0] // 2
    only = {"fallback": run_ts(), "ingest_ts": run_ts(), "reports": ("fg_kpi_hourly",)}
    medallion.run_medallion(spark, stored, root, until=half, **only)
    medallion.run_medallion(spark, stored, root, since=half, **only)
    medallion.run_medallion(spark, flows.batch_topic_log(spark, SF, only=["fg_raw_all"]), whole, **only)
    rows = lambda to: sorted(map(str, scan(spark, f"{to}/gold/fg_kpi_hourly").collect()))
    assert rows(root) == rows(whole) != []
    assert to_bronze(T.read_topics(spark, ["fg_raw_all"], stored, since=half), keys=FULL_KEYS).count() > 0


def test_micro_batches_hold_at_most_the_bound(spark, monkeypatch):
    monkeypatch.setattr(T, "RECORDS_PER_FILE", 100)
    root = shared_dir(spark, "log")
    T.write_topics(_log(spark, 950), root)
    T.write_topics(_log(spark, 300, topic="fg_performance"), root)
    for bound, least in ((100, 10), (300, 4)):
        query = start_serving(spark, root, "t_raw_events", f"{root}-out{bound}", f"{root}-chk{bound}", fallback=run_ts(), available_now=True, max_records=bound)
        query.awaitTermination()
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        assert max(sizes) <= bound and len(sizes) >= least
        assert spark.read.parquet(f"{root}-out{bound}").count() == 950
