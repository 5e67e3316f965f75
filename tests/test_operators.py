"""Operator-level golden cases: silver rules, dedup survivor, latest-per-key, routing."""

import datetime as dt

from pyspark.sql import functions as F

from emberlog.functions.stats import exact_avg, round_half_even
from emberlog.functions.text import int_prefix
from emberlog.operators.bronze import dedup_first, to_bronze
from emberlog.operators.latest import latest_by_key
from emberlog.operators.route import route
from emberlog.operators.silver import latency_bucket, proto_label


def test_latency_bucket_and_proto(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, -1.0, 4.9, 5.0, 20.0, 50.0, None]], "l float")
    got = [r[0] for r in df.select(latency_bucket(F.col("l"))).collect()]
    assert got == ["no_data", "excellent", "excellent", "good", "degraded", "critical", "critical"]
    p = spark.createDataFrame([(6,), (17,), (1,), (47,), (None,)], "p int")
    assert [r[0] for r in p.select(proto_label(F.col("p"))).collect()] == ["TCP", "UDP", "ICMP", "47", None]


def test_dedup_survivor_independent_of_partitioning(spark):
    rows = [("e1", 5, "x"), ("e1", 3, "y"), ("e1", 9, "z"), ("e2", 1, "w")]
    df = spark.createDataFrame(rows, "k string, off long, v string")
    for n in (1, 3):
        out = dedup_first(df.repartition(n), ["k"], ["off"]).orderBy("k").collect()
        assert [(r.k, r.off, r.v) for r in out] == [("e1", 3, "y"), ("e2", 1, "w")]


def test_latest_by_key(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("d", "a", "x", t1, t1, 1), ("d", "b", "y", t2, t2, 1)],
                               "device_id string, program string, tag string, first_seen timestamp,"
                               " last_seen timestamp, total_events long")
    r = latest_by_key(df).collect()[0]
    assert r.program == "b" and r.total_events == 1
    a = latest_by_key(df, accumulate=True).collect()[0]
    assert (a.program, a.first_seen, a.last_seen, a.total_events) == ("b", t1, t2, 2)


def test_route_profiles(spark):
    df = spark.createDataFrame([("d", "", 0, "accept", "success", 0, 0, 0.0)],
                               "device_id string, devtype string, is_anomaly int, action string,"
                               " status string, sentbyte long, rcvdbyte long, latency float")
    batch = {r.topic for r in route(df, "batch").collect()}
    rt = {r.topic for r in route(df, "realtime").collect()}
    assert batch == {"fg_raw_all", "fg_traffic_flow"}
    assert rt == batch | {"fg_device_inventory"}


def test_averages_keep_every_decimal(spark):
    df = spark.createDataFrame([(0.0004,), (0.0004,), (1.23456,)], "l float")
    for parts in (1, 3):
        got = df.repartition(parts).agg(exact_avg("l").alias("a")).collect()[0].a
        assert abs(got - 0.4117866667) < 1e-8
    odd = [0.1, 1e-9, 7.5, -3.25, None, 1e13, 123456.789]
    df = spark.createDataFrame([(x,) for x in odd], "l double")
    known = [x for x in odd if x is not None]
    assert abs(df.agg(exact_avg("l").alias("a")).collect()[0].a / (sum(known) / len(known)) - 1) < 1e-15
    assert df.where("l > 1e20").agg(exact_avg("l").alias("a")).collect()[0].a is None
    two = spark.createDataFrame([(0.125,), (2.5,), (0.375,)], "x double")
    assert [r[0] for r in two.select(round_half_even("x", 2)).collect()] == [0.12, 2.5, 0.38]


def test_messy_integers(spark):
    df = spark.createDataFrame([("12abc",), ("1,234",), ("443.0",), (" 7 ",), ("x",), ("",), (None,), ("-5z",), ("99999999999",)], "v string")
    assert [r[0] for r in df.select(int_prefix("v")).collect()] == [12, 1234, 443, 7, 0, 0, 0, -5, 0]


def test_bronze_takes_any_partition_and_offset(spark):
    """Hashed offsets, large partition numbers and unknown topics order without limits."""
    value = '{"device_id":"d","event_id":"%s"}'
    big = (1 << 63) - 1
    rows = [("fg_raw_all", 1500, big, value % "a"), ("fg_raw_all", 3, -big, value % "a"), ("zz", 0, -big, value % "a"),
            ("fg_raw_all", 2_000_000, 5, value % "b"), ("fg_raw_all", 7, 5, value % "b")]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    got = to_bronze(log, topics=["fg_raw_all", "zz"]).orderBy("event_id").collect()
    assert [(r.event_id, r.kafka_offset, r.kafka_topic) for r in got] == [("a", -big, "fg_raw_all"), ("b", 5, "fg_raw_all")]
