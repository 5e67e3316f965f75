"""Mergeable report states and the reports kept up by day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberlog.operators import gold
from emberlog.operators.states import Report
from emberlog.plans import flows, medallion
from emberlog.plans.registered import run_ts
from emberlog.session import shared_dir
from emberlog.sources.tables import scan

SF = "/root/testdata/sf0.001"

REPORT = Report(keys={"k": "k"}, inputs={"x": "x", "n": "n", "ip": "ip", "t": "t"}, sums={"rows": "count(1)", "total": "sum(n)"}, maxima={"top": "n"},
                averages={"avg_x": "x"}, long_averages={"avg_n": "n"}, distinct={"ips": "ip", "texts": "t"}, addresses=("ip",),
                columns=("k", "rows", "total", "top", "avg_x", "avg_n", "ips", "texts"))
IPS = ["10.0.0.1", "10.0.0.63", "10.0.0.64", "10.0.0.01", "010.0.0.1", " 10.0.0.1", "255.255.255.255", "0.0.0.0", "256.0.0.1", "1.2.3.300", "1.2.3", "1.2.3.4.5", "-1.0.0.0",
       "fe80::1", "", "x", None, "10.0.0.1", "128.0.0.0", "127.255.255.255", "1.2.3.4a", "+1.2.3.4", "99999999999.1.1.1"]


def _rows(spark):
    data = [(i % 3 if i % 10 else None, (i - 50) * 0.1 if i % 7 else None, (1 << 58) // (i + 1) * (-1) ** i, IPS[i % len(IPS)], f"t{i % 11}" if i % 5 else None) for i in range(230)]
    return data, spark.createDataFrame(data, "k int, x double, n long, ip string, t string")


def test_report_is_the_plain_aggregate(spark):
    _, df = _rows(spark)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"), F.max("n").alias("top"), F.avg("x").alias("avg_x"),
                               (F.sum(F.col("n").cast("decimal(38,0)")).cast("double") / F.count("n")).alias("avg_n"), F.count_distinct("ip").alias("ips"), F.count_distinct("t").alias("texts"))
    plain = {r["k"]: r.asDict() for r in want.collect()}
    for got in (REPORT.of(df), REPORT.of(df.repartition(7))):
        for r in got.collect():
            row, other = r.asDict(), plain[r["k"]]
            assert abs(row.pop("avg_x") - other["avg_x"]) < 1e-12
            assert row == {c: other[c] for c in row}
    assert REPORT.of(df.limit(0)).count() == 0


def test_partials_of_any_cut_merge_to_the_same(spark):
    _, df = _rows(spark)
    whole = sorted(map(str, REPORT.of(df).collect()))
    cut = df.withColumn("day", F.pmod(F.hash("ip", "x"), F.lit(5)))
    states = REPORT.partial(cut, ("day",))
    assert sorted(map(str, REPORT.finish(REPORT.merge(states)).collect())) == whole
    twice = REPORT.merge(states.unionByName(REPORT.partial(cut, ("day",))))  # values met twice are one
    assert [r["ips"] for r in REPORT.finish(twice).orderBy("k").collect()] == [r["ips"] for r in REPORT.of(df).orderBy("k").collect()]


def test_no_expand_in_the_reports(spark):
    silver = flows.silver(spark, SF, run_ts())
    for fn in (gold.gold_kpi_hourly, gold.gold_policy_traffic, gold.gold_protocol_stats):
        plan = fn(silver)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "partial_bit_or" in plan


def test_neighbouring_addresses_share_a_word(spark):
    df = spark.range(1000).selectExpr("1 AS k", "1D AS x", "id AS n", "concat('10.1.', id div 256, '.', id % 256) AS ip", "'t' AS t")
    states = REPORT.partial(df).where("which = 0")
    assert states.count() == 16 and REPORT.of(df).first()["ips"] == 1000


def _files(df):
    """The event days of the silver files that a scan opens."""
    return sorted({r[0].split("event_date=")[1].split("/")[0] for r in df.select(F.input_file_name()).distinct().collect()})


@pytest.mark.parametrize("table", sorted(medallion.ALL_HISTORY))
def test_history_is_kept_up_by_day(spark, table):
    root = shared_dir(spark, "medallion")
    log = flows.batch_topic_log(spark, SF, only=["fg_raw_all"])
    medallion.run_medallion(spark, log, root, fallback=run_ts(), ingest_ts=run_ts(), reports=(table,))
    silver = scan(spark, f"{root}/silver/fg_events_clean")
    full = sorted(map(str, medallion.GOLD_TABLES[table](silver).collect()))
    assert sorted(map(str, scan(spark, f"{root}/gold/{table}").collect())) == full
    day = silver.agg(F.min("event_date")).first()[0]
    paths = medallion.ensure_tables(spark, root)
    read = []
    partial = Report.partial

    def spy(self, rows, extra=()):
        read.append(rows)
        return partial(self, rows, extra)

    Report.partial = spy
    try:
        out = medallion.history_of(spark, paths, table, [day])
    finally:
        Report.partial = partial
    assert _files(read[0]) == [str(day)]
    assert "fg_events_clean" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, out.collect())) == full
    # A day whose events change replaces its states; a day that has gone leaves none.
    medallion.drop_partition(spark, f"{root}/silver/fg_events_clean/event_date={day}")
    left = sorted(map(str, medallion.GOLD_TABLES[table](scan(spark, f"{root}/silver/fg_events_clean")).collect()))
    assert sorted(map(str, medallion.history_of(spark, paths, table, [day]).collect())) == left != full
    assert day != dt.date.min
