"""Plan-shape checks: built-in operators only, single scans, map-side reduction."""

import pytest
from pyspark.sql import functions as F

from emberlog.catalog import queries
from emberlog.operators.bronze import dedup_first

SF = "/root/testdata/sf0.001"
BATCH_ONLY = [n for n in sorted(queries()) if not n.startswith(("stream_", "overwrite_", "medallion_", "bronze_from_json"))]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_ONLY)
def test_no_python_no_cartesian_one_scan(spark, name):
    plan = _plan(queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)
    # every query reads the source table once per union branch
    scans = plan.count("FileScan parquet")
    assert scans == (2 if name == "view_global_events" else 1), (name, scans)


def test_dedup_reduces_map_side(spark):
    plan = _plan(queries()["bronze_dedup"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2          # partial (pre-shuffle) + final
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_top_k_views_use_take_ordered(spark):
    for name in ("view_top_threat_ips", "view_wlan_alerts", "view_global_events"):
        assert "TakeOrderedAndProject" in _plan(queries()[name](spark, SF)), name


def test_hot_key_dedup(spark):
    # a third of all rows share one key (the "no logid" group)
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(""))
                               .otherwise(F.col("id").cast("string")).alias("k"),
                               F.col("id").alias("off"), (F.col("id") * 7).alias("payload"))
    out = dedup_first(df.repartition(8), ["k"], ["off"])
    assert out.count() == n - n // 3 + 1
    hot = out.where(F.col("k") == "").collect()
    assert len(hot) == 1 and hot[0].off == 0
