"""Best-effort times by shape."""

import pytest

from emberlog.functions.timeparse import SHAPES, best_effort, best_effort_ts
from emberlog.operators.serving import load_table, time_quality

T = "2024-03-05 07:09:08"
CASES = {
    T: T, "2024-03-05T07:09:08": T, "2024-03-05T07:09:08Z": T, "2024-03-05T07:09:08.5Z": T, "2024-03-05T07:09:08.123456789Z": T, "2024-03-05T09:09:08+02:00": T,
    "2024-03-05T05:39:08-0130": T, "2024-03-05T07:09:08.25+0000": T, "2024-03-05 09:09:08+02:00": T, "2024-03-05 09:09:08 +0200": T, "2024-03-05 07:09:08.1": T,
    "2024-03-05 07:09": "2024-03-05 07:09:00", "2024-03-05T07:09": "2024-03-05 07:09:00", "2024-03-05": "2024-03-05 00:00:00", "05/03/2024 07:09:08": T,
    "05/03/2024 07:09": "2024-03-05 07:09:00", "05/03/2024": "2024-03-05 00:00:00", "05/03/24 07:09:08": T, "2024/03/05 07:09:08": T, "05-03-2024 07:09:08": T, "05.03.2024 07:09:08": T,
    "5 Mar 2024 07:09:08": T, "05 Mar 2024 07:09:08": T, "Tue, 05 Mar 2024 07:09:08 +0000": T, "Mar 5 2024 07:09:08": T, "05/Mar/2024:09:09:08 +0200": T, "20240305070908": T,
    "20240305T070908Z": T, "20240305": "2024-03-05 00:00:00", "1709622548": T, "1709622548123": T, "1709622548123456": T, "999999999": "2001-09-09 01:46:39", f"  {T} ": T,
    # Right in shape, wrong in value, or in no shape.
    "2024-13-05 07:09:08": None, "2024-03-05T07:09:08Q": None, "5 Xyz 2024 07:09:08": None, "bad": None, "": None, None: None, "12": None, "123456789012": None, "2024-3-5": None,
    "99/99/9999": None, "2024-03-05 07:09:08 tail": None,
}


def test_shapes(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", best_effort("t").cast("string").alias("v")).collect()}
    assert got == dict(enumerate(CASES.values()))
    back = rows.select(best_effort_ts("t", "2030-01-01 00:00:00").cast("string").alias("v")).collect()
    assert [r.v for r in back].count("2030-01-01 00:00:00") == list(CASES.values()).count(None)
    assert len(SHAPES) == len(dict(SHAPES))


@pytest.mark.parametrize("table", ["t_raw_events", "t_network_logs"])
def test_what_fell_back_is_counted(spark, table):
    topic = {"t_raw_events": "fg_raw_all", "t_network_logs": "fg_network_logs"}[table]
    log = spark.createDataFrame([(topic, 0, i, f"d{i % 2}", t) for i, t in enumerate([T, "bad", None, "1709622548"])], "topic string, partition int, offset long, device_id string, ts string")
    assert sorted(map(tuple, time_quality(log, table).collect())) == [("d0", 2, 1), ("d1", 2, 1)]
    assert "ts_fell_back" not in load_table(log, table).columns
