"""Golden micro-cases for the parser rules (inline rows)."""

from pyspark.sql import functions as F

from emberlog.operators.parse_batch import parse_batch_lines
from emberlog.operators.parse_net import parse_network_records
from emberlog.operators.parse_rt import parse_rt_lines


def _lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, line_no long")


def _batch(spark, *values):
    return [r.asDict() for r in parse_batch_lines(_lines(spark, *values), keep=["line_no"])
            .orderBy("line_no").collect()]


def _rt(spark, *values):
    return [r.asDict() for r in parse_rt_lines(_lines(spark, *values), id_mode="source",
                                               keep=["line_no"]).orderBy("line_no").collect()]


LINE = 'FG0008;23;{p};5;vpn;2024-01-01 00:00:07;fg;"{msg}";{seq}'


def test_drops_header_blank_and_short_lines(spark):
    out = _batch(spark, "device_id;facility;priority;level;tag;ts;program;msg;seq",
                 "   ", "a;b;c;d;e;f", ";1;2;3;4;5;6;msg;1",
                 LINE.format(p=3, msg="action=deny", seq=1))
    assert [r["line_no"] for r in out] == [4]


def test_priority_unparsable_profiles(spark):
    line = LINE.format(p="x", msg="action=accept", seq=1)
    assert _batch(spark, line)[0]["severity"] == 5          # batch: 0 -> critical
    rt = _rt(spark, line)[0]
    assert (rt["severity"], rt["severity_label"]) == (2, "info")  # real-time: 7 -> info


def test_priority_seven(spark):
    line = LINE.format(p=7, msg="x=1", seq=1)
    b, r = _batch(spark, line)[0], _rt(spark, line)[0]
    assert (b["severity"], b["severity_label"]) == (1, "ok")
    assert (r["severity"], r["severity_label"]) == (2, "info")


def test_tail_without_seq(spark):
    out = _batch(spark, 'FG1;1;3;5;t;2024-01-01 00:00:00;p;"action=deny status=x"')[0]
    assert out["seq"] == "0" and out["action"] == "deny" and out["status"] == "x"


def test_quote_cascade(spark):
    out = _batch(spark, LINE.format(p=3, msg='a=1 srcip=""""10.0.0.1"""" dstip=""10.0.0.2""', seq=1))[0]
    assert out["srcip"] == "10.0.0.1" and out["dstip"] == "10.0.0.2"


def test_latency_text_vs_key(spark):
    lines = [LINE.format(p=3, msg=m, seq=1) for m in ("latency: 6.55", "latency=6.55", "a=1")]
    b = [r["latency"] for r in _batch(spark, *lines)]
    r = [x["latency"] for x in _rt(spark, *lines)]
    assert [round(x, 2) for x in b] == [6.55, 0.0, 0.0]
    assert [round(x, 2) for x in r] == [0.0, 6.55, 0.0]


def test_kv_first_value_and_cut_at_blank(spark):
    out = _batch(spark, LINE.format(p=3, msg='logdesc=""SSL VPN up"" action=deny action=accept',
                                    seq=1))[0]
    assert out["message"] == "SSL" and out["action"] == "deny"


def test_message_prefix_200(spark):
    msg = "a=" + "x" * 298
    out = _batch(spark, LINE.format(p=3, msg=msg, seq=1))[0]
    assert out["message"] == msg[:200]


def test_defaults_and_anomaly(spark):
    out = _batch(spark, LINE.format(p=6, msg="status=failed srcport=abc", seq=1))[0]
    assert out["event_type"] == "unknown" and out["srcport"] == 0
    assert out["is_anomaly"] == 1 and out["total_bytes"] == 0


def test_network_classifier_traps(spark):
    recs = spark.createDataFrame(
        [("05/03/2024 07:09", "SW1", "p", m, i) for i, m in enumerate(
            ["STATUS changed", "user_offline now", "WLAN USER_OFFLINE", "dhcp 10.0.0.1 to aa:bb:cc:dd:ee:ff",
             "IP_CONFLICT 1.2.3.4 with 5.6.7.8"])],
        "timestamp string, device_id string, program string, msg string, line_no long")
    out = parse_network_records(recs, id_mode="source", fallback=F.lit("2024-02-01").cast("timestamp"),
                                keep=["line_no"]).orderBy("line_no").collect()
    assert [r.log_type for r in out] == ["wlan", "unknown", "wlan", "dhcp", "ip_conflict"]
    assert out[3].src_ip == "10.0.0.1" and out[3].dst_ip == "" and out[3].mac_address == "aa:bb:cc:dd:ee:ff"
    assert out[4].dst_ip == "5.6.7.8"
    assert out[0].ts == "2024-03-05 07:09:00"


def test_lines_with_empty_message_are_kept(spark):
    lines = ['FG1;1;3;5;t;2024-01-01 00:00:00;p;;9', 'FG1;1;3;5;t;2024-01-01 00:00:00;p;"";9',
             'FG1;1;3;5;t;2024-01-01 00:00:00;p;', 'FG1;1;3;5;t;2024-01-01 00:00:00;p', 'FG1;1;3;5;t;"a;b;c"']
    assert [r["line_no"] for r in _rt(spark, *lines)] == [0, 1, 2]
    assert [r["message"] for r in _rt(spark, *lines)] == ["", "", ""]
    assert [r["line_no"] for r in _batch(spark, *lines)][:2] == [0, 1]


def test_batch_integers_take_leading_digits(spark):
    out = _batch(spark, LINE.format(p="4x", msg="srcport=12abc dstport=443.0 sentbyte=1,234 proto=-", seq=1))[0]
    assert (out["srcport"], out["dstport"], out["sentbyte"], out["proto"], out["severity_label"]) == (12, 443, 1234, 0, "warning")


def test_header_behind_bom_and_blanks(spark):
    assert _batch(spark, "\ufeff  device_id;facility;priority;level;tag;ts;program;msg;seq") == []


def test_logdesc_is_stripped(spark):
    assert _batch(spark, LINE.format(p=3, msg="logdesc=\tup a=1", seq=1))[0]["message"] == "up"


def test_a_line_is_taken_apart_once(spark):
    """Filters must not be pushed through with a parse of their own, nor keys be searched for one by one."""
    lines = spark.createDataFrame([(1, 'd;1;2;n;t;2024-01-01 00:00:00;p;"a=1 srcip=x srcip=y srcport=12ab status= =z";7')], "line_no long, value string")
    for parse, call in ((parse_batch_lines, "split("), (parse_rt_lines, "from_csv(")):
        df = parse(lines, keep=["line_no"])
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower().replace("csvtostructs(", "from_csv(")
        assert plan.count(call) == 1 and "locate(" not in plan
        row = df.first()
        assert (row.srcip, row.srcport, row.dstport, row.status) == ("x", 12 if parse is parse_batch_lines else 0, 0, "")
