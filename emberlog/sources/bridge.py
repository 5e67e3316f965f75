"""Bridge from the driver's ``events`` table to raw log text.

The pipeline's inputs are firewall log lines and network-device CSV records.
No such files ship with the test data, so this module derives them from
``events`` with column expressions (one map-side pass, no shuffle): every
event yields one firewall line (some twice, as a replayed duplicate) plus,
for a deterministic subset, junk lines (blank, header, truncated) that the
parsers must drop; and one network record.

``firewall_truth`` / ``network_truth`` hold the intended field values; the
renderers turn them into quote-mangled text.  The oracle SQL computes expected
results from the same truth columns directly, never by re-parsing text, so
the parsers are checked end to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed header lines.
FIREWALL_HEADER = "device_id;facility;priority;level;tag;ts;program;msg;seq"
NETWORK_HEADER = "timestamp;device_id;program;msg"


def _s(c) -> Column:
    return c.cast("string")


def _lpad(c, n) -> Column:
    return F.lpad(_s(c), n, "0")


def _with_k(events: DataFrame) -> DataFrame:
    return (events.select("event_id", "ts", "user_id", "event_type", "value",
                          "props")
            .withColumn("k", F.regexp_extract("props", r"([0-9]+)", 1)
                        .try_cast("int")))


def firewall_truth(events: DataFrame) -> DataFrame:
    """Intended firewall event fields, one row per ``events`` row."""
    e = _with_k(events)
    k, u, eid, et = F.col("k"), F.col("user_id"), F.col("event_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    ts_kind = k % 8
    return e.select(
        eid.alias("src_id"), ts.alias("src_ts"), u.alias("user_id"), k,
        F.col("value"),
        (F.concat(F.lit("FG"), _lpad(u, 4))).alias("device_id"),
        (16 + k % 8).alias("facility"),
        (k % 25 == 7).alias("prio_bad"),
        (eid % 8).cast("int").alias("priority"),
        F.when(k % 3 == 0, "traffic").when(k % 3 == 1, "vpn").otherwise("utm").alias("tag"),
        F.when(k % 2 == 0, "fwd").otherwise("ipsd").alias("program"),
        F.when(ts_kind.isin(1, 5), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
         .when(ts_kind.isin(2, 6), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
         .when(ts_kind == 3, F.lit("bad"))
         .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("ts_text"),
        F.when((ts_kind == 3) & (k != 99),
               F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("eventtime"),
        F.when(k % 20 != 17, et).alias("event_type"),
        F.when(k % 2 == 0, "forward").otherwise("local").alias("subtype"),
        F.when(et == "error", "deny").when(et == "signup", "fail")
         .when(et == "view", "").otherwise("accept").alias("action"),
        F.when((et == "error") | (k % 10 == 9), "failed")
         .when(et == "view", "").otherwise("success").alias("status"),
        F.when(k % 20 == 13, "").otherwise(_lpad(eid, 10)).alias("logid"),
        F.when(k % 6 == 0, "VPN tunnel down").when(k % 6 == 3, "Admin login ok")
         .alias("logdesc"),
        F.concat(F.lit("10.0."), _s(u % 16), F.lit("."), _s(k)).alias("srcip"),
        F.concat(F.lit("172.16."), _s(k % 8), F.lit("."), _s(u % 32)).alias("dstip"),
        (1024 + eid % 50000).cast("int").alias("srcport"),
        F.when(k % 3 == 0, 443).when(k % 3 == 1, 53).otherwise(80).alias("dstport"),
        F.when(k % 4 == 0, 6).when(k % 4 == 1, 17).when(k % 4 == 2, 1)
         .otherwise(47).alias("proto"),
        F.when(k % 3 == 0, "HTTPS").when(k % 3 == 1, "DNS").otherwise("HTTP").alias("service"),
        F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("policy-"), _s(k % 10)))
         .alias("policyname"),
        F.when(k % 10 == 0, "").when(k % 2 == 0, "policy").otherwise("proxy-policy")
         .alias("policytype"),
        _s(eid * 7 + 1000).alias("sessionid"),
        F.floor(F.col("value") * 100).cast("long").alias("sentbyte"),
        (k * 10).cast("long").alias("rcvdbyte"),
        (u % 4).cast("int").alias("vwlid"),
        F.concat(F.lit("FGT-"), _lpad(u % 100, 3)).alias("devname"),
        F.when(u % 3 == 0, "").otherwise("firewall").alias("devtype"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("vendor"), _s(k % 3)))
         .alias("srchwvendor"),
        F.concat(F.lit("aa:bb:cc:"), _lpad(u % 100, 2), F.lit(":"), _lpad(k, 2),
                 F.lit(":00")).alias("srcmac"),
        (k % 5 != 0).alias("lat_present"),
        F.when(k % 2 == 0, "text").otherwise("key").alias("lat_form"),
        (k % 30 != 29).alias("has_seq"),
        (k % 50 == 0).alias("dup"),
        (eid % 1000 == 2).alias("bom"),
        (eid % 7 == 0).alias("cr"),
        # Texts that need more than a plain cast: letters behind a port, commas
        # in a byte count, latencies with up to five decimals.
        (eid % 11 == 3).alias("port_messy"),
        ((eid % 13 == 5) & (F.floor(F.col("value") * 100) >= 1000)).alias("bytes_messy"),
        F.when(eid % 3 == 0, F.concat(_s(F.col("value")), _lpad(eid % 1000, 3)))
         .otherwise(_s(F.col("value"))).alias("lat_text"),
        (eid % 500 == 3).alias("blank_msg"),
    )


def _tok(key: str, val: Column, cond: Column | None = None,
         quote: str = "") -> Column:
    """``key=<quote>val<quote>`` or null (skipped by ``concat_ws``)."""
    t = F.concat(F.lit(f"{key}={quote}"), val, F.lit(quote))
    return t if cond is None else F.when(cond, t)


def _msg_tokens() -> list[Column]:
    """Message tokens, with the quotes of the mangled line form."""
    q4, q2 = '""""', '""'
    c = F.col
    lat = c("lat_text")
    port = F.when(c("port_messy"), F.concat(_s(c("srcport")), F.lit("abc"))).otherwise(_s(c("srcport")))
    sent = F.when(c("bytes_messy"), F.concat(_s(F.floor(c("sentbyte") / 1000)), F.lit(","), _lpad(c("sentbyte") % 1000, 3))) \
        .otherwise(_s(c("sentbyte")))
    return [
        _tok("logid", c("logid"), c("logid") != ""),
        _tok("type", c("event_type"), c("event_type").isNotNull()),
        _tok("subtype", c("subtype")),
        _tok("action", c("action"), c("action") != ""),
        _tok("status", c("status"), c("status") != ""),
        _tok("logdesc", c("logdesc"), c("logdesc").isNotNull(), q2),
        _tok("srcip", c("srcip"), None, q4),
        _tok("dstip", c("dstip"), None, q2),
        _tok("srcport", port),
        _tok("dstport", _s(c("dstport"))),
        _tok("proto", _s(c("proto"))),
        _tok("service", c("service")),
        _tok("policyname", c("policyname"), c("policyname") != ""),
        _tok("policytype", c("policytype"), c("policytype") != ""),
        _tok("sessionid", c("sessionid")),
        _tok("sentbyte", sent),
        _tok("rcvdbyte", _s(c("rcvdbyte"))),
        _tok("vwlid", _s(c("vwlid"))),
        _tok("devname", c("devname")),
        _tok("devtype", c("devtype"), c("devtype") != ""),
        _tok("srchwvendor", c("srchwvendor"), c("srchwvendor") != ""),
        _tok("srcmac", c("srcmac")),
        _tok("eventtime", c("eventtime"), c("eventtime").isNotNull()),
        F.when(c("lat_present") & (c("lat_form") == "text"),
               F.concat(F.lit("latency: "), lat)),
        F.when(c("lat_present") & (c("lat_form") == "key"),
               F.concat(F.lit("latency="), lat)),
    ]


def firewall_lines(events: DataFrame) -> DataFrame:
    """Raw firewall lines ``value`` with a source position ``line_no``.

    ``device_id;facility;priority;level;tag;ts;program;"msg";seq`` with
    doubled / quadrupled quotes inside msg, an optional BOM, trailing CR,
    missing seq, replayed duplicates, lines with an empty msg, and junk lines
    (blank, header, truncated).  Line numbers are ``4 * src_id + j`` (j = 0 line, 1 replay,
    2 and 3 junk).
    """
    t = firewall_truth(events)
    c = F.col
    prio = F.when(c("prio_bad"), F.lit("x")).otherwise(_s(c("priority")))
    msg = F.concat(F.lit('"'), F.concat_ws(" ", *_msg_tokens()), F.lit('"'))
    body = F.concat_ws(";", c("device_id"), _s(c("facility")), prio,
                       F.lit("notice"), c("tag"), c("ts_text"), c("program"), msg)
    line = F.concat(F.when(c("bom"), F.lit("\ufeff")).otherwise(F.lit("")), body,
                    F.when(c("has_seq"), F.concat(F.lit(";"), _s(c("src_id"))))
                    .otherwise(F.lit("")),
                    F.when(c("cr"), F.lit("\r")).otherwise(F.lit("")))
    base = c("src_id") * 4
    blank = F.concat_ws(";", c("device_id"), _s(c("facility")), prio, F.lit("notice"),
                        c("tag"), c("ts_text"), c("program"), F.lit(""), _s(c("src_id")))
    entries = F.array(
        F.struct(line.alias("value"), base.alias("line_no")),
        F.when(c("blank_msg"), F.struct(blank.alias("value"), (base + 3).alias("line_no"))),
        F.when(c("dup"), F.struct(line.alias("value"), (base + 1).alias("line_no"))),
        F.when(c("k") % 40 == 39,
               F.struct(F.concat_ws(";", c("device_id"), _s(c("facility")),
                                    F.lit("x;y;z")).alias("value"),
                        (base + 2).alias("line_no"))),
        F.when(c("src_id") % 500 == 1,
               F.struct(F.lit("   ").alias("value"), (base + 3).alias("line_no"))),
        F.when(c("src_id") % 1000 == 0,
               F.struct(F.lit(FIREWALL_HEADER).alias("value"),
                        (base + 3).alias("line_no"))),
    )
    return (t.select(F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("l"))
            .select(F.col("l.value").alias("value"),
                    F.col("l.line_no").cast("long").alias("line_no")))


def network_truth(events: DataFrame) -> DataFrame:
    """Intended network-record fields, one row per ``events`` row."""
    e = _with_k(events)
    k, u = F.col("k"), F.col("user_id")
    ip1 = F.concat(F.lit("10.1."), _s(u % 16), F.lit("."), _s(k))
    ip2 = F.concat(F.lit("10.2."), _s(k), F.lit("."), _s(u % 16))
    mac = F.concat(F.lit("aa:bb:cc:00:"), _lpad(u % 100, 2), F.lit(":"), _lpad(k, 2))
    mac_dash = F.regexp_replace(mac, ":", "-")
    kind = k % 10
    msg = (F.when(kind == 0, F.concat(F.lit("dhcp lease "), ip1, F.lit(" to "), mac))
           .when(kind == 1, F.concat(F.lit("DHCPACK on "), ip1, F.lit(" to "), mac_dash,
                                     F.lit(" via "), ip2))
           .when(kind == 2, F.concat(F.lit("WLAN station join "), mac))
           .when(kind == 3, F.concat(F.lit("IP_CONFLICT "), ip1, F.lit(" with "), ip2,
                                     F.lit(" "), mac))
           .when(kind == 4, F.concat(F.lit("USER_OFFLINE "), ip1))
           .when(kind == 5, F.concat(F.lit("arp who-has "), ip2, F.lit(" tell "), ip1))
           .when(kind == 6, F.concat(F.lit("BGP neighbor "), ip2, F.lit(" Down")))
           .when(kind == 7, F.concat(F.lit("FEI_COMM link lost on slot "), _s(u % 8)))
           .when(kind == 8, F.concat(F.lit("STATUS changed on port "), _s(u % 48)))
           .otherwise(F.concat(F.lit("user_offline "), ip1, F.lit(" timeout"))))
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("src_id"), ts.alias("src_ts"), u.alias("user_id"), k,
        F.concat(F.lit("SW"), _lpad(u % 50, 3)).alias("device_id"),
        F.col("event_type").alias("program"),
        F.when(k % 25 == 24, F.lit("n/a"))
         .otherwise(F.date_format(ts, "dd/MM/yyyy HH:mm")).alias("ts_text"),
        F.when(k % 33 != 32, msg).alias("msg"),
        (k % 9 == 4).alias("padded"),
    )


def network_lines(events: DataFrame) -> DataFrame:
    """Raw ``timestamp;device_id;program;msg`` CSV lines with ``line_no``.

    A header line precedes every 1000th record (one per rotated file); a
    record without msg has three fields only; some device ids are padded.
    """
    t = network_truth(events)
    c = F.col
    dev = F.when(c("padded"), F.concat(F.lit("  "), c("device_id"), F.lit(" ")))\
        .otherwise(c("device_id"))
    rec = F.concat_ws(";", c("ts_text"), dev, c("program"), c("msg"))
    base = c("src_id") * 2
    entries = F.array(
        F.when(c("src_id") % 1000 == 0,
               F.struct(F.lit(NETWORK_HEADER).alias("value"), base.alias("line_no"))),
        F.struct(rec.alias("value"), (base + 1).alias("line_no")),
    )
    return (t.select(F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("l"))
            .select(F.col("l.value").alias("value"),
                    F.col("l.line_no").cast("long").alias("line_no")))


# Events that one task renders, at most and (while cores are idle) at least.
MOST_PER_TASK, LEAST_PER_TASK = 131_072, 16_384


def spread_events(events: DataFrame, copies: int = 1) -> DataFrame:
    """The same rows in tasks of bounded size (``copies``: as how many rows an event goes on at most).

    A table may be one file of one row group, which a scan reads in one task,
    whatever its size; its rows are narrow, the lines made from them are not.
    The count comes from the footers.
    """
    rows = events.count()
    cores = events.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(2 * cores, rows // LEAST_PER_TASK), -(-rows * copies // MOST_PER_TASK))
    return events.repartition(tasks) if tasks > 1 else events


def read_events(spark, sf_dir: str, spread: int | None = None) -> DataFrame:
    """The driver's ``events`` table.

    ``spread`` deals the rows out to that many tasks first: a bench on a file
    of one row group would otherwise render all lines on one core.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return df.repartition(spread) if spread else df
