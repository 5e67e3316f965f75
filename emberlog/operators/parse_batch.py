"""Batch firewall-line parser: text line -> typed event (column expressions).

Line format ``device_id;facility;priority;level;tag;ts;program;"msg";seq``
where msg carries space-separated ``key=value`` tokens mangled by repeated
CSV quoting.  Every rule is a built-in expression (no shuffle, no Python).  The
parser is too large for one generated method that HotSpot compiles, so
``session.CODEGEN_CONF`` lets Spark run it as separate compiled projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import BATCH, is_anomaly, severity
from ..functions.text import (clean_field, default_if_blank, int_prefix,
                              strip_ws, trim_quotes, with_kv)
from ..schemas import BATCH_PARSED_COLUMNS

# Message keys kept by the batch parser, and their output names.
KV_KEYS = [
    "type", "subtype", "action", "status", "logid", "logdesc",
    "srcip", "dstip", "srcport", "dstport", "proto", "service",
    "policyname", "policytype", "poluuid",
    "sentbyte", "rcvdbyte", "sessionid",
    "vwlid", "vwlquality", "devname", "devtype", "srchwvendor", "srcmac",
    "eventtime",
]
KV_RENAME = {"type": "event_type", "logid": "event_id"}

# String fields whose residual edge quotes are removed.
QUOTE_TRIMMED = [
    "srcmac", "vwlquality", "poluuid", "policyname", "policytype",
    "sessionid", "devname", "devtype", "srchwvendor", "srcip", "dstip",
    "service", "event_id", "logdesc",
]
# String defaults (blank -> default) and integer fields.
STRING_DEFAULTS = {
    "event_type": "unknown", "subtype": "", "action": "", "status": "",
    "event_id": "", "logdesc": "", "srcip": "", "dstip": "", "service": "",
    "policyname": "", "policytype": "", "poluuid": "", "sessionid": "",
    "vwlquality": "", "devname": "", "devtype": "", "srchwvendor": "",
    "srcmac": "", "eventtime": "",
}
INT_FIELDS = {"srcport": "int", "dstport": "int", "proto": "int",
              "sentbyte": "long", "rcvdbyte": "long", "vwlid": "int"}

# Message prefix, latency text, header lines.
MESSAGE_PREFIX_CHARS = 200
_LATENCY_TEXT = r"latency:\s*([0-9]+(?:\.[0-9]+)?)"
_HEADER_PREFIXES = ("device_id", "id,", "id;")


def normalize_line(value) -> Column:
    """Strip whitespace, then a leading BOM and the blanks behind it.

    (A trailing CR is whitespace, so the strip has already removed it.)
    """
    v = strip_ws(value)
    return F.when(v.startswith("\ufeff"), strip_ws(F.substr(v, F.lit(2)))).otherwise(v)


def unquote_outer(m) -> Column:
    """Drop one pair of outer double quotes (``m`` must be a column reference)."""
    m = F.col(m) if isinstance(m, str) else m
    n = F.length(m)
    return F.when((n >= 2) & m.startswith('"') & m.endswith('"'),
                  m.substr(F.lit(2), n - 2)).otherwise(m)


def collapse_quotes(m) -> Column:
    """``""""v""""`` -> ``v``, then remaining ``""`` -> '', then strip.

    Both steps shrink every run of quotes by an even count, and the second
    leaves ``len % 2`` quotes per run, so the pair is one literal replace of
    ``""`` (left to right, non-overlapping) -- no regex needed.
    """
    return strip_ws(F.replace(m, F.lit('""'), F.lit("")))


def parse_batch_lines(lines: DataFrame, ingest_ts: Column | None = None,
                      value_col: str = "value", keep: list[str] | None = None,
                      message_chars: int = MESSAGE_PREFIX_CHARS) -> DataFrame:
    """Parse raw lines into the 36-field firewall event of the batch flow.

    ``message_chars``: how much of a message without logdesc stands for it.

    Drops blank lines, header lines, lines with fewer than 7 ``;`` and rows
    with an empty device_id.  ``keep`` lists input columns carried through
    (e.g. a source offset).

    Intermediate values are materialised as columns, step by step: an
    expensive expression referenced several times is then computed once per
    row (Catalyst does not inline it again).
    """
    keep = list(keep or [])
    c = F.col
    df = (lines.select(*keep, normalize_line(c(value_col)).alias("_line"))
          .where((c("_line") != "")
                 & ~c("_line").startswith(_HEADER_PREFIXES[0])
                 & ~c("_line").startswith(_HEADER_PREFIXES[1])
                 & ~c("_line").startswith(_HEADER_PREFIXES[2]))
          # Exploded, so that the filters below are not pushed through with a split of their own.
          .select(*keep, F.explode(F.array(F.split("_line", ";", 8))).alias("_p"))
          .where(F.size("_p") == 8))
    p = c("_p")
    df = df.select(
        *keep,
        clean_field(F.get(p, 0)).alias("device_id"),
        int_prefix(F.get(p, 2)).alias("priority"),
        clean_field(F.get(p, 4)).alias("tag"),
        clean_field(F.get(p, 5)).alias("ts"),
        clean_field(F.get(p, 6)).alias("program"),
        F.get(p, 7).alias("_rest"),
    ).where(c("device_id") != "")
    # Tail: the last ';' separates msg from seq; no ';' -> seq "0".
    df = df.select(*keep, "device_id", "priority", "tag", "ts", "program", "_rest",
                   F.substring_index("_rest", ";", -1).alias("_after"),
                   (F.instr("_rest", ";") > 0).alias("_has_semi"))
    msg_part = F.when(c("_has_semi"),
                      F.substr(c("_rest"), F.lit(1),
                               F.length("_rest") - F.length("_after") - 1)).otherwise(c("_rest"))
    df = df.select(
        *keep, "device_id", "priority", "tag", "ts", "program",
        strip_ws(msg_part).alias("_m1"),
        F.when(c("_has_semi"), trim_quotes(strip_ws("_after"))).otherwise(F.lit("0")).alias("seq"),
    )
    df = df.select(*keep, "device_id", "priority", "tag", "ts", "program", "seq",
                   unquote_outer("_m1").alias("_m2"))
    df = df.select(*keep, "device_id", "priority", "tag", "ts", "program", "seq",
                   collapse_quotes(c("_m2")).alias("_msg"))
    df = df.select("*", F.regexp_extract("_msg", _LATENCY_TEXT, 1).alias("_lat"))
    # Raw key values, one search per key.
    df = with_kv(df, "_msg", KV_KEYS)
    cols = {}
    for key in KV_KEYS:
        name = KV_RENAME.get(key, key)
        v = c(f"_v_{key}")
        if name in QUOTE_TRIMMED:
            v = trim_quotes(v)
        if name in INT_FIELDS:
            v = int_prefix(v, 0, INT_FIELDS[name])
        else:
            v = default_if_blank(v, STRING_DEFAULTS.get(name, ""))
        cols[name] = v
    sev = severity(c("priority"), BATCH)
    df = df.select(*keep, "device_id", "tag", "ts", "program", "seq", "_msg", "_lat",
                   *[v.alias(n) for n, v in cols.items()],
                   sev["severity"].alias("severity"),
                   sev["severity_label"].alias("severity_label"))
    lat = F.when(c("_lat") != "", c("_lat").try_cast("float"))
    message = F.when(strip_ws("logdesc") != "", strip_ws("logdesc")) \
        .otherwise(c("_msg").substr(1, message_chars))
    ingested = ingest_ts if ingest_ts is not None else F.current_timestamp()
    out = df.select(
        "*",
        F.coalesce(lat, F.lit(0.0).cast("float")).alias("latency"),
        (c("sentbyte") + c("rcvdbyte")).alias("total_bytes"),
        message.alias("message"),
        is_anomaly("action", "status", c("severity")).alias("is_anomaly"),
        F.date_format(ingested, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ingested_at"),
    )
    return out.select(*keep, *BATCH_PARSED_COLUMNS)
