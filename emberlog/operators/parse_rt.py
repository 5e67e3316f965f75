"""Real-time firewall-line parser (quote-aware CSV, key=value message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import REALTIME, is_anomaly, severity
from ..functions.text import strip_ws, to_float, to_int, try_whole, with_kv
from ..schemas import RT_FIELDS

_CSV_FIELDS = ["device_id", "facility", "priority", "level", "tag", "ts",
               "program", "msg", "seq"]
_CSV_SCHEMA = ", ".join(f"`{n}` STRING" for n in _CSV_FIELDS)
_QUOTED = r'"(?:[^"]|"")*"'
_CSV_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}

# String keys of the message that default to '' when absent.
STRING_KEYS = ["action", "status", "srcip", "dstip"]
# ... and numeric keys with their defaults.
INT_KEYS = {"srcport": "int", "dstport": "int", "sentbyte": "long",
            "rcvdbyte": "long"}

ID_UUID = "uuid"
ID_SOURCE = "source"


def event_id_expr(id_mode: str, source_col: str = "line_no",
                  prefix: str = "fw-") -> Column:
    """Random v4 UUID, or a replay-stable id from the source position."""
    if id_mode == ID_UUID:
        return F.expr("uuid()")
    if id_mode == ID_SOURCE:
        return F.concat(F.lit(prefix), F.col(source_col).cast("string"))
    raise ValueError(f"unknown id_mode {id_mode!r}")


def parse_rt_lines(lines: DataFrame, id_mode: str = ID_UUID,
                   value_col: str = "value", source_col: str = "line_no",
                   ingest_ts: Column | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """Parse raw lines into the 21-field real-time event.

    A line is kept when it has at least 8 ``;``-separated fields (quotes
    respected) and a device_id that is neither empty nor the header literal.
    """
    keep = list(keep or [])
    src = [source_col] if id_mode == ID_SOURCE and source_col not in keep else []
    c = F.col
    # Exploded, so that the filter below is not pushed through with a parse of its own for each field it asks for.
    staged = (lines.select(*keep, *src, strip_ws(c(value_col)).alias("_line"))
              .select("*", F.explode(F.array(F.from_csv(c("_line"), _CSV_SCHEMA, _CSV_OPTIONS))).alias("_r")))
    r = c("_r")
    # from_csv yields null for both an empty and a missing 8th field: then the
    # separators outside quotes are counted (rare, so the regex is not hot).
    outside = F.regexp_replace("_line", _QUOTED, "")
    has8 = r["msg"].isNotNull() | (F.size(F.split(outside, ";")) >= 8)
    dev = F.coalesce(r["device_id"], F.lit(""))
    df = (staged.where(has8 & (dev != "") & (dev != "device_id"))
          .select(*keep, *src,
                  dev.alias("device_id"),
                  to_int(r["facility"], 1).alias("facility_raw"),
                  to_int(r["priority"], 7).alias("_priority"),
                  F.coalesce(r["tag"], F.lit("")).alias("tag"),
                  F.coalesce(r["ts"], F.lit("")).alias("ts"),
                  F.coalesce(r["program"], F.lit("")).alias("program"),
                  F.replace(F.coalesce(r["msg"], F.lit("")), F.lit('"'), F.lit(""))
                  .alias("message")))
    df = with_kv(df, "message", STRING_KEYS + list(INT_KEYS) + ["latency"])
    cols = {k: F.coalesce(c(f"_v_{k}"), F.lit("")) for k in STRING_KEYS}
    for k, t in INT_KEYS.items():
        cols[k] = F.coalesce(try_whole(f"_v_{k}", t), F.lit(0).cast(t))
    cols["latency"] = to_float(c("_v_latency"), 0.0)
    sev = severity(c("_priority"), REALTIME)
    ingested = ingest_ts if ingest_ts is not None else F.current_timestamp()
    typed = df.select(*keep, *src, "device_id", "facility_raw", "tag", "ts", "program",
                      "message", *[v.alias(n) for n, v in cols.items()],
                      sev["severity"].alias("severity"),
                      sev["severity_label"].alias("severity_label"))
    out = typed.select(
        "*",
        event_id_expr(id_mode, source_col).alias("event_id"),
        (c("sentbyte") + c("rcvdbyte")).alias("total_bytes"),
        is_anomaly("action", "status", c("severity")).alias("is_anomaly"),
        F.date_format(ingested, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ingested_at"),
    )
    return out.select(*keep, *[n for n, _ in RT_FIELDS])
