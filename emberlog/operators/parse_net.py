"""Network-device records: classify, extract addresses, enrich."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.netlog import first_mac, ipv4_all, log_type, nth_or_blank
from ..functions.text import strip_ws
from ..functions.timeparse import fallback_ts
from ..schemas import NETWORK_CSV_SCHEMA

_CSV_SCHEMA = ", ".join(f"`{f.name}` STRING" for f in NETWORK_CSV_SCHEMA.fields)
_CSV_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
NETWORK_TS_FORMAT = "dd/MM/yyyy HH:mm"
TOPIC_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def records_from_lines(lines: DataFrame, value_col: str = "value",
                       keep: list[str] | None = None) -> DataFrame:
    """``timestamp;device_id;program;msg`` text lines -> record columns.

    Header lines (``timestamp;...``, one per source file) are dropped.  For
    whole files ``sources.lines.read_network_csv`` does the same with the CSV
    reader.
    """
    keep = list(keep or [])
    v = F.col(value_col)
    rec = F.from_csv(v, _CSV_SCHEMA, _CSV_OPTIONS)
    return (lines.where(~strip_ws(v).startswith("timestamp;") & (strip_ws(v) != ""))
            .select(*keep, rec.alias("_r"))
            .select(*keep, *[F.col("_r")[f.name].alias(f.name)
                             for f in NETWORK_CSV_SCHEMA.fields]))


def parse_network_records(records: DataFrame, id_mode: str = "uuid",
                          source_col: str = "line_no", fallback=None,
                          keep: list[str] | None = None) -> DataFrame:
    """Parse + enrich network records into the published network event.

    Output: event_id, device_id, ts (``yyyy-MM-dd HH:mm:ss`` text), program,
    log_type, message, src_ip, dst_ip, mac_address, raw_length.
    ``fallback`` replaces an unparsable timestamp (default: now).
    """
    keep = list(keep or [])
    extra = [source_col] if id_mode == "source" and source_col not in keep else []
    # A missing trailing field is read as '' (not the text "None").
    base = records.select(
        *keep, *extra,
        strip_ws(F.coalesce(F.col("timestamp"), F.lit(""))).alias("raw_ts"),
        strip_ws(F.coalesce(F.col("device_id"), F.lit(""))).alias("device_id"),
        strip_ws(F.coalesce(F.col("program"), F.lit(""))).alias("program"),
        strip_ws(F.coalesce(F.col("msg"), F.lit(""))).alias("msg"),
    )
    full = F.concat(F.lit("timestamp="), F.col("raw_ts"), F.lit(" | device_id="),
                    F.col("device_id"), F.lit(" | program="), F.col("program"),
                    F.lit(" | msg="), F.col("msg"))
    if id_mode == "uuid":
        eid = F.concat(F.lit("NET-"), F.col("device_id"), F.lit("-"),
                       F.unix_micros(F.current_timestamp()).cast("string"),
                       F.lit("-"), F.substring(F.expr("uuid()"), 1, 8))
    elif id_mode == "source":
        eid = F.concat(F.lit("NET-"), F.col("device_id"), F.lit("-"),
                       F.col(source_col).cast("string"))
    else:
        raise ValueError(f"unknown id_mode {id_mode!r}")
    parsed_ts = F.try_to_timestamp(F.col("raw_ts"), F.lit(NETWORK_TS_FORMAT))
    ts = F.date_format(F.coalesce(parsed_ts, fallback_ts(fallback)), TOPIC_TS_FORMAT)
    ips = ipv4_all(F.col("msg"))
    out = base.select(
        *keep,
        eid.alias("event_id"),
        "device_id",
        ts.alias("ts"),
        "program",
        log_type(F.col("msg")).alias("log_type"),
        full.alias("message"),
        nth_or_blank(ips, 0).alias("src_ip"),
        nth_or_blank(ips, 1).alias("dst_ip"),
        first_mac(F.col("msg")).alias("mac_address"),
        F.char_length(full).cast("long").alias("raw_length"),
    )
    return out


def enrich_network(df: DataFrame, fallback=None) -> DataFrame:
    """Defaults for fields *absent* from a decoded network message.

    Used on JSON input from other producers: event_id -> uuid, device_id /
    program / log_type -> 'unknown', message / addresses -> '', raw_length ->
    byte length of message.  Present values are kept as they are.
    """
    def c(name, default: Column) -> Column:
        return F.coalesce(F.col(name), default).alias(name)
    msg = F.coalesce(F.col("message"), F.lit(""))
    ts = F.date_format(
        F.coalesce(F.try_to_timestamp(F.col("ts"), F.lit(NETWORK_TS_FORMAT)),
                   F.try_to_timestamp(F.col("ts"), F.lit(TOPIC_TS_FORMAT)),
                   fallback_ts(fallback)), TOPIC_TS_FORMAT)
    return df.select(
        c("event_id", F.expr("uuid()")),
        c("device_id", F.lit("unknown")),
        ts.alias("ts"),
        c("program", F.lit("unknown")),
        c("log_type", F.lit("unknown")),
        msg.alias("message"),
        c("src_ip", F.lit("")),
        c("dst_ip", F.lit("")),
        c("mac_address", F.lit("")),
        F.coalesce(F.col("raw_length").cast("long"),
                   F.octet_length(msg).cast("long")).alias("raw_length"),
    )
