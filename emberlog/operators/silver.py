"""Silver: typed, trimmed, enriched events with a parsed event_time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import (SILVER_EVENTTIME_FORMATS, SILVER_TS_FORMATS,
                                   fallback_ts, parse_first)
from ..schemas import SILVER_COLUMNS

# String columns trimmed in silver, numeric null fills.
TRIMMED = [
    "event_id", "device_id", "message", "tag", "program", "event_type",
    "subtype", "action", "status", "srcip", "dstip", "service", "policyname",
    "policytype", "poluuid", "sessionid", "vwlquality", "devname", "devtype",
    "srchwvendor", "srcmac", "severity_label",
]
NULL_FILL = {"srcport": 0, "dstport": 0, "proto": 0, "sentbyte": 0,
             "rcvdbyte": 0, "total_bytes": 0, "vwlid": 0, "is_anomaly": 0,
             "latency": 0.0, "severity": 1}
# Fixed value: words of a VPN failure.
VPN_PATTERN = "(?i)IPsec|IKE|VPN"


def event_time(fallback=None):
    ts = F.trim(F.col("ts"))
    et = F.trim(F.col("eventtime"))
    return F.coalesce(*parse_first(ts, SILVER_TS_FORMATS),
                      *parse_first(et, SILVER_EVENTTIME_FORMATS),
                      fallback_ts(fallback))


def event_time_of_ts():
    """The time that ``ts`` alone states, else null."""
    return F.coalesce(*parse_first(F.trim(F.col("ts")), SILVER_TS_FORMATS))


def proto_label(proto):
    return (F.when(proto == 6, "TCP").when(proto == 17, "UDP")
            .when(proto == 1, "ICMP").otherwise(proto.cast("string")))


def latency_bucket(lat):
    """Bucket of the *raw* latency: null falls through to ``critical``."""
    return (F.when(lat == 0, "no_data").when(lat < 5, "excellent")
            .when(lat < 20, "good").when(lat < 50, "degraded")
            .otherwise("critical"))


def to_silver(bronze: DataFrame, fallback=None) -> DataFrame:
    """Bronze -> silver (40 columns).  ``fallback`` pins "now" for bad times."""
    c = F.col
    enriched = bronze.select(
        "*",
        event_time(fallback).alias("event_time"),
        proto_label(c("proto")).alias("proto_label"),
        latency_bucket(c("latency")).alias("latency_bucket"),
        F.when(c("message").rlike(VPN_PATTERN) & (c("status") == "failed"), 1)
         .otherwise(0).alias("is_vpn_failure"),
    )
    out = []
    for name in SILVER_COLUMNS:
        if name in TRIMMED:
            out.append(F.trim(c(name)).alias(name))
        elif name in NULL_FILL:
            v = NULL_FILL[name]
            lit = F.lit(v).cast("float") if isinstance(v, float) else F.lit(v)
            out.append(F.coalesce(c(name), lit).alias(name))
        elif name == "hour_of_day":
            out.append(F.hour("event_time").alias(name))
        elif name == "day_of_week":
            out.append(F.dayofweek("event_time").alias(name))
        else:
            out.append(c(name))
    return enriched.select(*out).where(c("event_time").isNotNull())
