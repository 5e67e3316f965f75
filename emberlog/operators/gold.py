"""Gold: six aggregate reports over silver (hash aggregates, partial + final).

Each takes silver and an optional ``days`` range ``(first, last)`` (dates,
inclusive) that prunes event-date partitions when silver is a partitioned
table.  Averages are exact; five of the six are ``Report``s of mergeable states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import count_when, exact_avg
from .states import Report


def _days(silver: DataFrame, days) -> DataFrame:
    if not days:
        return silver
    lo, hi = days
    d = F.to_date("event_time")
    if "event_date" in silver.columns:
        d = F.col("event_date")
    return silver.where((d >= F.lit(lo).cast("date")) & (d <= F.lit(hi).cast("date")))


def _lat_avg():
    return exact_avg("latency")


# Names, order and thresholds of the reports' columns.
KPI_HOURLY = Report(
    keys={"window_start": "date_trunc('hour', event_time)", "event_type": "event_type", "severity_label": "severity_label"},
    inputs={"is_anomaly": "is_anomaly", "severity": "severity", "latency": "CAST(latency AS DOUBLE)", "latency_ms": "latency", "bytes": "total_bytes", "device_id": "device_id", "srcip": "srcip"},
    sums={"total_events": "count(1)", "anomaly_count": "count_if(is_anomaly = 1)", "critical_count": "count_if(severity >= 5)", "error_count": "count_if(severity = 4)",
          "warning_count": "count_if(severity = 3)", "total_bytes": "sum(bytes)"},
    maxima={"max_latency_ms": "latency_ms"}, averages={"avg_latency_ms": "latency"}, long_averages={"avg_bytes": "bytes"},
    distinct={"unique_devices": "device_id", "unique_srcip": "srcip"}, addresses=("srcip",),
    columns=("window_start", "window_start + INTERVAL 1 HOUR AS window_end", "event_type", "severity_label", "total_events", "anomaly_count", "critical_count", "error_count",
             "warning_count", "avg_latency_ms", "max_latency_ms", "total_bytes", "avg_bytes", "unique_devices", "unique_srcip"))

DEVICE_INVENTORY = Report(
    where="device_id IS NOT NULL",
    keys={c: c for c in ("device_id", "devname", "devtype", "srchwvendor", "srcmac")},
    inputs={"is_anomaly": "is_anomaly", "latency": "CAST(latency AS DOUBLE)", "latency_ms": "latency", "bytes": "total_bytes", "event_time": "event_time"},
    sums={"total_events": "count(1)", "total_anomalies": "count_if(is_anomaly = 1)", "total_bytes": "sum(bytes)"},
    maxima={"max_latency_ms": "latency_ms", "last_seen": "event_time"}, averages={"avg_latency_ms": "latency"},
    columns=("device_id", "devname", "devtype", "srchwvendor", "srcmac", "total_events", "total_anomalies", "avg_latency_ms", "max_latency_ms", "total_bytes", "last_seen"))

TOP_THREAT_IPS = Report(
    where="is_anomaly = 1 AND srcip IS NOT NULL AND trim(srcip) <> ''",
    keys={"srcip": "srcip"}, inputs={"severity": "severity", "event_id": "event_id", "event_time": "event_time"},
    sums={"nb_anomalies": "count(1)", "total_events": "count(event_id)"}, maxima={"max_severity": "severity", "last_alert": "event_time"},
    columns=("srcip", "nb_anomalies", "max_severity", "total_events", "last_alert"))

POLICY_TRAFFIC = Report(
    where="trim(policyname) <> ''",
    keys={"policyname": "policyname", "policytype": "policytype"},
    inputs={"is_anomaly": "is_anomaly", "latency": "CAST(latency AS DOUBLE)", "bytes": "total_bytes", "srcip": "srcip", "dstip": "dstip"},
    sums={"total_sessions": "count(1)", "blocked_sessions": "count_if(is_anomaly = 1)", "total_bytes": "sum(bytes)"},
    averages={"avg_latency_ms": "latency"}, distinct={"unique_src_ips": "srcip", "unique_dst_ips": "dstip"}, addresses=("srcip", "dstip"),
    columns=("policyname", "policytype", "total_sessions", "blocked_sessions", "total_bytes", "avg_latency_ms", "unique_src_ips", "unique_dst_ips"))

PROTOCOL_STATS = Report(
    keys={"day": "date_trunc('day', event_time)", "tag": "tag"},
    inputs={"is_anomaly": "is_anomaly", "latency": "CAST(latency AS DOUBLE)", "bytes": "total_bytes", "srcip": "srcip"},
    sums={"total_sessions": "count(1)", "anomaly_sessions": "count_if(is_anomaly = 1)", "total_bytes": "sum(bytes)"},
    averages={"avg_latency_ms": "latency"}, distinct={"unique_sources": "srcip"}, addresses=("srcip",),
    columns=("day", "tag", "total_sessions", "anomaly_sessions", "total_bytes", "avg_latency_ms", "unique_sources"))


def gold_kpi_hourly(silver: DataFrame, days=None) -> DataFrame:
    return KPI_HOURLY.of(_days(silver, days))


def gold_device_inventory(silver: DataFrame, days=None) -> DataFrame:
    return DEVICE_INVENTORY.of(_days(silver, days))


def gold_top_threat_ips(silver: DataFrame, days=None, limit: int | None = None) -> DataFrame:
    """Anomalous sources by count.

    The stored table has no order; ``limit`` gives the top sources by count
    (descending, ties by srcip), as a reader of the table sorts them.
    """
    out = TOP_THREAT_IPS.of(_days(silver, days))
    return out.orderBy(F.desc("nb_anomalies"), "srcip").limit(limit) if limit else out


def gold_sdwan_performance(silver: DataFrame, days=None) -> DataFrame:
    c = F.col
    return (_days(silver, days)
            .where(c("latency") > 0)
            .groupBy("vwlid", F.window("event_time", "1 hour").alias("w"))
            .agg(_lat_avg().alias("avg_latency_ms"),
                 F.max("latency").alias("max_latency_ms"),
                 F.percentile_approx("latency", 0.95).alias("p95_latency_ms"),
                 count_when(c("latency") > 20).alias("degraded_sessions"),
                 count_when(c("latency") > 50).alias("critical_sessions"),
                 F.count(F.lit(1)).alias("total_sessions"),
                 F.sum("total_bytes").alias("total_bytes"))
            .select(c("w.start").alias("window_start"), "vwlid", "avg_latency_ms",
                    "max_latency_ms", "p95_latency_ms", "degraded_sessions",
                    "critical_sessions", "total_sessions", "total_bytes"))


def gold_policy_traffic(silver: DataFrame, days=None) -> DataFrame:
    return POLICY_TRAFFIC.of(_days(silver, days))


def gold_protocol_stats(silver: DataFrame, days=None) -> DataFrame:
    return PROTOCOL_STATS.of(_days(silver, days))


GOLD = {
    "kpi_hourly": gold_kpi_hourly,
    "device_inventory": gold_device_inventory,
    "top_threat_ips": gold_top_threat_ips,
    "sdwan_performance": gold_sdwan_performance,
    "policy_traffic": gold_policy_traffic,
    "protocol_stats": gold_protocol_stats,
}
