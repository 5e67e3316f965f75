"""Analytical views over the serving tables (computed on read).

Every view takes ``tables`` (name -> DataFrame) and returns a DataFrame;
``register_views`` exposes them to SQL as temp views.  Orders that feed a
limit end with a unique tie-break so the limited result is deterministic.
Sets are sorted arrays.  Column names are those of the original views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import exact_avg, round_half_even, sorted_set


def _hour(c="ts"):
    return F.date_trunc("hour", F.col(c))


def _avg_round2(c="latency"):
    """``round(avg(c), 2)``."""
    return round_half_even(exact_avg(c), 2)


def view_top_threat_ips(tables, limit: int | None = 50) -> DataFrame:
    t = tables["t_security"]
    out = (t.where(F.col("is_anomaly") == 1).groupBy("srcip")
           .agg(F.count(F.lit(1)).alias("nb_anomalies"),
                F.max("severity").alias("max_severity"),
                sorted_set("action").alias("actions_vues"),
                F.max("ts").alias("derniere_alerte"))
           .orderBy(F.col("nb_anomalies").desc(), F.col("srcip")))
    return out.limit(limit) if limit else out


def view_device_summary(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_raw_events"]
    out = (t.groupBy("device_id")
           .agg(F.count(F.lit(1)).alias("total_events"),
                F.sum("is_anomaly").alias("total_anomalies"),
                _avg_round2().alias("avg_latency_ms"),
                F.max("latency").alias("max_latency_ms"),
                F.sum("total_bytes").alias("total_bytes"),
                F.max("ts").alias("last_seen"))
           .select("device_id", "total_events", "total_anomalies",
                   "avg_latency_ms", "max_latency_ms", "total_bytes",
                   "last_seen")
           .orderBy(F.col("total_events").desc(), F.col("device_id")))
    return out.limit(limit) if limit else out


def view_severity_per_hour(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_raw_events"]
    out = (t.groupBy(_hour().alias("heure"), "severity_label")
           .agg(F.count(F.lit(1)).alias("nb_events"))
           .orderBy(F.col("heure").desc(), F.col("severity_label")))
    return out.limit(limit) if limit else out


def view_high_latency(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_performance"]
    out = (t.where(F.col("latency") > 20.0)
           .select("ts", "device_id", "srcip", "dstip", "latency", "severity_label")
           .orderBy(F.col("ts").desc(), F.col("latency").desc(), "device_id", "srcip", "dstip", "severity_label"))
    return out.limit(limit) if limit else out


def view_traffic_by_hour(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_traffic"]
    out = (t.groupBy(_hour().alias("heure"))
           .agg(F.count(F.lit(1)).alias("nb_sessions"),
                F.sum("total_bytes").alias("bytes_total"),
                _avg_round2().alias("avg_latency_ms"),
                F.count_distinct("srcip").alias("unique_sources"))
           .select("heure", "nb_sessions", "bytes_total", "avg_latency_ms",
                   "unique_sources")
           .orderBy(F.col("heure").desc()))
    return out.limit(limit) if limit else out


def view_anomaly_by_type(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_security"]
    out = (t.groupBy(F.col("message").alias("anomaly_type"))
           .agg(F.count(F.lit(1)).alias("occurrences"),
                F.sum("is_anomaly").alias("confirmed_anomalies"),
                F.max("severity").alias("max_severity"),
                F.max("ts").alias("last_occurrence"))
           .orderBy(F.col("occurrences").desc(), F.col("anomaly_type")))
    return out.limit(limit) if limit else out


def view_connection_status(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_raw_events"]
    out = (t.groupBy("status", "action")
           .agg(F.count(F.lit(1)).alias("nb_events"),
                F.sum("is_anomaly").alias("anomalies"),
                F.max("ts").alias("derniere_activite"))
           .orderBy(F.col("anomalies").desc(), F.col("status"), F.col("action")))
    return out.limit(limit) if limit else out


def view_network_log_types(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_network_logs"]
    out = (t.groupBy("log_type")
           .agg(F.count(F.lit(1)).alias("nb_events"),
                F.max("ts").alias("last_seen"),
                F.count_distinct("device_id").alias("nb_devices"))
           .orderBy(F.col("nb_events").desc(), F.col("log_type")))
    return out.limit(limit) if limit else out


def view_dhcp_activity(tables, limit: int | None = None) -> DataFrame:
    t = tables["t_network_logs"]
    out = (t.where(F.col("log_type") == "dhcp")
           .groupBy(_hour().alias("heure"))
           .agg(F.count(F.lit(1)).alias("nb_dhcp_events"),
                F.count_distinct("src_ip").alias("nb_ips"),
                sorted_set("device_id").alias("devices"))
           .orderBy(F.col("heure").desc()))
    return out.limit(limit) if limit else out


def view_wlan_alerts(tables, limit: int | None = 100) -> DataFrame:
    t = tables["t_network_logs"]
    out = (t.where(F.col("log_type").isin("ip_conflict", "user_offline", "wlan"))
           .orderBy(F.col("ts").desc(), F.col("event_id"))
           .select("ts", "device_id", "program", "log_type", "message", "mac_address"))
    return out.limit(limit) if limit else out


def view_global_events(tables, limit: int | None = 1000) -> DataFrame:
    """Security and network events in one feed; order/limit apply to the union."""
    sec = tables["t_security"].select(
        F.lit("security").alias("source"), "event_id", "device_id", "ts", "program",
        F.col("severity_label").alias("category"), "message")
    net = tables["t_network_logs"].select(
        F.lit("network").alias("source"), "event_id", "device_id", "ts", "program",
        F.col("log_type").alias("category"), "message")
    out = sec.unionByName(net).orderBy(F.col("ts").desc(), F.col("event_id"))
    return out.limit(limit) if limit else out


VIEWS = {
    "v_top_threat_ips": view_top_threat_ips,
    "v_device_summary": view_device_summary,
    "v_severity_per_hour": view_severity_per_hour,
    "v_high_latency": view_high_latency,
    "v_traffic_by_hour": view_traffic_by_hour,
    "v_anomaly_by_type": view_anomaly_by_type,
    "v_connection_status": view_connection_status,
    "v_network_log_types": view_network_log_types,
    "v_dhcp_activity": view_dhcp_activity,
    "v_wlan_alerts": view_wlan_alerts,
    "v_global_events": view_global_events,
}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register the serving tables and every view whose inputs are present."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    done = []
    for name, fn in VIEWS.items():
        try:
            fn(tables).createOrReplaceTempView(name)
            done.append(name)
        except KeyError:
            continue
    return done
