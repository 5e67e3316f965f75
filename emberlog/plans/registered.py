"""The registered queries (one per operator family of the inventory).

Every query reads ``events`` from ``sf_dir`` and runs the full operator
chain on the whole table.  Oracle SQL is in DuckDB dialect over the same
tables (see ``emberlog.oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import oracle as O
from ..catalog import REGISTRY, register
from ..operators import gold as G
from ..operators import views as V
from ..operators.bronze import FULL_KEYS, PARITY_KEYS, to_bronze
from ..operators.latest import latest_by_key
from ..operators.parse_net import records_from_lines
from ..operators.route import route
from ..operators.serving import load_table
from ..operators.silver import event_time
from ..schemas import FIREWALL_TOPICS, MESSAGE_SCHEMA, TOPIC_LOG_SCHEMA, TOPIC_RAW
from ..session import ensure_session, shared_dir
from ..sources.tables import overwrite_partitions, scan, with_partition
from ..sources.topics import RECORDS_PER_FILE, decode, read_topics, write_topics
from ..streaming.ingest import read_latest, start_bronze, start_bronze_held, start_device_latest, start_fanout, start_network, start_serving
from . import flows
from .medallion import run_medallion


def run_ts():
    """The pinned processing time (a Column; built lazily, needs a session)."""
    return F.lit(O.RUN_TS).cast("timestamp")


def _s(spark):
    return ensure_session(spark)


# ---------------------------------------------------------------------------
# Parsers
# ---------------------------------------------------------------------------

_BATCH_COLS = """line_no, event_id, device_id, ts, eventtime, message, tag, program, seq,
  event_type, subtype, action, status, srcip, dstip, srcport, dstport, proto, service,
  policyname, policytype, poluuid, sentbyte, rcvdbyte, total_bytes, latency, sessionid,
  vwlid, vwlquality, devname, devtype, srchwvendor, srcmac, severity, severity_label,
  is_anomaly"""


@register("parse_batch_lines", O.fw(f"SELECT {_BATCH_COLS} FROM fwb"))
def q_parse_batch_lines(spark, sf_dir) -> DataFrame:
    return flows.batch_events(_s(spark), sf_dir).drop("ingested_at")


_RT_COLS = """line_no, event_id, device_id, ts, program, tag, action, status, srcip, dstip,
  srcport, dstport, sentbyte, rcvdbyte, total_bytes, latency, facility_raw, severity,
  severity_label, is_anomaly, message"""


@register("parse_rt_lines", O.fw(f"SELECT {_RT_COLS} FROM fwr"))
def q_parse_rt_lines(spark, sf_dir) -> DataFrame:
    return flows.rt_events(_s(spark), sf_dir).drop("ingested_at")


@register("parse_network_lines", O.net("""
SELECT line_no, event_id, device_id, ts, program, log_type, message, src_ip, dst_ip,
       mac_address, raw_length FROM nwt"""))
def q_parse_network_lines(spark, sf_dir) -> DataFrame:
    return flows.network_events(_s(spark), sf_dir, run_ts())


@register("severity_batch", O.fw("""
SELECT severity, severity_label, count(*) AS n_events FROM fwb GROUP BY ALL"""))
def q_severity_batch(spark, sf_dir) -> DataFrame:
    return (flows.batch_events(_s(spark), sf_dir)
            .groupBy("severity", "severity_label").agg(F.count(F.lit(1)).alias("n_events")))


@register("severity_rt", O.fw("""
SELECT severity, severity_label, count(*) AS n_events FROM fwr GROUP BY ALL"""))
def q_severity_rt(spark, sf_dir) -> DataFrame:
    return (flows.rt_events(_s(spark), sf_dir)
            .groupBy("severity", "severity_label").agg(F.count(F.lit(1)).alias("n_events")))


@register("anomaly_flag", O.fw("""
SELECT action, status, severity, is_anomaly, count(*) AS n_events FROM fwb GROUP BY ALL"""))
def q_anomaly_flag(spark, sf_dir) -> DataFrame:
    return (flows.batch_events(_s(spark), sf_dir)
            .groupBy("action", "status", "severity", "is_anomaly")
            .agg(F.count(F.lit(1)).alias("n_events")))


# ---------------------------------------------------------------------------
# Routing
# ---------------------------------------------------------------------------

@register("route_counts_batch", O.fw("""
SELECT topic, count(*) AS n_events FROM (
  SELECT 'fg_raw_all' AS topic FROM fwt
  UNION ALL SELECT 'fg_security_events' FROM fwt WHERE t_sec
  UNION ALL SELECT 'fg_traffic_flow' FROM fwt WHERE t_traf
  UNION ALL SELECT 'fg_performance' FROM fwt WHERE t_perf
  UNION ALL SELECT 'fg_device_inventory' FROM fwt WHERE t_dev) GROUP BY topic"""))
def q_route_counts_batch(spark, sf_dir) -> DataFrame:
    return (route(flows.batch_events(_s(spark), sf_dir), "batch")
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n_events")))


@register("route_counts_rt", O.fw("""
SELECT topic, count(*) AS n_events FROM (
  SELECT 'fg_raw_all' AS topic FROM fwr
  UNION ALL SELECT 'fg_security_events' FROM fwr WHERE is_anomaly = 1
  UNION ALL SELECT 'fg_traffic_flow' FROM fwr WHERE action = 'accept' AND status = 'success'
  UNION ALL SELECT 'fg_performance' FROM fwr WHERE sentbyte > 0 OR rcvdbyte > 0 OR latency > 0
  UNION ALL SELECT 'fg_device_inventory' FROM fwr WHERE device_id <> '') GROUP BY topic"""))
def q_route_counts_rt(spark, sf_dir) -> DataFrame:
    return (route(flows.rt_events(_s(spark), sf_dir), "realtime")
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n_events")))


# ---------------------------------------------------------------------------
# Bronze / silver
# ---------------------------------------------------------------------------

_BRONZE_SELECT = """first_topic AS kafka_topic, line_no AS kafka_offset, event_id, device_id,
  ts, eventtime, message, tag, program, seq, CAST(NULL AS INTEGER) AS facility, event_type,
  subtype, action, status, srcip, dstip, srcport, dstport, proto, service, policyname,
  policytype, poluuid, sentbyte, rcvdbyte, total_bytes, latency, sessionid, vwlid,
  vwlquality, devname, devtype, srchwvendor, srcmac, severity, severity_label, is_anomaly"""


def _bronze_sql(keys, topic="'fg_raw_all'", of="fwt"):
    return O.fw(f"""
SELECT {_BRONZE_SELECT.replace("first_topic AS", f"{topic} AS")} FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY line_no, first_topic) AS rn
  FROM {of}) WHERE rn = 1""")


@register("bronze_dedup", _bronze_sql(PARITY_KEYS))
def q_bronze_dedup(spark, sf_dir) -> DataFrame:
    return flows.bronze(_s(spark), sf_dir, keys=PARITY_KEYS).drop("ingested_at")


@register("bronze_dedup_full_key", _bronze_sql(FULL_KEYS))
def q_bronze_dedup_full_key(spark, sf_dir) -> DataFrame:
    return flows.bronze(_s(spark), sf_dir, keys=FULL_KEYS).drop("ingested_at")


@register("bronze_all_topics", _bronze_sql(FULL_KEYS, "first_topic"))
def q_bronze_all_topics(spark, sf_dir) -> DataFrame:
    """Bronze from the copies on all topics: the same events, the first topic by name."""
    return flows.bronze(_s(spark), sf_dir, keys=FULL_KEYS, topics=FIREWALL_TOPICS).drop("ingested_at")


@register("bronze_from_json", _bronze_sql(FULL_KEYS))
def q_bronze_from_json(spark, sf_dir) -> DataFrame:
    """Events published as JSON records, read back from the stored topic log."""
    spark = _s(spark)
    root = shared_dir(spark, "json-topics")
    write_topics(flows.batch_topic_log(spark, sf_dir, json=True), root)
    return to_bronze(read_topics(spark, [TOPIC_RAW], root), keys=FULL_KEYS).drop("ingested_at")


_MIDDLE = "(SELECT * FROM fwt WHERE line_no >= (SELECT max(event_id) FROM events) AND line_no < (SELECT 3 * max(event_id) FROM events))"


@register("bronze_offset_range", _bronze_sql(FULL_KEYS, of=_MIDDLE))
def q_bronze_offset_range(spark, sf_dir) -> DataFrame:
    """A range of offsets from the stored topic log: only the files that hold it are opened."""
    spark = _s(spark)
    root = shared_dir(spark, "json-topics")
    last = flows.events(spark, sf_dir).agg(F.max("event_id")).first()[0]
    write_topics(flows.batch_topic_log(spark, sf_dir, json=True, only=[TOPIC_RAW]).repartitionByRange("offset"), root)
    return to_bronze(read_topics(spark, [TOPIC_RAW], root, since=last, until=3 * last), keys=FULL_KEYS).drop("ingested_at")


@register("silver_clean", O.fw("""
SELECT event_time, 'fg_raw_all' AS kafka_topic, event_id, device_id, message, tag, program,
  event_type, subtype, action, status, srcip, dstip, srcport, dstport, proto, service,
  policyname, policytype, poluuid, sentbyte, rcvdbyte, total_bytes, latency, sessionid,
  vwlid, vwlquality, devname, devtype, srchwvendor, srcmac, severity, severity_label,
  is_anomaly, hour_of_day, day_of_week, proto_label, latency_bucket, is_vpn_failure
FROM fws"""))
def q_silver_clean(spark, sf_dir) -> DataFrame:
    return flows.silver(_s(spark), sf_dir, run_ts()).drop("ingested_at")


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

# The exact mean: the sum in units of 2^-20, and of 2^-63 for what is left.
_HIGH = "floor(CAST(latency AS DOUBLE) * 1048576)"
_LOW = f"(CAST(latency AS DOUBLE) * 1048576 - {_HIGH}) * 8796093022208"
_AVG_LAT = (f"((CAST(sum(CAST({_HIGH} AS HUGEINT)) AS DOUBLE) / 1048576.0::DOUBLE"
            f" + CAST(sum(CAST({_LOW} AS HUGEINT)) AS DOUBLE) / 9223372036854775808.0::DOUBLE) / count(latency))")
_AVG_BYTES = "CAST(sum(CAST(total_bytes AS DECIMAL(38,0))) AS DOUBLE) / count(total_bytes)"


def _gold(name):
    def run(spark, sf_dir):
        return G.GOLD[name](flows.silver(_s(spark), sf_dir, run_ts()))
    return run


register("gold_kpi_hourly", O.fw(f"""
SELECT date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
  event_type, severity_label, count(*) AS total_events,
  count_if(is_anomaly = 1) AS anomaly_count, count_if(severity >= 5) AS critical_count,
  count_if(severity = 4) AS error_count, count_if(severity = 3) AS warning_count,
  {_AVG_LAT} AS avg_latency_ms, max(latency) AS max_latency_ms,
  sum(total_bytes) AS total_bytes, {_AVG_BYTES} AS avg_bytes,
  count(DISTINCT device_id) AS unique_devices, count(DISTINCT srcip) AS unique_srcip
FROM fws GROUP BY 1, 2, 3, 4"""))(_gold("kpi_hourly"))

register("gold_device_inventory", O.fw(f"""
SELECT device_id, devname, devtype, srchwvendor, srcmac, count(*) AS total_events,
  count_if(is_anomaly = 1) AS total_anomalies, {_AVG_LAT} AS avg_latency_ms,
  max(latency) AS max_latency_ms, sum(total_bytes) AS total_bytes,
  max(event_time) AS last_seen
FROM fws WHERE device_id IS NOT NULL GROUP BY ALL"""))(_gold("device_inventory"))

register("gold_top_threat_ips", O.fw("""
SELECT srcip, count(*) AS nb_anomalies, max(severity) AS max_severity,
  count(event_id) AS total_events, max(event_time) AS last_alert
FROM fws WHERE is_anomaly = 1 AND srcip IS NOT NULL AND trim(srcip) <> ''
GROUP BY srcip ORDER BY nb_anomalies DESC, srcip"""))(_gold("top_threat_ips"))

register("gold_sdwan_performance", O.fw(f"""
SELECT date_trunc('hour', event_time) AS window_start, vwlid, {_AVG_LAT} AS avg_latency_ms,
  max(latency) AS max_latency_ms, quantile_disc(latency, 0.95) AS p95_latency_ms,
  count_if(latency > 20) AS degraded_sessions, count_if(latency > 50) AS critical_sessions,
  count(*) AS total_sessions, sum(total_bytes) AS total_bytes
FROM fws WHERE latency > 0 GROUP BY 1, 2"""))(_gold("sdwan_performance"))

register("gold_policy_traffic", O.fw(f"""
SELECT policyname, policytype, count(*) AS total_sessions,
  count_if(is_anomaly = 1) AS blocked_sessions, sum(total_bytes) AS total_bytes,
  {_AVG_LAT} AS avg_latency_ms, count(DISTINCT srcip) AS unique_src_ips,
  count(DISTINCT dstip) AS unique_dst_ips
FROM fws WHERE trim(policyname) <> '' GROUP BY ALL"""))(_gold("policy_traffic"))

register("gold_protocol_stats", O.fw(f"""
SELECT date_trunc('day', event_time) AS day, tag, count(*) AS total_sessions,
  count_if(is_anomaly = 1) AS anomaly_sessions, sum(total_bytes) AS total_bytes,
  {_AVG_LAT} AS avg_latency_ms, count(DISTINCT srcip) AS unique_sources
FROM fws GROUP BY 1, 2"""))(_gold("protocol_stats"))


# ---------------------------------------------------------------------------
# Serving loads
# ---------------------------------------------------------------------------

_SEC = """event_id, device_id, ts_loaded AS ts, program, tag, action, status, srcip, dstip,
  srcport, dstport, sentbyte, rcvdbyte, total_bytes, latency, severity, severity_label,
  is_anomaly, message"""
_TRAF = """event_id, device_id, ts_loaded AS ts, program, tag, action, status, srcip, dstip,
  srcport, dstport, sentbyte, rcvdbyte, total_bytes, latency, severity_label, message"""
_PERF = """event_id, device_id, ts_loaded AS ts, srcip, dstip, srcport, dstport, sentbyte,
  rcvdbyte, total_bytes, latency, severity, severity_label, is_anomaly, message"""
_RT_SEC = "fwr WHERE is_anomaly = 1"
_RT_TRAF = "fwr WHERE action = 'accept' AND status = 'success'"
_RT_PERF = "fwr WHERE sentbyte > 0 OR rcvdbyte > 0 OR latency > 0"


def _serving(name):
    def run(spark, sf_dir):
        t = flows.serving_tables(_s(spark), sf_dir, run_ts(), names=[name])[name]
        return t.drop("ingested_at")
    return run


register("serving_security", O.fw(f"SELECT {_SEC} FROM {_RT_SEC}"))(_serving("t_security"))
register("serving_traffic", O.fw(f"SELECT {_TRAF} FROM {_RT_TRAF}"))(_serving("t_traffic"))
register("serving_performance", O.fw(f"SELECT {_PERF} FROM {_RT_PERF}"))(_serving("t_performance"))
register("serving_raw", O.fw(f"SELECT {_SEC} FROM fwr"))(_serving("t_raw_events"))
register("serving_devices", O.fw("""
SELECT device_id, program, tag, ts_loaded AS first_seen, ts_loaded AS last_seen,
  CAST(1 AS BIGINT) AS total_events FROM fwr WHERE device_id <> ''"""))(_serving("t_devices"))
register("serving_network", O.net("""
SELECT event_id, device_id, ts_value AS ts, program, log_type, message, src_ip, dst_ip,
  mac_address, raw_length FROM nwt"""))(_serving("t_network_logs"))


def _devices(spark, sf_dir):
    return flows.serving_tables(_s(spark), sf_dir, run_ts(), names=["t_devices"])["t_devices"] \
        .drop("ingested_at")


@register("device_latest", O.fw("""
SELECT device_id, program, tag, first_seen, last_seen, total_events FROM (
  SELECT device_id, program, tag, ts_loaded AS first_seen, ts_loaded AS last_seen,
    CAST(1 AS BIGINT) AS total_events,
    row_number() OVER (PARTITION BY device_id ORDER BY ts_loaded DESC, program DESC,
                       tag DESC) AS rn
  FROM fwr WHERE device_id <> '') WHERE rn = 1"""))
def q_device_latest(spark, sf_dir) -> DataFrame:
    return latest_by_key(_devices(spark, sf_dir), ["device_id"], "last_seen")


@register("device_accumulated", O.fw("""
SELECT device_id, arg_max(program, (ts_loaded, program, tag)) AS program,
  arg_max(tag, (ts_loaded, program, tag)) AS tag, min(ts_loaded) AS first_seen,
  max(ts_loaded) AS last_seen, CAST(count(*) AS BIGINT) AS total_events
FROM fwr WHERE device_id <> '' GROUP BY device_id"""))
def q_device_accumulated(spark, sf_dir) -> DataFrame:
    return latest_by_key(_devices(spark, sf_dir), ["device_id"], "last_seen", accumulate=True)


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

def _round2_sql():
    return f"round_even({_AVG_LAT} * 100.0::DOUBLE, 0) / 100.0::DOUBLE"


def _view(name, tables, post=None):
    def run(spark, sf_dir):
        t = flows.serving_tables(_s(spark), sf_dir, run_ts(), names=tables)
        out = V.VIEWS[name](t)
        return post(out) if post else out
    return run


def _join_array(col):
    return lambda df: df.withColumn(col, F.array_join(col, ","))


register("view_top_threat_ips", O.fw("""
SELECT srcip, count(*) AS nb_anomalies, max(severity) AS max_severity,
  array_to_string(list_sort(list(DISTINCT action)), ',') AS actions_vues,
  max(ts_loaded) AS derniere_alerte
FROM fwr WHERE is_anomaly = 1 GROUP BY srcip ORDER BY nb_anomalies DESC, srcip LIMIT 50"""))(
    _view("v_top_threat_ips", ["t_security"], _join_array("actions_vues")))

register("view_device_summary", O.fw(f"""
SELECT device_id, count(*) AS total_events, sum(is_anomaly) AS total_anomalies,
  {_round2_sql()} AS avg_latency_ms, max(latency) AS max_latency_ms,
  sum(total_bytes) AS total_bytes, max(ts_loaded) AS last_seen
FROM fwr GROUP BY device_id"""))(_view("v_device_summary", ["t_raw_events"]))

register("view_severity_per_hour", O.fw("""
SELECT date_trunc('hour', ts_loaded) AS heure, severity_label, count(*) AS nb_events
FROM fwr GROUP BY 1, 2"""))(_view("v_severity_per_hour", ["t_raw_events"]))

register("view_high_latency", O.fw(f"""
SELECT ts_loaded AS ts, device_id, srcip, dstip, latency, severity_label
FROM fwr WHERE (sentbyte > 0 OR rcvdbyte > 0 OR latency > 0) AND latency > 20"""))(
    _view("v_high_latency", ["t_performance"]))

register("view_traffic_by_hour", O.fw(f"""
SELECT date_trunc('hour', ts_loaded) AS heure, count(*) AS nb_sessions,
  sum(total_bytes) AS bytes_total, {_round2_sql()} AS avg_latency_ms,
  count(DISTINCT srcip) AS unique_sources
FROM {_RT_TRAF} GROUP BY 1"""))(_view("v_traffic_by_hour", ["t_traffic"]))

register("view_anomaly_by_type", O.fw(f"""
SELECT message AS anomaly_type, count(*) AS occurrences, sum(is_anomaly) AS confirmed_anomalies,
  max(severity) AS max_severity, max(ts_loaded) AS last_occurrence
FROM {_RT_SEC} GROUP BY message"""))(_view("v_anomaly_by_type", ["t_security"]))

register("view_connection_status", O.fw("""
SELECT status, action, count(*) AS nb_events, sum(is_anomaly) AS anomalies,
  max(ts_loaded) AS derniere_activite
FROM fwr GROUP BY status, action"""))(_view("v_connection_status", ["t_raw_events"]))

register("view_network_log_types", O.net("""
SELECT log_type, count(*) AS nb_events, max(ts_value) AS last_seen,
  count(DISTINCT device_id) AS nb_devices
FROM nwt GROUP BY log_type"""))(_view("v_network_log_types", ["t_network_logs"]))

register("view_dhcp_activity", O.net("""
SELECT date_trunc('hour', ts_value) AS heure, count(*) AS nb_dhcp_events,
  count(DISTINCT src_ip) AS nb_ips,
  array_to_string(list_sort(list(DISTINCT device_id)), ',') AS devices
FROM nwt WHERE log_type = 'dhcp' GROUP BY 1"""))(
    _view("v_dhcp_activity", ["t_network_logs"], _join_array("devices")))

register("view_wlan_alerts", O.net("""
SELECT ts, device_id, program, log_type, message, mac_address FROM (
  SELECT ts_value AS ts, device_id, program, log_type, message, mac_address, event_id
  FROM nwt WHERE log_type IN ('ip_conflict', 'user_offline', 'wlan')
  ORDER BY ts_value DESC, event_id LIMIT 100)"""))(
    _view("v_wlan_alerts", ["t_network_logs"]))

register("view_global_events", O.both("""
SELECT * FROM (
  SELECT 'security' AS source, event_id, device_id, ts_loaded AS ts, program,
    severity_label AS category, message FROM fwr WHERE is_anomaly = 1
  UNION ALL
  SELECT 'network' AS source, event_id, device_id, ts_value AS ts, program,
    log_type AS category, message FROM nwt)
ORDER BY ts DESC, event_id LIMIT 1000"""))(
    _view("v_global_events", ["t_security", "t_network_logs"]))


_SQL = {k: v[1] for k, v in REGISTRY.items()}

# ---------------------------------------------------------------------------
# Stored tables, multi-stage runs, streaming
# ---------------------------------------------------------------------------

@register("overwrite_idempotent", _SQL["silver_clean"])
def q_overwrite_idempotent(spark, sf_dir) -> DataFrame:
    """Silver written with dynamic partition overwrite, one day rewritten, read back."""
    spark = _s(spark)
    path = shared_dir(spark, "overwrite") + "/fg_events_clean"
    silver, part = with_partition(flows.silver(spark, sf_dir, run_ts()), "fg_events_clean")
    overwrite_partitions(silver, path, part)
    day = scan(spark, path).agg(F.min("event_date")).first()[0]
    overwrite_partitions(silver.where(F.col("event_date") == F.lit(day)), path, part)
    return scan(spark, path).drop("ingested_at", *part)


def _some_days(spark, root):
    """Three event days from the stored table: the first and the two after it."""
    first = scan(spark, f"{root}/silver/fg_events_clean").agg(F.min("event_date")).first()[0]
    return first, first + dt.timedelta(2)


def _medallion_result(spark, root):
    return scan(spark, f"{root}/gold/fg_kpi_hourly").drop("window_date")


@register("medallion_kpi_hourly", _SQL["gold_kpi_hourly"])
def q_medallion_kpi_hourly(spark, sf_dir) -> DataFrame:
    """Full bronze/silver/gold run through stored tables, then a day-range rerun."""
    spark = _s(spark)
    root = shared_dir(spark, "medallion")
    run_medallion(spark, flows.batch_topic_log(spark, sf_dir), root, fallback=run_ts(), ingest_ts=run_ts())
    run_medallion(spark, None, root, days=_some_days(spark, root), fallback=run_ts())
    return _medallion_result(spark, root)


@register("medallion_two_days", _SQL["gold_kpi_hourly"])
def q_medallion_two_days(spark, sf_dir) -> DataFrame:
    """Half of the log on one ingest day, all of it on the next, then some event days again."""
    spark = _s(spark)
    root = shared_dir(spark, "medallion")
    log = flows.batch_topic_log(spark, sf_dir, only=[TOPIC_RAW])
    half = 2 * flows.events(spark, sf_dir).agg(F.max("event_id")).first()[0]
    days = [F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp") for d in (1, 2)]
    run_medallion(spark, log, root, until=half, fallback=run_ts(), ingest_ts=days[0])
    run_medallion(spark, log, root, fallback=run_ts(), ingest_ts=days[1])
    run_medallion(spark, None, root, days=_some_days(spark, root), fallback=run_ts())
    return _medallion_result(spark, root)


@register("medallion_two_ranges", _SQL["gold_kpi_hourly"])
def q_medallion_two_ranges(spark, sf_dir) -> DataFrame:
    """Two adjoining offset ranges of the log on one ingest day, and the second one again."""
    spark = _s(spark)
    root = shared_dir(spark, "medallion")
    log = flows.batch_topic_log(spark, sf_dir, only=[TOPIC_RAW])
    half = 2 * flows.events(spark, sf_dir).agg(F.max("event_id")).first()[0]
    run_medallion(spark, log, root, until=half, fallback=run_ts(), ingest_ts=run_ts())
    for _ in range(2):
        run_medallion(spark, log, root, since=half, fallback=run_ts(), ingest_ts=run_ts())
    return _medallion_result(spark, root)


@register("medallion_no_time_two_days", _SQL["gold_kpi_hourly"])
def q_medallion_no_time_two_days(spark, sf_dir) -> DataFrame:
    """The whole log on one ingest day, then all of it and a part again on the next, events without a time by the default rule."""
    spark = _s(spark)
    root = shared_dir(spark, "medallion")
    log = flows.batch_topic_log(spark, sf_dir, only=[TOPIC_RAW])
    half = 2 * flows.events(spark, sf_dir).agg(F.max("event_id")).first()[0]
    later = (run_ts() + F.expr("interval 1 day")).cast("timestamp")
    for ingest_ts, since in ((run_ts(), None), (later, None), (later, half)):
        run_medallion(spark, log, root, since=since, ingest_ts=ingest_ts, reports=("fg_kpi_hourly",))
    return _medallion_result(spark, root)


def _incremental(table):
    def run(spark, sf_dir):
        """Two offset ranges and a rerun of some days; the report is put together from the states of all days."""
        spark = _s(spark)
        root = shared_dir(spark, "medallion")
        log = flows.batch_topic_log(spark, sf_dir, only=[TOPIC_RAW])
        half = 2 * flows.events(spark, sf_dir).agg(F.max("event_id")).first()[0]
        only = {"reports": (f"fg_{table}",), "fallback": run_ts(), "ingest_ts": run_ts()}
        run_medallion(spark, log, root, until=half, **only)
        run_medallion(spark, log, root, since=half, **only)
        run_medallion(spark, None, root, days=_some_days(spark, root), **only)
        return scan(spark, f"{root}/gold/fg_{table}")
    return run


for _table in ("device_inventory", "top_threat_ips", "policy_traffic"):
    register(f"gold_{_table}_incremental", _SQL[f"gold_{_table}"])(_incremental(_table))


def _stream_topics(spark, sf_dir, profile="realtime"):
    root = shared_dir(spark, "stream")
    flows.firewall_lines(spark, sf_dir).select("value").write.text(f"{root}/lines")
    q = start_fanout(spark, f"{root}/lines", f"{root}/topics", f"{root}/chk-fanout",
                     profile=profile, available_now=True, max_files=4)
    q.awaitTermination()
    return root


@register("stream_fanout", _SQL["route_counts_rt"])
def q_stream_fanout(spark, sf_dir) -> DataFrame:
    """File stream of lines -> parse -> fan-out -> topic log; counts per topic."""
    spark = _s(spark)
    root = _stream_topics(spark, sf_dir)
    log = spark.read.schema(TOPIC_LOG_SCHEMA).parquet(f"{root}/topics")
    return log.groupBy("topic").agg(F.count(F.lit(1)).alias("n_events"))


@register("stream_device_latest", _SQL["device_latest"])
def q_stream_device_latest(spark, sf_dir) -> DataFrame:
    """Topic-log stream -> latest row per device merged per micro-batch."""
    spark = _s(spark)
    root = _stream_topics(spark, sf_dir)
    q = start_device_latest(spark, f"{root}/topics", f"{root}/devices", f"{root}/chk-dev",
                            seen_ts="event", fallback=run_ts(), available_now=True)
    q.awaitTermination()
    return read_latest(spark, f"{root}/devices")


# A streamed record has an id of its own, so these compare all other columns.
_STREAMED = {"t_security": (_SEC, _RT_SEC), "t_traffic": (_TRAF, _RT_TRAF), "t_performance": (_PERF, _RT_PERF), "t_raw_events": (_SEC, "fwr")}


def _stream_serving(table):
    def run(spark, sf_dir):
        spark = _s(spark)
        root = _stream_topics(spark, sf_dir)
        start_serving(spark, f"{root}/topics", table, f"{root}/{table}", f"{root}/chk-{table}",
                      fallback=run_ts(), available_now=True).awaitTermination()
        return spark.read.parquet(f"{root}/{table}").drop("event_id", "ingested_at", "event_month")
    return run


for _table, (_cols, _from) in _STREAMED.items():
    register(f"stream_serving_{_table[2:]}", O.fw(f"SELECT {_cols.replace('event_id, ', '')} FROM {_from}"))(_stream_serving(_table))


# Streams that load one table side by side; each has one file, thus one task, in work at a time.
CONSUMERS = 10


def largest_blocks(queries, every: float = 5.0) -> int:
    """Waits for streaming queries; the most records that a micro-batch of theirs took in.

    A query keeps its last 100 reports, so they are read while it runs.  If one fails, all end.
    """
    most, running = 0, list(queries)
    try:
        while running:
            ended = [q.awaitTermination(every / len(running)) for q in running]
            most = max([most, *(p["numInputRows"] for q in running for p in q.recentProgress)])
            running = [q for q, over in zip(running, ended) if not over]
    finally:
        for q in running:
            q.stop()
    return most


@register("stream_serving_blocks", O.fw(f"SELECT {_SEC.replace('event_id, ', '')} FROM fwr"))
def q_stream_serving_blocks(spark, sf_dir):
    """The raw events table in blocks, by consumers side by side: no micro-batch takes in more records than the bound."""
    spark = _s(spark)
    root = _stream_topics(spark, sf_dir)
    queries = [start_serving(spark, f"{root}/topics", "t_raw_events", f"{root}/t_raw_events", f"{root}/chk-blocks/{k}", fallback=run_ts(), available_now=True,
                             max_records=RECORDS_PER_FILE, share=(k, CONSUMERS)) for k in range(CONSUMERS)]
    if largest_blocks(queries) > RECORDS_PER_FILE:
        raise RuntimeError("a micro-batch took in more records than its bound")
    return spark.read.parquet(f"{root}/t_raw_events").drop("event_id", "ingested_at", "event_month")


@register("stream_network_logs", O.net("""
SELECT device_id, ts_value AS ts, program, log_type, message, src_ip, dst_ip, mac_address, raw_length
FROM nwt"""))
def q_stream_network_logs(spark, sf_dir) -> DataFrame:
    """Network CSV files -> classify, enrich -> topic -> serving table, all streamed."""
    spark = _s(spark)
    root = shared_dir(spark, "stream-net")
    body = flows.network_lines(spark, sf_dir).where(~F.col("value").startswith("timestamp;"))
    recs = records_from_lines(body)
    recs.write.option("sep", ";").option("header", "true").csv(f"{root}/csv")
    start_network(spark, f"{root}/csv", f"{root}/topics", f"{root}/chk-net", fallback=run_ts(), available_now=True).awaitTermination()
    start_serving(spark, f"{root}/topics", "t_network_logs", f"{root}/t_network_logs", f"{root}/chk-logs",
                  fallback=run_ts(), available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/t_network_logs").drop("event_id", "ingested_at", "event_month")


@register("stream_bronze_keys", O.fw("""
SELECT DISTINCT device_id, ts, seq, event_id FROM fwt"""))
def q_stream_bronze_keys(spark, sf_dir) -> DataFrame:
    """Batch-profile line stream -> topics -> bronze de-duplicated in the stream."""
    spark = _s(spark)
    root = _stream_topics(spark, sf_dir, "batch")
    start_bronze(spark, f"{root}/topics", f"{root}/bronze", f"{root}/chk-bronze", delay="3650 days",
                 available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select("device_id", "ts", "seq", "event_id")


def arrivals(spark, log: DataFrame, path: str, slices: int = 5):
    """Append a raw topic log to ``path`` as its records might arrive: by time, out of order by up to two days; yields after each append.

    Two last records, of no device, have a time long after all others: the first
    moves the watermark past them, the second brings the batch in which they leave.
    The log is dealt to its slices once, and an append is written by as many tasks as its slice asks for.
    """
    base = f"{path}-base"
    log.write.parquet(base)
    stored = spark.read.schema(TOPIC_LOG_SCHEMA).parquet(base)
    t = F.unix_seconds(event_time(F.lit(None).cast("timestamp")))
    timed = decode(stored, MESSAGE_SCHEMA, ("topic", "partition", "offset")).select("offset", (F.coalesce(t, F.lit(0)) + F.pmod(F.hash("offset"), F.lit(2 * 86400))).alias("arrival"))
    edges = timed.where("arrival > 1e9").approxQuantile("arrival", [k / slices for k in range(1, slices)], 0.01)
    of = timed.select("offset", F.array_position(F.expr("array_sort(array_append(array({}), arrival))".format(", ".join(f"bigint({e:.0f})" for e in edges))), F.col("arrival")).alias("slice"))
    stored.join(of, "offset").write.partitionBy("slice").parquet(f"{path}-dealt")
    dealt = spark.read.parquet(f"{path}-dealt")
    for k in range(1, slices + 1):
        dealt.where(F.col("slice") == k).drop("slice").select(*stored.columns).write.mode("append").partitionBy("topic").parquet(path)
        yield k
    closing = spark.sql("""SELECT 'fg_raw_all' AS topic, 0 AS partition, -1L AS offset, '{"device_id": "", "ts": "2035-01-01 00:00:00"}' AS value""")
    for _ in range(2):
        closing.write.mode("append").partitionBy("topic").parquet(path)
        yield slices + 1


@register("stream_bronze_rows", _bronze_sql(FULL_KEYS))
def q_stream_bronze_rows(spark, sf_dir) -> DataFrame:
    """Records out of order by up to two days -> bronze with the batch's survivor, under a watermark of four days."""
    spark = _s(spark)
    root = shared_dir(spark, "stream-rows")
    # An append has as many files as its size asks for, so the stream takes in what is there after each one, not a number of files.
    for _ in arrivals(spark, flows.batch_topic_log(spark, sf_dir, json=True, only=[TOPIC_RAW]), f"{root}/topics"):
        start_bronze_held(spark, f"{root}/topics", f"{root}/bronze", f"{root}/chk", delay="4 days", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").drop("ingested_at", "ingest_date")


# One event's time in twenty shapes (by its id), as Spark formats and as SQL; the last is in none.
_SHAPES = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "yyyy-MM-dd'T'HH:mm:ss'+0000'", "yyyy-MM-dd HH:mm:ss.SSSSSS",
           "dd/MM/yyyy HH:mm:ss", "dd/MM/yy HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "dd-MM-yyyy HH:mm:ss", "dd.MM.yyyy HH:mm:ss", "d MMM yyyy HH:mm:ss", "EEE, dd MMM yyyy HH:mm:ss '+0000'",
           "MMM d yyyy HH:mm:ss", "dd/MMM/yyyy:HH:mm:ss '+0000'", "yyyyMMddHHmmss", "yyyyMMdd'T'HHmmss'Z'", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "'week' w"]


@register("serving_best_effort_times", f"""
SELECT event_id,
  CASE WHEN event_id % 22 IN (20, 21) OR event_id % 22 < 17 THEN date_trunc('second', CAST(ts AS TIMESTAMP)) WHEN event_id % 22 = 17 THEN date_trunc('minute', CAST(ts AS TIMESTAMP))
       WHEN event_id % 22 = 18 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE TIMESTAMP '{O.RUN_TS}' END AS ts,
  event_id % 22 = 19 AS ts_fell_back FROM events""")
def q_serving_best_effort_times(spark, sf_dir) -> DataFrame:
    """The serving load of times in 22 shapes (epochs in milli- and microseconds among them), with a flag for what fell back."""
    spark = _s(spark)
    ts, nth = F.col("ts").cast("timestamp"), F.col("event_id") % (len(_SHAPES) + 2)
    text = F.when(nth == 20, F.unix_millis(ts).cast("string")).when(nth == 21, F.unix_micros(ts).cast("string"))
    for k, fmt in enumerate(_SHAPES):
        text = text.when(nth == k, F.lit("week 7") if k == 19 else F.date_format(ts, fmt))
    log = flows.events(spark, sf_dir).select(F.lit(TOPIC_RAW).alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                                             F.col("event_id").cast("string").alias("event_id"), F.lit("d").alias("device_id"), text.alias("ts"))
    return load_table(log, "t_raw_events", run_ts(), flag=True).select(F.col("event_id").cast("long").alias("event_id"), "ts", "ts_fell_back")
