"""Declared schemas: nothing in the pipeline is inferred."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, FloatType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampType)

S, I, L, F, TS = StringType(), IntegerType(), LongType(), FloatType(), TimestampType()
D, DAY = DoubleType(), DateType()


def _struct(fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Field names, order and types of the firewall event message
# carried on every topic (the JSON value of the topic log).
MESSAGE_FIELDS = [
    ("event_id", S), ("device_id", S), ("ts", S), ("eventtime", S),
    ("ingested_at", S), ("message", S), ("tag", S), ("program", S),
    ("seq", S), ("facility", I), ("event_type", S), ("subtype", S),
    ("action", S), ("status", S), ("srcip", S), ("dstip", S),
    ("srcport", I), ("dstport", I), ("proto", I), ("service", S),
    ("policyname", S), ("policytype", S), ("poluuid", S),
    ("sentbyte", L), ("rcvdbyte", L), ("total_bytes", L), ("latency", F),
    ("sessionid", S), ("vwlid", I), ("vwlquality", S), ("devname", S),
    ("devtype", S), ("srchwvendor", S), ("srcmac", S), ("severity", I),
    ("severity_label", S), ("is_anomaly", I),
]
MESSAGE_SCHEMA = _struct(MESSAGE_FIELDS)

# Fields the batch parser emits (the message less facility, which the batch
# parser removes before publishing).
BATCH_PARSED_COLUMNS = [n for n, _ in MESSAGE_FIELDS if n != "facility"]

# Topic log row: what a Kafka batch/stream read yields (value as JSON text).
TOPIC_LOG_SCHEMA = _struct([("topic", S), ("partition", I), ("offset", L),
                            ("value", S)])

# Bronze: message less ingested_at, plus ingest time and topic coordinates.
BRONZE_COLUMNS = (["ingested_at", "kafka_topic", "kafka_offset"]
                  + [n for n, _ in MESSAGE_FIELDS if n != "ingested_at"])

# Silver column order.
SILVER_COLUMNS = [
    "ingested_at", "event_time", "kafka_topic", "event_id", "device_id",
    "message", "tag", "program", "event_type", "subtype", "action", "status",
    "srcip", "dstip", "srcport", "dstport", "proto", "service", "policyname",
    "policytype", "poluuid", "sentbyte", "rcvdbyte", "total_bytes", "latency",
    "sessionid", "vwlid", "vwlquality", "devname", "devtype", "srchwvendor",
    "srcmac", "severity", "severity_label", "is_anomaly", "hour_of_day",
    "day_of_week", "proto_label", "latency_bucket", "is_vpn_failure",
]

# Real-time parser output (the event published on the real-time topics).
RT_FIELDS = [
    ("event_id", S), ("device_id", S), ("ts", S), ("program", S), ("tag", S),
    ("action", S), ("status", S), ("srcip", S), ("dstip", S),
    ("srcport", I), ("dstport", I), ("sentbyte", L), ("rcvdbyte", L),
    ("total_bytes", L), ("latency", F), ("facility_raw", I), ("severity", I),
    ("severity_label", S), ("is_anomaly", I), ("ingested_at", S),
    ("message", S),
]

# Serving tables: column name -> type (insert-time ``ingested_at`` last).
SECURITY_FIELDS = [
    ("event_id", S), ("device_id", S), ("ts", TS), ("program", S), ("tag", S),
    ("action", S), ("status", S), ("srcip", S), ("dstip", S),
    ("srcport", I), ("dstport", I), ("sentbyte", L), ("rcvdbyte", L),
    ("total_bytes", L), ("latency", F), ("severity", I),
    ("severity_label", S), ("is_anomaly", I), ("message", S),
    ("ingested_at", TS),
]
RAW_EVENTS_FIELDS = SECURITY_FIELDS
TRAFFIC_FIELDS = [f for f in SECURITY_FIELDS
                  if f[0] not in ("severity", "is_anomaly")]
PERFORMANCE_FIELDS = [f for f in SECURITY_FIELDS
                      if f[0] not in ("program", "tag", "action", "status")]
DEVICES_FIELDS = [("device_id", S), ("program", S), ("tag", S),
                  ("first_seen", TS), ("last_seen", TS), ("total_events", L),
                  ("ingested_at", TS)]
NETWORK_FIELDS = [
    ("event_id", S), ("device_id", S), ("ts", TS), ("program", S),
    ("log_type", S), ("message", S), ("src_ip", S), ("dst_ip", S),
    ("mac_address", S), ("raw_length", L), ("ingested_at", TS),
]


def queue_schema(fields) -> StructType:
    """Schema a serving table reads off its topic: ts and ingested_at as text."""
    return _struct([(n, S if n in ("ts", "ingested_at") else t)
                    for n, t in fields])


# Raw network CSV record (header ``timestamp;device_id;program;msg``).
NETWORK_CSV_SCHEMA = _struct([("timestamp", S), ("device_id", S),
                              ("program", S), ("msg", S)])

# Topic names.
TOPIC_RAW = "fg_raw_all"
TOPIC_SECURITY = "fg_security_events"
TOPIC_TRAFFIC = "fg_traffic_flow"
TOPIC_PERFORMANCE = "fg_performance"
TOPIC_DEVICES = "fg_device_inventory"
TOPIC_NETWORK = "fg_network_logs"
FIREWALL_TOPICS = [TOPIC_RAW, TOPIC_SECURITY, TOPIC_TRAFFIC,
                   TOPIC_PERFORMANCE, TOPIC_DEVICES]

# Stored tables: declared columns, then the partition columns.
_TYPES = dict(MESSAGE_FIELDS) | {
    "ingested_at": TS, "kafka_topic": S, "kafka_offset": L, "event_time": TS, "hour_of_day": I,
    "day_of_week": I, "proto_label": S, "latency_bucket": S, "is_vpn_failure": I,
}
TABLE_FIELDS = {
    "fg_events_raw": [(n, _TYPES[n]) for n in BRONZE_COLUMNS] + [("first_seen", TS), ("ingest_date", DAY), ("offset_range", S), ("event_date", DAY)],
    "fg_first_seen": [("key_hash", L), ("key", S), ("first_seen", TS), ("bucket", I), ("ingest_date", DAY), ("offset_range", S)],
    "fg_events_clean": [(n, _TYPES[n]) for n in SILVER_COLUMNS] + [("event_date", DAY)],
    "fg_kpi_hourly": [
        ("window_start", TS), ("window_end", TS), ("event_type", S), ("severity_label", S),
        ("total_events", L), ("anomaly_count", L), ("critical_count", L), ("error_count", L),
        ("warning_count", L), ("avg_latency_ms", D), ("max_latency_ms", F), ("total_bytes", L),
        ("avg_bytes", D), ("unique_devices", L), ("unique_srcip", L), ("window_date", DAY)],
    "fg_device_inventory": [
        ("device_id", S), ("devname", S), ("devtype", S), ("srchwvendor", S), ("srcmac", S),
        ("total_events", L), ("total_anomalies", L), ("avg_latency_ms", D), ("max_latency_ms", F),
        ("total_bytes", L), ("last_seen", TS)],
    "fg_top_threat_ips": [
        ("srcip", S), ("nb_anomalies", L), ("max_severity", I), ("total_events", L), ("last_alert", TS)],
    "fg_sdwan_performance": [
        ("window_start", TS), ("vwlid", I), ("avg_latency_ms", D), ("max_latency_ms", F),
        ("p95_latency_ms", F), ("degraded_sessions", L), ("critical_sessions", L),
        ("total_sessions", L), ("total_bytes", L), ("window_date", DAY)],
    "fg_policy_traffic": [
        ("policyname", S), ("policytype", S), ("total_sessions", L), ("blocked_sessions", L),
        ("total_bytes", L), ("avg_latency_ms", D), ("unique_src_ips", L), ("unique_dst_ips", L)],
    "fg_protocol_stats": [
        ("day", TS), ("tag", S), ("total_sessions", L), ("anomaly_sessions", L), ("total_bytes", L),
        ("avg_latency_ms", D), ("unique_sources", L), ("day_date", DAY)],
}


def table_schema(table: str) -> StructType:
    return _struct(TABLE_FIELDS[table])
