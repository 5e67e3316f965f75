"""Column-level building blocks (pure ``Column -> Column`` functions)."""

from .netlog import first_mac, ipv4_all, log_type, nth_or_blank
from .scoring import BATCH, REALTIME, is_anomaly, severity
from .stats import count_when, exact_avg, sorted_set
from .text import (clean_field, default_if_blank, int_prefix, is_blank,
                   kv_names, kv_text, kv_value, kv_values, strip_ws, to_float, to_int,
                   trim_quotes, with_kv)
from .timeparse import best_effort_ts, fallback_ts, parse_first

__all__ = [
    "BATCH", "REALTIME", "best_effort_ts", "clean_field", "count_when",
    "default_if_blank", "exact_avg", "fallback_ts", "first_mac",
    "int_prefix", "ipv4_all", "is_anomaly", "is_blank", "kv_names", "kv_text",
    "kv_value", "kv_values", "with_kv",
    "log_type", "nth_or_blank", "parse_first", "severity", "sorted_set",
    "strip_ws", "to_float", "to_int", "trim_quotes",
]
