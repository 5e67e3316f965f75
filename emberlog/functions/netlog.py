"""Network-device log helpers: type classifier and address extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# Classifier rules, first match wins.  ``upper`` rules look at
# the upper-cased message, ``exact`` rules are case-sensitive.
LOG_TYPE_RULES = [
    ("upper", ["DHCP"], "dhcp"),
    ("upper", ["WLAN", "AP_", "STA"], "wlan"),
    ("upper", ["BGP"], "bgp"),
    ("upper", ["FEI_COMM"], "sync"),
    ("exact", ["USER_OFFLINE"], "user_offline"),
    ("exact", ["IP_CONFLICT"], "ip_conflict"),
    ("upper", ["ARP"], "arp"),
]
LOG_TYPE_DEFAULT = "unknown"

# Address patterns.
IPV4_PATTERN = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
MAC_PATTERN = r"(?:[0-9a-fA-F]{2}[-:]){5}[0-9a-fA-F]{2}"


def log_type(msg) -> Column:
    m = F.coalesce(col_(msg), F.lit(""))
    up = F.upper(m)
    out = None
    for mode, needles, label in LOG_TYPE_RULES:
        target = up if mode == "upper" else m
        cond = None
        for n in needles:
            c = target.contains(n)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(LOG_TYPE_DEFAULT)


def ipv4_all(msg) -> Column:
    return F.regexp_extract_all(F.coalesce(col_(msg), F.lit("")),
                                F.lit(IPV4_PATTERN), 0)


def nth_or_blank(arr, i: int) -> Column:
    """``arr[i]`` or '' (``get`` returns null out of range, even under ANSI)."""
    return F.coalesce(F.get(col_(arr), i), F.lit(""))


def first_mac(msg) -> Column:
    return F.regexp_extract(F.coalesce(col_(msg), F.lit("")), MAC_PATTERN, 0)
