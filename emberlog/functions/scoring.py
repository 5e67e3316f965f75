"""Severity and anomaly scoring (shared by the batch and real-time parsers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, strip_ws

BATCH = "batch"
REALTIME = "realtime"


def severity(priority, profile: str = BATCH) -> Column:
    """Struct ``(severity, severity_label)`` from a syslog priority.

    Fixed values: <=2 -> 5 critical, 3 -> 4 error, 4 -> 3 warning, 5 -> 2 info.
    Above 5 the two flows disagree: batch gives 1 ok, real-time keeps 2 info
    (real-time never yields ``ok``).
    """
    p = col_(priority)
    if profile == BATCH:
        tail_sev, tail_label = F.lit(1), F.lit("ok")
        five = p == 5
    elif profile == REALTIME:
        tail_sev, tail_label = F.lit(2), F.lit("info")
        five = p >= 5
    else:
        raise ValueError(f"unknown profile {profile!r}")
    sev = (F.when(p <= 2, 5).when(p == 3, 4).when(p == 4, 3)
           .when(five, 2).otherwise(tail_sev))
    label = (F.when(p <= 2, "critical").when(p == 3, "error")
             .when(p == 4, "warning").when(five, "info").otherwise(tail_label))
    return F.struct(sev.cast("int").alias("severity"),
                    label.alias("severity_label"))


def is_anomaly(action, status, sev) -> Column:
    """1 when status is ``failed``, action is ``deny``/``fail`` or severity >= 4.

    (A fifth rule of the batch parser -- deny/fail with status success -- is
    implied by the action rule and needs no term.)
    """
    a = F.coalesce(strip_ws(col_(action)), F.lit(""))
    s = F.coalesce(strip_ws(col_(status)), F.lit(""))
    hit = (s == "failed") | a.isin("deny", "fail") | (F.coalesce(col_(sev), F.lit(0)) >= 4)
    return hit.cast("int")
