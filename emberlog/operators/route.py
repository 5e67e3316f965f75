"""Predicate fan-out of parsed events to topics (one pass, no shuffle).

Each event gets an array of the topics whose predicate it satisfies and is
exploded once: the source is read a single time and the expansion happens
map-side, so the cost is one projection regardless of the number of topics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import BATCH, REALTIME
from ..schemas import (TOPIC_DEVICES, TOPIC_PERFORMANCE, TOPIC_RAW,
                       TOPIC_SECURITY, TOPIC_TRAFFIC)


def topic_rules(profile: str = BATCH) -> list[tuple[str, Column]]:
    """``(topic, predicate)`` pairs; the sets overlap.

    The device-inventory predicate differs: the batch flow also requires a
    non-empty devtype.
    """
    c = F.col
    dev = c("device_id").isNotNull() & (c("device_id") != "")
    if profile == BATCH:
        dev = dev & c("devtype").isNotNull() & (c("devtype") != "")
    elif profile != REALTIME:
        raise ValueError(f"unknown profile {profile!r}")
    return [
        (TOPIC_RAW, F.lit(True)),
        (TOPIC_SECURITY, c("is_anomaly") == 1),
        (TOPIC_TRAFFIC, (c("action") == "accept") & (c("status") == "success")),
        (TOPIC_PERFORMANCE, (c("sentbyte") > 0) | (c("rcvdbyte") > 0)
         | (c("latency") > 0.0)),
        (TOPIC_DEVICES, dev),
    ]


def topics_for(profile: str = BATCH, only: list[str] | None = None) -> Column:
    """``array<string>`` of matching topics for the current row."""
    rules = [(t, p) for t, p in topic_rules(profile) if only is None or t in only]
    arr = F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(t)) for t, p in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def route(df: DataFrame, profile: str = BATCH, only: list[str] | None = None,
          topic_col: str = "topic") -> DataFrame:
    """Input rows + ``topic``, one row per matching topic."""
    return df.select(F.explode(topics_for(profile, only)).alias(topic_col), "*")
