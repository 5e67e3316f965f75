"""End-to-end dataflows composed from the operators (lazy DataFrames).

batch flow:     lines -> parse_batch -> route(batch) -> topic log
                -> bronze -> silver -> gold
real-time flow: lines -> parse_rt -> route(realtime) -> topic log
                -> serving loads -> views
network flow:   CSV lines -> records -> parse_network -> topic log
                -> t_network_logs -> views
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import FULL_KEYS, to_bronze
from ..operators.parse_batch import parse_batch_lines
from ..operators.parse_net import parse_network_records, records_from_lines
from ..operators.parse_rt import parse_rt_lines
from ..operators.route import route
from ..operators.serving import TABLES, load_devices, load_table
from ..operators.silver import to_silver
from ..schemas import TOPIC_DEVICES, TOPIC_NETWORK, TOPIC_RAW
from ..sources import bridge
from ..sources.topics import encode, typed_log


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.read_events(spark, sf_dir)


def firewall_lines(spark, sf_dir, copies: int = 1) -> DataFrame:
    return bridge.firewall_lines(bridge.spread_events(events(spark, sf_dir), copies))


def network_lines(spark, sf_dir) -> DataFrame:
    return bridge.network_lines(bridge.spread_events(events(spark, sf_dir)))


# --- batch -----------------------------------------------------------------

def batch_events(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    lines = lines if lines is not None else firewall_lines(spark, sf_dir)
    return parse_batch_lines(lines, keep=["line_no"])


def batch_topic_log(spark, sf_dir, lines: DataFrame | None = None,
                    json: bool = False, only: list[str] | None = None) -> DataFrame:
    """Routed batch events as a topic log (typed in-plan; ``json`` encodes)."""
    routed = route(batch_events(spark, sf_dir, lines), "batch", only=only)
    return encode(routed, offset_col="line_no") if json else typed_log(routed)


def bronze(spark, sf_dir, keys=FULL_KEYS, lines=None, ingest_ts=None,
           topics=(TOPIC_RAW,)) -> DataFrame:
    """Bronze from the raw topic (every event is on it), or from the given topics."""
    # A task sorts all its copies by key, so more topics mean fewer events in a task.
    lines = lines if lines is not None else firewall_lines(spark, sf_dir, copies=len(topics))
    log = batch_topic_log(spark, sf_dir, lines, only=list(topics))
    return to_bronze(log, ingest_ts=ingest_ts, keys=keys, topics=topics)


def silver(spark, sf_dir, fallback, lines=None, ingest_ts=None) -> DataFrame:
    return to_silver(bronze(spark, sf_dir, FULL_KEYS, lines, ingest_ts), fallback)


# --- real time -------------------------------------------------------------

def rt_events(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    lines = lines if lines is not None else firewall_lines(spark, sf_dir)
    return parse_rt_lines(lines, id_mode="source", keep=["line_no"])


def rt_topic_log(spark, sf_dir, lines=None, json: bool = False,
                 only: list[str] | None = None) -> DataFrame:
    """Routed real-time events; ``only`` restricts the fan-out to some topics
    (a consumer of one topic then expands each event at most once)."""
    routed = route(rt_events(spark, sf_dir, lines), "realtime", only=only)
    return encode(routed, offset_col="line_no") if json else typed_log(routed)


# --- network ---------------------------------------------------------------

def network_events(spark, sf_dir, fallback, lines=None) -> DataFrame:
    lines = lines if lines is not None else network_lines(spark, sf_dir)
    recs = records_from_lines(lines, keep=["line_no"])
    return parse_network_records(recs, id_mode="source", fallback=fallback,
                                 keep=["line_no"])


def network_topic_log(spark, sf_dir, fallback, lines=None, json: bool = False) -> DataFrame:
    ev = network_events(spark, sf_dir, fallback, lines).withColumn("topic", F.lit(TOPIC_NETWORK))
    return encode(ev, offset_col="line_no") if json else typed_log(ev)


# --- serving ---------------------------------------------------------------

def serving_tables(spark, sf_dir, fallback, ingest_ts=None,
                   names=None) -> dict[str, DataFrame]:
    """Serving tables loaded from the real-time and network topic logs."""
    names = names or list(TABLES) + ["t_devices"]
    out = {}
    for name in names:
        if name == "t_network_logs":
            out[name] = load_table(network_topic_log(spark, sf_dir, fallback), name,
                                   fallback, ingest_ts)
            continue
        topic = TOPIC_DEVICES if name == "t_devices" else TABLES[name][0]
        log = rt_topic_log(spark, sf_dir, only=[topic])
        if name == "t_devices":
            out[name] = load_devices(log, seen_ts="event", fallback=fallback,
                                     ingest_ts=ingest_ts)
        else:
            out[name] = load_table(log, name, fallback, ingest_ts)
    return out
