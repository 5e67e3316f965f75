"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query is fully evaluated (noop sink, all columns) once to warm up and
then ``BENCH_REPS`` times; the median is reported.  ``value`` is the sum of
the per-query medians; ``build`` is the part that makes the DataFrame, before
any row moves.  ``events`` is one file of one row group, which a scan reads on
one core; the bench deals it out to one file per core first, outside the time.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_batch_lines", "parse_rt_lines", "parse_network_lines",
    "route_counts_batch", "bronze_dedup", "silver_clean",
    "gold_kpi_hourly", "gold_device_inventory", "gold_top_threat_ips",
    "gold_sdwan_performance", "gold_policy_traffic", "gold_protocol_stats",
    "serving_raw", "device_latest", "view_top_threat_ips",
    "view_device_summary", "view_dhcp_activity", "view_global_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from emberlog.catalog import queries
    from emberlog.session import build_session
    spark = build_session(f"local[{cpus}]", app="emberlog-bench",
                          shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    work = tempfile.mkdtemp(prefix="emberlog-bench-")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(int(cpus)).write.parquet(f"{work}/events.parquet")
    out, build = {}, {}
    for name in names:
        fn = qs[name]
        times, built = [], []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            df = fn(spark, work)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.perf_counter() - t0)
                built.append(t1 - t0)
        out[name] = round(statistics.median(times), 3)
        build[name] = round(statistics.median(built), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "build": build,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "events_rows": events,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
