"""Latest row per key (newest version wins), optionally accumulating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys=("device_id",), version: str = "last_seen",
                  accumulate: bool = False) -> DataFrame:
    """Keep, per key, the row with the greatest ``version``.

    Ties on ``version`` are broken by the remaining columns, so the survivor
    is independent of partitioning.  ``max`` is combined map-side (partial
    aggregation), so a hot key is reduced before the shuffle.

    ``accumulate=True`` keeps the newest row's attributes but sets
    ``first_seen`` = min, ``last_seen`` = max, ``total_events`` = sum.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    aggs = [F.max(F.struct(version, *[c for c in others if c != version])).alias("_l")]
    if accumulate:
        aggs += [F.min("first_seen").alias("_first"), F.max("last_seen").alias("_last"),
                 F.sum("total_events").alias("_total")]
    out = df.groupBy(*keys).agg(*aggs)
    cols = []
    for c in df.columns:
        if c in keys:
            cols.append(F.col(c))
        elif accumulate and c == "first_seen":
            cols.append(F.col("_first").alias(c))
        elif accumulate and c == "last_seen":
            cols.append(F.col("_last").alias(c))
        elif accumulate and c == "total_events":
            cols.append(F.col("_total").cast("long").alias(c))
        else:
            cols.append(F.col(f"_l.{c}").alias(c))
    return out.select(*cols)
