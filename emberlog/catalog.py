"""Registered queries: ``name -> (spark_fn(spark, sf_dir), oracle_sql | None)``.

Each Spark query reads the driver tables (``events``), derives the log text
with the bridge, and runs the real operators on it, so its work grows with
the table.  Insert-time columns and random ids are left out of compared
outputs; timestamp fallbacks are pinned to ``oracle.RUN_TS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load():
    # Import for side effects: each module registers its queries.
    from .plans import registered  # noqa: F401
