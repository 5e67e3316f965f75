"""Connected components of a table of links, by alternating stars.

Each round points every node at its smallest neighbour (large star), then at
its smallest smaller neighbour (small star), until the links no longer change;
they then are one star per component.  Rounds are joins and minima (partial
before the shuffle); each is stored, so its lineage is one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _towards_smallest(links: DataFrame) -> DataFrame:
    """(u, v) -> v linked to the smallest of u and the v of the same u."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return links.join(least, "u")


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``links`` (a, b)."""
    edges = stored(links.where("a <> b").selectExpr("greatest(a, b) u", "least(a, b) v").distinct(), "links")
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        both = edges.unionByName(edges.selectExpr("v u", "u v"))
        large = _towards_smallest(both).where("v > u").selectExpr("v u", "m v").distinct()
        small = _towards_smallest(large)
        edges = stored(small.selectExpr("v u", "m v").unionByName(small.selectExpr("u", "m v")).where("u <> v").distinct(), "links")
    return edges.selectExpr("u id", "v component").unionByName(edges.selectExpr("v id", "v component").distinct())
