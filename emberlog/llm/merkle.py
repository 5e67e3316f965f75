"""Operator 11, Merkle dataset manifest checked by a recursive climb.

Every row is a leaf.  Per source the leaves ascend by doc_id and every 16
consecutive nodes become one, until one (the subroot) is left; the subroots,
ordered by source, give the root in the same way.  ``build`` stores the built
levels as parent-linked node rows: a node's tree, level and place, its parent,
and the digests left and right of it in its run.  ``climb`` ascends these links
with a recursive query: each step appends the siblings it meets and folds them
with the digest that climbs.  Leaves of one run have the same way up, so they
climb as one row that holds a digest for each of its (at most 16) leaves.

A node high in the tree is on the way of a large part of all runs.  Its link is
stored in copies, one for each ``FAN`` runs below it (``COPIES`` at most), and a
run joins the copy that its number falls on, so no key of the recursive join
gathers the rows of a source or of the whole tree.

Places come from a range partitioning by (source, doc_id, leaf, row) and counts
per (partition, source), so a source with any share of the rows is numbered in
parts; runs and links are spread by their place, never by their source alone.
The recursion takes one step for each level (log16 of the rows); nothing but
the root and one maximum reaches the driver.

Edge cases: a null value is ``-`` in a leaf; rows repeated exactly are leaves
of their own; leaves of one source and doc_id (null first) ascend by digest; a
row whose tampering condition is null (null doc_id) is not tampered with;
without siblings the proof is the digest of the empty text; an empty table has
no rows and a null root; columns other than the five hashed are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import stored

FAN = 16
COPIES = 1 << 16
TOP = ""  # the tree above the subroots; a source's tree is its encoding, never empty
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NO_LINK = "tree string, level int, place long, copy long, digest binary, up_tree string, up_level int, up_place long, up_copies long, before binary, after binary"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Manifest(NamedTuple):
    """``runs``: the lowest nodes with their leaves; ``links``: node -> parent and siblings; ``root``: tree, level, digest of the last node."""

    runs: DataFrame
    links: DataFrame
    root: Row | None


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    """SHA-256, as bytes: stored and moved in half the room of its hex text."""
    return F.unhex(F.sha2(text, 256))


def hexed(value: Column) -> Column:
    """Digests as the lower-case hex text that is hashed and shown."""
    return F.lower(F.hex(value))


def leaf_digest(**changed: Column) -> Column:
    return digest(F.concat(*(encoded(changed.get(c, F.col(c))) for c in FIELDS)))


def lowered(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, UPPER.lower())


def joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, b: F.concat(a, b))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``place`` in their ``tree``, which holds ``n`` rows; ``order`` begins with what orders trees."""
    ordered = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33).alias("part")
    trees = Window.partitionBy("tree")  # over one row for each partition
    before = trees.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = (ordered.groupBy(part, "tree").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("k"))
              .select("part", "tree", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("low")).alias("shift"), F.sum("k").over(trees).alias("n")))
    return ordered.select("*", part).join(groups.hint("merge"), ["part", "tree"]).withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def copies(below: Column) -> Column:
    """How many copies of its link a node with ``below`` runs under it has."""
    return F.least(F.ceil(below / FAN), F.lit(COPIES)).cast("long")


def _links(nodes: DataFrame) -> DataFrame:
    """Each of ``nodes`` (tree, level, place, source, digest, runs below, their place in a run: run_tree, run_level, run_place, n) with parent and siblings, stored."""
    node = F.struct("run_place", "tree", "level", "place", "digest", "below")
    runs = (nodes.groupBy("run_tree", "run_level", F.expr(f"run_place div {FAN}").alias("up"))
            .agg(F.array_sort(F.collect_list(node)).alias("run"), F.sum("below").alias("up_below"), F.first("source").alias("source"), F.first("n").alias("n"))
            .withColumn("digests", F.transform("run", lambda x: x["digest"])))
    each = runs.select("*", digest(hexed(joined(F.col("digests")))).alias("parent"), F.posexplode("run").alias("slot", "node"))
    return stored(each.select("node.tree", "node.level", "node.place", "node.digest", "node.below", F.col("run_tree").alias("up_tree"), (F.col("run_level") + 1).alias("up_level"),
                              F.col("up").alias("up_place"), "up_below", joined(F.slice("digests", F.lit(1), F.col("slot"))).alias("before"),
                              joined(F.slice("digests", F.col("slot") + 2, F.lit(FAN))).alias("after"), "parent", "slot", "source", "n"), "merkle-links")


def _above(links: DataFrame) -> DataFrame:
    """The parents of ``links``, as nodes of their own tree."""
    place = [F.col(f"up_{c}").alias(f"{to}{c}") for to in ("", "run_") for c in ("tree", "level", "place")]
    return links.where("slot = 0").select(*place, "source", F.col("parent").alias("digest"), F.col("up_below").alias("below"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"))


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Links of all levels from ``nodes`` up, and the roots of their trees by level."""
    links, roots = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most:
        roots.append(nodes.where("n = 1"))
        if most == 1:
            break
        links.append(_links(nodes.where("n > 1")))
        nodes, most = _above(links[-1]), -(-most // FAN)
    return links, roots


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build(docs: DataFrame, tampered: Column) -> Manifest:
    """The manifest of ``docs``; where ``tampered`` holds, the leaf of the lower-cased text will climb."""
    hashed = stored(docs.select(encoded(F.col("source")).alias("tree"), F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                                leaf_digest().alias("leaf"), F.when(tampered, leaf_digest(text=lowered(F.col("text")))).alias("changed"),
                                F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    leaf = F.struct("place", "doc_id", "leaf", F.coalesce("changed", "leaf").alias("climber"))
    lone = F.col("n") == 1
    runs = (placed(hashed, ["source", "doc_id", "leaf", "row"]).groupBy("tree", F.expr(f"place div {FAN}").alias("place"))
            .agg(F.array_sort(F.collect_list(leaf)).alias("leaves"), F.first("source").alias("source"), F.first("n").alias("n")))
    runs = stored(runs.select("tree", F.when(lone, 0).otherwise(1).alias("level"), "place", "source", "leaves",
                              F.when(lone, F.col("leaves")[0]["leaf"]).otherwise(digest(hexed(joined(_digests())))).alias("digest"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n")), "merkle-runs")
    at = [F.col(c).alias(f"run_{c}") for c in ("tree", "level", "place")]
    links, roots = _levels(runs.select("tree", "level", "place", *at, "source", "digest", F.lit(1).cast("long").alias("below"), "n"))
    if not roots:
        return Manifest(runs, docs.sparkSession.createDataFrame([], NO_LINK), None)
    subroots = _union(roots).select(F.lit(TOP).alias("tree"), F.col("tree").alias("own"), "level", F.col("place").alias("own_place"), "source", "digest", "below")
    above = placed(subroots, ["source"]).select(F.col("own").alias("tree"), "level", F.col("own_place").alias("place"), F.col("tree").alias("run_tree"), F.lit(0).alias("run_level"),
                                                F.col("place").alias("run_place"), "source", "digest", "below", "n")
    top_links, tops = _levels(above)
    root = _union(tops).select("tree", "level", "digest").first()
    kept = [x.select("tree", "level", "place", F.explode(F.sequence(F.lit(0).cast("long"), copies(F.col("below")) - 1)).alias("copy"), "digest", "up_tree", "up_level", "up_place",
                     copies(F.col("up_below")).alias("up_copies"), "before", "after") for x in [*links, *top_links]]
    return Manifest(runs, _union(kept) if kept else docs.sparkSession.createDataFrame([], NO_LINK), root)


# A run's number, which says the copy it takes, is a hash of its own place.
CLIMB = """
WITH RECURSIVE climb (run_tree, run_place, number, tree, level, place, copy, climbers, siblings, subroot) AS (
  SELECT tree, place, xxhash64(tree, place), tree, level, place, 0L, climbers, X'', CAST(NULL AS BINARY) FROM {start}
  UNION ALL
  SELECT /*+ MERGE(n) */ c.run_tree, c.run_place, c.number, n.up_tree, n.up_level, n.up_place, pmod(c.number, n.up_copies),
         transform(c.climbers, x -> unhex(sha2(lower(hex(n.before || x || n.after)), 256))), c.siblings || n.before || n.after,
         CASE WHEN n.up_tree = '' AND n.tree <> '' THEN n.digest ELSE c.subroot END
  FROM climb c JOIN {links} n ON c.tree = n.tree AND c.level = n.level AND c.place = n.place AND c.copy = n.copy
)
SELECT run_tree AS tree, run_place AS place, climbers, siblings, subroot, tree AS at_tree, level AS at_level FROM climb
"""


def _digests() -> Column:
    return F.transform("leaves", lambda x: x["leaf"])


def _others(slot: Column) -> tuple[Column, Column]:
    """What stands left and right of a leaf in its run; a lone leaf has no run."""
    return joined(F.slice(_digests(), F.lit(1), slot)), joined(F.slice(_digests(), slot + 2, F.lit(FAN)))


def climb(made: Manifest) -> DataFrame:
    """tree, place, climbers, siblings, subroot of all runs at the root: each climber folded, and the siblings above the run."""
    spark = made.runs.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # a guard against endless recursion, a million rows by default; links end at the root

    def first(leaf: Column, slot: Column) -> Column:
        before, after = _others(slot)
        return F.when(F.col("level") == 0, leaf["climber"]).otherwise(digest(hexed(F.concat(before, leaf["climber"], after))))

    start = made.runs.select("tree", "level", "place", F.transform("leaves", first).alias("climbers"))
    top, height = (made.root["tree"], made.root["level"]) if made.root else (TOP, 0)
    ways = spark.sql(CLIMB, start=start, links=made.links)
    return ways.where((F.col("at_tree") == top) & (F.col("at_level") == height)).drop("at_tree", "at_level")


def verify(made: Manifest) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    ends = climb(made).join(made.runs.select("tree", "place", "leaves").hint("merge"), ["tree", "place"])
    each = ends.select("*", F.posexplode(F.arrays_zip("leaves", "climbers")).alias("slot", "one"))
    before, after = _others(F.col("slot"))
    root = F.lit(bytes(made.root["digest"]) if made.root else None).cast("binary")
    folded, leaf = F.col("one.climbers"), F.col("one.leaves.leaf")
    return each.select("one.leaves.doc_id", hexed(leaf).alias("leaf"), hexed(F.coalesce("subroot", root)).alias("subroot"), hexed(root).alias("root"),
                       F.sha2(hexed(F.concat(before, after, "siblings")), 256).alias("proof_sha256"), hexed(folded).alias("folded_root"), (folded == root).alias("verified"))
