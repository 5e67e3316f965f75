"""Operator 2, nearest neighbours by inner product: adaptive dimension scan.

``fit`` draws a sample of ``SAMPLE`` rows (by a hash of the id; the driver holds
it), adds to each vector the coordinate that turns largest inner product into
smallest distance, and finds the lists' centres on it.  It also chooses how
many lists a query probes: as many as hold ``COVERAGE`` of the sample's own
nearest neighbours.  ``index`` puts every row into its list and stores it, with
the vector turned by a random rotation.

``search`` scans the probed lists.  A list is cut into blocks of about
``BLOCK_ROWS`` rows, its queries into blocks of about ``BLOCK_QUERIES``, so no
task meets an unbounded list.  A query starts with the score of its k-th best
sample row; a candidate must be closer than that score allows.  Its distance is
summed over blocks of ``COLUMNS`` rotated coordinates, and after each block it
is abandoned if the part so far is too large for a close enough vector: after a
random rotation the share of a squared distance in d of D coordinates follows a
Beta(d/2, (D-d)/2) law, and the test has about ``ERROR`` (``Z`` deviations).
What remains is scored exactly, in double precision, on the original vectors.

The k best sample rows of a query stay candidates, probed or not, so a query
has k results wherever the table has.
Null vectors, zero vectors and vectors with null or non-finite components (or
another dimension than the sample's most common one) take no part, nor do rows
without an id; of rows with one vec_id the smallest vector counts; ties go to
the smaller vec_id; with fewer candidates than k all are returned; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

SAMPLE = 8192
MAX_LISTS = 512
COVERAGE = 0.97
PROBED_QUERIES = 400
BLOCK_ROWS = 2048
BLOCK_QUERIES = 512
COLUMNS = 16
Z = 3.1  # one-sided normal quantile of ERROR
ERROR = 0.001
ROUNDS = 10
INDEXED = "vec_id long, list int, rotated array<float>, vector array<double>"
FOUND = "query_id long, vec_id long, score double"


def valid_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, vector (array of double): one row per id, only usable vectors."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
            .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
            .where(~F.exists("vector", bad)).where(F.exists("vector", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("vector").alias("vector")))


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def exact(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products row by row, in double precision and in one order of summation."""
    return (vectors * queries).sum(axis=1)


def best(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to the smaller id."""
    order = np.lexsort((vec_id, -score, query))
    ordered = query[order]
    first = np.searchsorted(ordered, ordered, "left")
    return order[np.arange(len(order)) - first < k]


class Index:
    """Sample, rotation, centres (of vectors with the added coordinate) and the number of probes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, n_rows: int, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.width = vectors.shape[1]
        rng = np.random.default_rng(7)
        self.rotation = np.linalg.qr(rng.normal(size=(self.width, self.width)))[0]
        self.reach = float((vectors**2).sum(1).max()) if len(vectors) else 1.0
        lists = int(min(MAX_LISTS, math.sqrt(n_rows) / 2, len(vectors) / 16)) if n_rows > BLOCK_ROWS else 1
        self.centres = self._centres(max(1, lists), rng)
        self.probes = self._probes()

    def raised(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.reach - (vectors**2).sum(1)))
        return np.hstack([vectors, rest[:, None]])

    def closeness(self, raised: np.ndarray) -> np.ndarray:
        return raised @ self.centres.T - 0.5 * (self.centres**2).sum(1)

    def lists_of(self, vectors: np.ndarray) -> np.ndarray:
        return self.closeness(self.raised(vectors)).argmax(1)

    def probe_order(self, queries: np.ndarray) -> np.ndarray:
        return np.argsort(-self.closeness(np.hstack([queries, np.zeros((len(queries), 1))])), axis=1, kind="stable")

    def _centres(self, lists: int, rng) -> np.ndarray:
        rows = np.unique(self.raised(self.vectors), axis=0)
        self.centres = rows[rng.choice(len(rows), min(lists, len(rows)), replace=False)]
        for _ in range(ROUNDS if lists > 1 else 0):
            own = self.closeness(rows).argmax(1)
            n = np.bincount(own, minlength=len(self.centres))
            sums = np.zeros_like(self.centres)
            np.add.at(sums, own, rows)
            self.centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centres)
        return self.centres

    def _probes(self) -> int:
        """The fewest lists that hold ``COVERAGE`` of the sample's nearest neighbours."""
        if len(self.centres) == 1:
            return 1
        some = np.arange(0, len(self.vectors), max(1, len(self.vectors) // PROBED_QUERIES))
        scores = self.vectors[some] @ self.vectors.T
        scores[np.arange(len(some)), some] = -np.inf
        near = np.argpartition(-scores, self.k, axis=1)[:, :self.k]
        place = np.argsort(self.probe_order(self.vectors[some]), axis=1)
        need = np.sort(np.take_along_axis(place, self.lists_of(self.vectors)[near], axis=1).ravel())
        return int(need[min(len(need) - 1, math.ceil(COVERAGE * len(need)))]) + 1

    def seeds(self, query_ids: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """For each query: the score to beat, and its k best sample rows with their scores."""
        bars, rows, scores = np.full(len(queries), -np.inf), [], []
        rough = queries @ self.vectors.T
        rough[query_ids[:, None] == self.ids[None, :]] = -np.inf
        for i, q in enumerate(queries):
            finite = np.flatnonzero(np.isfinite(rough[i]))
            if len(finite) > 2 * self.k:
                edge = np.partition(rough[i][finite], -self.k)[-self.k]
                finite = finite[rough[i][finite] >= edge - 1e-9 * (1 + abs(edge))]
            value = exact(self.vectors[finite], q[None, :])
            at = best(np.zeros(len(finite)), self.ids[finite], value, self.k)
            rows.append(finite[at])
            scores.append(value[at])
            if len(at) == self.k:
                bars[i] = value[at[-1]]
        return bars, rows, scores


def fit(vectors: DataFrame, k: int) -> Index | None:
    """An index for the rows of ``valid_vectors``; None without rows."""
    prepare(vectors.sparkSession)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return None
    lists = sample.column("vector").to_pylist()
    width = Counter(map(len, lists)).most_common(1)[0][0]
    at = [i for i, v in enumerate(lists) if len(v) == width]
    return Index(sample.column("vec_id").to_numpy()[at], np.array([lists[i] for i in at]), vectors.count(), k)


def _assign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            x = matrix(batch.column("vector"), index.width)
            if len(x):
                turned = (x @ index.rotation).astype(np.float32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id"), pa.array(index.lists_of(x).astype(np.int32)),
                    pa.FixedSizeListArray.from_arrays(pa.array(turned.ravel()), index.width).cast(pa.list_(pa.float32())), batch.column("vector"),
                ], names=["vec_id", "list", "rotated", "vector"])
    return run


def index_rows(vectors: DataFrame, shared) -> DataFrame:
    """Every row with its list and its rotated vector, stored."""
    fitting = vectors.where(F.size("vector") == shared.value.width)
    return stored(fitting.mapInArrow(_assign(shared), INDEXED), "vector-index")


_SEED = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))


def _prepare_queries(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids, q = batch.column("vec_id").to_numpy(), matrix(batch.column("vector"), index.width)
            if not len(q):
                continue
            bars, rows, scores = index.seeds(ids, q)
            probed = index.probe_order(q)[:, :index.probes]
            kept = [[{"vec_id": v, "score": s} for v, s in zip(index.ids[near].tolist(), score.tolist())] for near, score in zip(rows, scores)]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("vector"), pa.array(bars),
                pa.array(probed.tolist(), pa.list_(pa.int32())), pa.array(kept, _SEED),
            ], names=["query_id", "vector", "bar", "lists", "seeds"])
    return run


def scan(index: Index, table: pa.Table, queries: pa.Table) -> pa.Table:
    """The k best of one block of rows for one block of queries."""
    width, k = index.width, index.k
    ids, x = table.column("vec_id").to_numpy(), matrix(table.column("vector"), width)
    turned = matrix(table.column("rotated"), width, np.float32)
    query_ids, q, bar = queries.column("query_id").to_numpy(), matrix(queries.column("vector"), width), queries.column("bar").to_numpy()
    turned_q = (q @ index.rotation).astype(np.float32)
    # A row scores at least `bar` if its squared distance is at most this.
    limit = ((q**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * bar[:, None]).astype(np.float32)
    slack = np.float32(1e-4) * (np.abs((q**2).sum(1))[:, None] + (x**2).sum(1)[None, :]).astype(np.float32)
    a = b = part = None
    for start in range(0, width, COLUMNS):
        end = min(width, start + COLUMNS)
        u, v = turned_q[:, start:end], turned[:, start:end]
        share = end / width
        if end < width:
            share = min(1.0, share + Z * math.sqrt(2 * share * (1 - share) / (width + 2)))
        if part is None:
            whole = (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * (u @ v.T)
            a, b = np.nonzero(whole <= limit * np.float32(share) + slack)
            part = whole[a, b]
        else:
            part = part + ((u[a] - v[b]) ** 2).sum(1)
            stay = part <= limit[a, b] * np.float32(share) + slack[a, b]
            a, b, part = a[stay], b[stay], part[stay]
    other = query_ids[a] != ids[b]
    a, b = a[other], b[other]
    score = exact(x[b], q[a])
    at = best(a, ids[b], score, k)
    return pa.table({"query_id": query_ids[a[at]], "vec_id": ids[b[at]], "score": score[at]})


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each row of ``valid_vectors`` with ``is_query``."""
    spark = vectors.sparkSession
    index = fit(vectors, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)
    rows = index_rows(vectors, shared)
    asked = (rows.where(is_query).select("vec_id", "vector")
             .mapInArrow(_prepare_queries(shared), "query_id long, vector array<double>, bar double, lists array<int>, seeds array<struct<vec_id: long, score: double>>"))
    asked = stored(asked, "vector-queries")
    probes = asked.select("query_id", "vector", "bar", F.explode("lists").alias("list"))
    # At most MAX_LISTS rows: the blocks of each list.
    blocks = (rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("row_blocks"))
              .join(probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("query_blocks")), "list"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = (rows.join(F.broadcast(blocks), "list").withColumn("rb", own("vec_id", "row_blocks")).withColumn("qb", every("query_blocks"))
            .select("list", "rb", "qb", "vec_id", "rotated", "vector"))
    right = (probes.join(F.broadcast(blocks), "list").withColumn("qb", own("query_id", "query_blocks")).withColumn("rb", every("row_blocks"))
             .select("list", "rb", "qb", "query_id", "vector", "bar"))
    keys = ["list", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_cogrouped(shared), FOUND)
    seeds = asked.select("query_id", F.explode("seeds").alias("s")).select("query_id", "s.vec_id", "s.score")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A sample row that was also found by the scan has the same score and rank.
    return (found.unionByName(seeds).withColumn("rank", F.dense_rank().over(nearest)).where(F.col("rank") <= k)
            .groupBy("query_id", "rank").agg(F.min("vec_id").alias("vec_id"), F.min("score").alias("score"))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _cogrouped(shared):
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        return scan(shared.value, rows, queries) if rows.num_rows and queries.num_rows else empty
    return run
