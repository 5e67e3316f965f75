"""Operator 12, ranked lexical search with geometric blocks in each posting list.

``index`` writes an inverted index over all documents, for the terms that the
asked items hold.  Documents are dealt into shards of bounded size.  Within a
shard the posting list of a term is cut into blocks of *similar* documents
(random pivots of the list, each document to the pivot whose projected score
vector is nearest), and each block stores the coordinatewise maximum of its
documents' score vectors, rounded up.  ``search`` reads a shard, bounds every
block of an item's terms by its summary and scores the documents of a block
unless the bound is below the item's present tenth score; a skipped block can
hold no better document, so results are exact.  Every document is in the lists
of all its terms, in one shard: postings are never shuffled, and a word that all
documents hold is in as many lists as there are shards.

Scores are 64-bit integers throughout.  A summary holds, per term, a byte: the
maximum in units of 1/255 of the term's largest score in the shard, rounded up.

Items are asked in groups of at most ``TERMS`` distinct terms (one item may
have more); a group's terms, weights and item lists are the only things
broadcast.  A worker holds one shard: ``CELLS`` scores at most, or one document.

Edge cases: a null or empty text, or one without terms, is no document and an
item without terms has no rows; items and documents without id keep a null id
(as documents they come first among equals); rows repeated exactly rank one by
one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, steps, stored, text_column

TOP = 10
TERMS = 8192
CELLS = 1 << 22
BLOCK = 64       # documents a block has on average
SHORT = 16       # lists up to this length are scored as they are
DIMENSIONS = 32
STRIP = 128      # documents rounded and projected at a time
STEP = 8          # blocks scored before the tenth score is looked at again
UNITS = 255
# A shard is a row of some megabytes: few of them at a time are read and handed to Python.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2", "spark.sql.parquet.columnarReaderBatchSize": "2"}

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text: runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_LOWER).split()


# -- term vectors of all documents -------------------------------------------

def _vectors(numbers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            for step in steps(batch, "text"):
                sizes, held, times = [], [], []
                for text in text_column(step.column("text")).to_pylist():
                    words = terms(text)
                    own = [(known[w], n) for w, n in Counter(words).items() if w in known]
                    sizes.append(len(words))
                    held.append([t for t, _ in own])
                    times.append([n for _, n in own])
                yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                                                 names=["doc_id", "n", "terms", "times"])
    return run


def vectors(docs: DataFrame, numbers) -> DataFrame:
    """Stored doc_id, n (all terms), terms (numbers of those in the broadcast ``numbers``) and times, of documents with a term."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return stored(rows.mapInArrow(_vectors(numbers), "doc_id long, n long, terms array<int>, times array<long>").where("n > 0"), "term-vectors")


def weights(made: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """Weight of every term, and the numbers of documents and of their terms."""
    n_docs, n_all = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = np.zeros(n_terms, np.int64)
    for term, held in made.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row for each asked term
        out[term] = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))))
    return out, n_docs, n_all


# -- the index ----------------------------------------------------------------

SHARD = "shard long, part int, docs binary, nulls binary, rows binary, terms binary, scores binary, list_terms binary, list_ends binary, list_rows binary, block_terms binary, block_ends binary, units binary, summaries binary"


def _dense(height: int, width: int, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray) -> np.ndarray:
    out = np.zeros((height, width), np.int64)
    out[rows, columns] = scores
    return out


def blocks_of(points: np.ndarray, seed: int) -> np.ndarray:
    """The block number of each point: about ``BLOCK`` points to a pivot, the nearest one by inner product."""
    pivots = np.random.default_rng(seed).choice(len(points), -(-len(points) // BLOCK), replace=False)
    return np.argmax(points @ points[np.sort(pivots)].T, axis=1)


def shard_row(shard: int, part: int, doc_ids: list, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, n_terms: int) -> dict:
    """One shard: score vectors (rows, terms, scores), posting lists in blocks, block summaries."""
    dense = _dense(len(doc_ids), n_terms, rows, columns, scores)
    units = np.maximum(-(-dense.max(axis=0) // UNITS), 1)
    small = np.empty(dense.shape, np.uint8)
    for at in range(0, len(dense), STRIP):
        small[at:at + STRIP] = -(-dense[at:at + STRIP] // units)
    del dense
    lengths = units.astype(np.float32)[:, None] * np.random.default_rng(n_terms).standard_normal((n_terms, DIMENSIONS), np.float32)
    points = np.concatenate([small[at:at + STRIP] @ lengths for at in range(0, len(small), STRIP)])
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    order = np.lexsort((rows, columns))
    by_term, of_rows = columns[order], rows[order]
    listed, begins = np.unique(by_term, return_index=True)
    ends = np.append(begins[1:], len(by_term))
    list_rows, block_terms, block_ends, summaries = [], [], [], []
    short_terms, short_ends, short_rows, total = [], [], [], 0
    for term, a, b in zip(listed.tolist(), begins.tolist(), ends.tolist()):
        own = of_rows[a:b]
        if b - a <= SHORT:
            short_terms.append(term)
            short_rows.append(own)
            short_ends.append((short_ends[-1] if short_ends else 0) + b - a)
            continue
        cluster = blocks_of(points[own], term)
        for k in range(cluster.max() + 1):
            block = own[cluster == k]
            if len(block):
                total += len(block)
                list_rows.append(block)
                block_terms.append(term)
                block_ends.append(total)
                summaries.append(small[block].max(axis=0))
    flat = lambda xs, kind: (np.concatenate(xs) if len(xs) and isinstance(xs[0], np.ndarray) else np.array(xs)).astype(kind).tobytes()
    return {"shard": shard, "part": part, "docs": flat([0 if d is None else d for d in doc_ids], "<i8"), "nulls": flat([d is None for d in doc_ids], "u1"),
            "rows": flat(rows, "<i4"), "terms": flat(columns, "<i4"), "scores": flat(scores, "<i8"),
            "list_terms": flat(short_terms, "<i4"), "list_ends": flat(short_ends, "<i4"), "list_rows": flat(short_rows + list_rows, "<i4"),
            "block_terms": flat(block_terms, "<i4"), "block_ends": flat(block_ends, "<i4"), "units": flat(units, "<i8"), "summaries": pa.compress(flat(summaries, "u1"), codec="zstd", asbytes=True)}


def _indexer(shared):
    weight, n_docs, n_all, n_terms = shared.value
    most = max(1, CELLS // max(1, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []
        names = [x.split()[0] for x in SHARD.split(", ")]
        schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32()}.get(x.split()[1], pa.binary())) for n, x in zip(names, SHARD.split(", "))])

        def flush(batch):
            nonlocal number
            counts = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(counts)), counts)
            columns, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "times"))
            m = 10 + 90 * batch.column("n").to_numpy(zero_copy_only=False) * n_docs // n_all
            scores = weight[columns] * (1_000_000_000 * times // (1000 * times + 8 * m[rows]))
            number += 1
            return pa.RecordBatch.from_pylist([shard_row((part << 32) + number, part, batch.column("doc_id").to_pylist(), rows, columns, scores, n_terms)], schema=schema)

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= most:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield flush(whole.slice(0, most))
                held = [whole.slice(most)] if len(whole) > most else []
        if sum(map(len, held)):
            yield flush(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    return run


def index(made: DataFrame, weight: np.ndarray, n_docs: int, n_all: int) -> DataFrame:
    """The stored shards of the term vectors ``made``."""
    shared = made.sparkSession.sparkContext.broadcast((weight, n_docs, n_all, len(weight)))
    return stored(made.where("size(terms) > 0").mapInArrow(_indexer(shared), SHARD), "lexical-index")


# -- the search ---------------------------------------------------------------

class Shard:
    """A shard's row, unpacked."""

    def __init__(self, row: dict, n_terms: int):
        get = lambda name, kind: np.frombuffer(row[name], kind)
        self.docs, self.nulls = get("docs", "<i8"), get("nulls", "u1").astype(bool)
        self.scores = _dense(n_terms, len(self.docs), get("terms", "<i4"), get("rows", "<i4"), get("scores", "<i8"))
        self.rows = get("list_rows", "<i4")
        short, ends = get("list_terms", "<i4"), get("list_ends", "<i4")
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        self.short = {t: self.rows[a:b] for t, a, b in zip(short.tolist(), begins.tolist(), ends.tolist())}
        base = int(ends[-1]) if len(ends) else 0
        self.block_terms, self.ends = get("block_terms", "<i4"), get("block_ends", "<i4") + base
        self.begins = np.concatenate([[base], self.ends[:-1]]).astype(np.int64) if len(self.ends) else self.ends
        self.units = get("units", "<i8")
        size = len(self.block_terms) * n_terms
        self.summaries = np.frombuffer(pa.decompress(row["summaries"], size, "zstd", asbytes=True), "u1").reshape(-1, n_terms)
        self.blocks = {t: np.flatnonzero(self.block_terms == t) for t in np.unique(self.block_terms).tolist()}

    def search(self, item: np.ndarray, best: list[tuple], top: int) -> tuple[list[tuple], int, int]:
        """The ``top`` best of ``best`` and this shard as (-score, not null, doc_id), and blocks scored and skipped."""
        seen, own = np.zeros(len(self.docs), bool), self.scores[item]

        def score(rows: np.ndarray) -> None:
            nonlocal best
            fresh = np.zeros(len(seen), bool)
            fresh[rows] = True
            rows = np.flatnonzero(fresh & ~seen)
            seen[rows] = True
            points = own[:, rows].sum(axis=0)
            least = -best[-1][0] if len(best) == top else 1
            good = points >= least
            if good.any():
                rows, points = rows[good], points[good]
                if len(rows) > top:  # ties with the last stay, their ids decide
                    last = np.partition(points, len(points) - top)[len(points) - top]
                    rows, points = rows[points >= last], points[points >= last]
                best = sorted([*best, *zip((-points).tolist(), (~self.nulls[rows]).tolist(), self.docs[rows].tolist())])[:top]

        lists = [self.short[t] for t in item.tolist() if t in self.short]
        if lists:
            score(np.concatenate(lists))
        mine = [self.blocks[t] for t in item.tolist() if t in self.blocks]
        scored = skipped = 0
        if mine:
            mine = np.concatenate(mine)
            bounds = self.summaries[np.ix_(mine, item)].astype(np.int64) @ self.units[item]
            order = np.argsort(-bounds, kind="stable")
            mine, bounds = mine[order], bounds[order]
            while scored < len(mine):
                # Bounds fall: the blocks beyond `good` cannot hold a better document.
                good = int(np.searchsorted(-bounds, -(-best[-1][0] if len(best) == top else 1), "right"))
                if good <= scored:
                    break
                these = mine[scored:min(good, scored + STEP)]
                score(np.concatenate([self.rows[a:b] for a, b in zip(self.begins[these].tolist(), self.ends[these].tolist())]))
                scored += len(these)
            skipped = len(mine) - scored
        return best, scored, skipped


FOUND = "item int, doc_id long, score long, scored long, skipped long"


def _searcher(shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, n_terms = shared.value
        best: list[list] = [[] for _ in items]
        scored = skipped = 0
        for batch in batches:
            for k in range(len(batch)):
                shard = Shard(batch.slice(k, 1).to_pylist()[0], n_terms)
                for i, item in enumerate(items):
                    best[i], a, b = shard.search(item, best[i], top)
                    scored, skipped = scored + a, skipped + b
        rows = [(i, doc if known else None, -minus) for i, found in enumerate(best) for minus, known, doc in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                                          pa.array([scored] * len(rows), pa.int64()), pa.array([skipped] * len(rows), pa.int64())], names=[x.split()[0] for x in FOUND.split(", ")])
    return run


def search(shards: DataFrame, items: list[np.ndarray], n_terms: int, top: int = TOP) -> DataFrame:
    """item (place in ``items``), doc_id, score of the best documents; scored, skipped: blocks of the task that found the row.

    Every task gives its ``top`` best for each item.  The result is stored, as
    the settings that shards are read with must hold while it is made.
    """
    spark = shards.sparkSession
    shared = spark.sparkContext.broadcast((items, n_terms))
    before = {k: spark.conf.get(k) for k in FEW_ROWS}
    try:
        for k, v in FEW_ROWS.items():
            spark.conf.set(k, v)
        return stored(shards.mapInArrow(_searcher(shared, top), FOUND), "lexical-found")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def groups(items: list[tuple], limit: int = TERMS) -> Iterator[list[tuple]]:
    """Runs of (item_id, terms) with at most ``limit`` distinct terms, or of one item."""
    run, held = [], set()
    for item in items:
        if run and len(held | item[1]) > limit:
            yield run
            run, held = [], set()
        run.append(item)
        held |= item[1]
    if run:
        yield run


def rank(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each of ``queries`` (item_id, text)."""
    spark = docs.sparkSession
    # The asked items are a stated set: they pass the driver one after another, in groups.
    asked = ((r["item_id"], set(terms(r["text"] or ""))) for r in queries.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").orderBy("item_id").toLocalIterator())
    found = None
    for number, group in enumerate(groups((x for x in asked if x[1]))):
        names = sorted(set().union(*(t for _, t in group)))
        numbers = {t: k for k, t in enumerate(names)}
        made = vectors(docs, spark.sparkContext.broadcast(numbers))
        weight, n_docs, n_all = weights(made, len(names))
        shards = index(made, weight, n_docs, n_all)
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(group)], "item int, item_id long")
        hits = search(shards, [np.array(sorted(numbers[t] for t in own), np.int64) for _, own in group], len(names), top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        part = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
