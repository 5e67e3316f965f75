"""Operator 1, best-fit packing by a plan over the length histogram.

``cut_documents`` turns each text into token ids (with an end id) and cuts only
texts longer than the capacity.  ``plan`` packs the *histogram* of lengths:
longest first, each length goes into the fullest sequences that still hold it,
a whole run of equal sequences at a time, so its work depends on the number of
distinct lengths and not on the number of documents.  ``pack`` then ranks the
items of each length and joins each to its planned slot by its rank.

The plan is made on the driver from at most ``capacity`` counts.  Ranks come
from counts of (length, salt) groups: a length that a third of all rows share
is numbered in ``SALTS`` pieces, also where its rows are exact repeats (each has
a stored number of its own).

Edge cases: a null or empty text is one item with the end id; rows repeated
exactly are separate items; an empty table packs to no rows; items with a null
length, or one outside 1..capacity, get a null slot; of other columns ``pack``
keeps all but its own output names, which it replaces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import prepare, steps, stored

CAPACITY = 1024
SALTS = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_ORDER = ["doc_id", "piece", "start", "ids_crc32", "row"]


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document row, piece number, start) of all pieces; only the first of a document may be shorter."""
    counts = -(-lengths // capacity)
    row = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = lengths - (counts - 1) * capacity
    start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
    return row, piece, start


def _cutter(tokenizer: str, word_ends: bool, end_id: int, capacity: int, id_bits: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.library_cache(tokenizer, word_ends)
        for batch in batches:
            for step in steps(batch, "text"):
                ids, starts = tokens.encode_column(step.column("text"), cache)
                all_ids = np.insert(ids, starts[1:], np.uint32(end_id))
                begins = starts + np.arange(len(starts))
                row, piece, start = cut(np.diff(begins), capacity)
                places = np.append(begins[row] + start, len(all_ids))
                raw, at = memoryview(all_ids).cast("B"), (4 * places).tolist()
                columns = {"doc_id": step.column("doc_id").take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start),
                           "length": pa.array(np.diff(places)), "ids_crc32": pa.array([zlib.crc32(raw[x:y]) for x, y in zip(at, at[1:])], pa.int64())}
                if id_bits:
                    held = all_ids.astype(f"<u{id_bits // 8}")
                    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer((id_bits // 8) * places.astype("<i8")), pa.py_buffer(held)])
                    columns["ids"] = pc.cast(blobs, pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return run


def cut_documents(docs: DataFrame, tokenizer: str, word_ends: bool = False, end_id: int = 2, capacity: int = CAPACITY, id_bits: int | None = 32) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids, row of all pieces, stored.

    ``ids``: unsigned little endian of ``id_bits`` (None: without ids); the
    checksum is that of the 32-bit form.  ``row`` tells repeated pieces apart.
    """
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    pieces = rows.mapInArrow(_cutter(tokenizer, word_ends, end_id, capacity, id_bits), PIECES + (", ids binary" if id_bits else ""))
    return stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns runs (length, first rank, items, first sequence, items per
    sequence, offset): the item of a rank in the run goes to sequence
    ``first + (rank - first rank) // per`` at ``offset + ((rank - first rank) % per) * length``.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, count)
    sizes: list[int] = []
    runs, opened = [], 0

    def put(free: int, first: int, count: int) -> None:
        if free and count:
            if free not in room:
                room[free] = []
                insort(sizes, free)
            if room[free] and sum(room[free][-1]) == first:
                first, count = room[free][-1][0], room[free].pop()[1] + count
            room[free].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                free = sizes[at]
                first, count = room[free].pop()
                if not room[free]:
                    del room[free]
                    sizes.pop(at)
            else:
                free, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            each = min(free // length, left)
            used = min(count, left // each)
            runs.append((length, rank, used * each, first, each, capacity - free))
            put(free - each * length, first, used)
            put(free, first + used, count - used)
            rank, left = rank + used * each, left - used * each
    return runs


def _widened(rows: pa.StructArray) -> pa.StructArray:
    """The field ``ids`` from 16 to 32 bits."""
    columns, names = rows.flatten(), [f.name for f in rows.type]
    at = names.index("ids")
    columns[at] = pa.array([np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in columns[at].to_pylist()], pa.binary())
    return pa.StructArray.from_arrays(columns, names)


def _placer(shared, widen: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, _, first, each, offset = shared.value
        keys = (length << 44) + rank
        for batch in batches:
            own, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (own << 44) + number, "right") - 1
            nth = number - rank[at]
            row = _widened(batch.column("row")) if widen else batch.column("row")
            yield pa.RecordBatch.from_arrays([row, pa.array(first[at] + nth // each[at]), pa.array(offset[at] + nth % each[at] * own)], names=["row", "sequence_id", "offset"])
    return run


def ranked(items: DataFrame, order: list[str]) -> DataFrame:
    """row, length, rank: ``rank`` numbers the items of each length from 0, by salted groups."""
    salted = items.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    groups = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order))
    return (salted.withColumn("nth", inside).join(bases, ["length", "salt"])
            .select("row", "length", (F.col("base") + F.col("nth") - 1).alias("rank")))


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY, widen: bool = False) -> DataFrame:
    """``items`` (a stored table with a ``length`` column) with ``sequence_id`` and ``offset``.

    ``order`` names columns that tell items of one length apart; ``widen``:
    a column ``ids`` of 16-bit ids comes out with 32.
    """
    spark = items.sparkSession
    # The whole item as one column: no name of the input meets one of ours.
    whole = items.drop("sequence_id", "offset").select(F.struct("*").alias("row"), F.col("length").cast("long").alias("length"))
    fits = F.coalesce(F.col("length").between(1, capacity), F.lit(False))
    good = whole.where(fits)
    histogram = {r["length"]: r["count"] for r in good.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = sorted(plan(histogram, capacity))
    shared = spark.sparkContext.broadcast(tuple(np.array(x, np.int64) for x in zip(*runs)) if runs else (np.zeros(0, np.int64),) * 6)
    placed = (ranked(good, [f"row.{c}" for c in order])
              .mapInArrow(_placer(shared, widen), f"row {whole.schema['row'].dataType.simpleString()}, sequence_id long, offset long"))
    unfit = whole.where(~fits).select("row", F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    return unfit.unionByName(placed).select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, word_ends: bool = False, end_id: int = 2, capacity: int = CAPACITY, id_bits: int = 32) -> DataFrame:
    """Pieces of all documents with their ids and slots: the packed corpus, one row per piece.

    ``id_bits``: 16 for a vocabulary of at most 65,536 ids, which then move
    through the shuffle in half the bytes; the result has 32-bit ids.
    """
    pieces = cut_documents(docs, tokenizer, word_ends, end_id, capacity, id_bits)
    return pack(pieces, PIECE_ORDER, capacity, widen=id_bits == 16).drop("row")


def piece_slots(docs: DataFrame, tokenizer: str, word_ends: bool = False, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """As ``pack_documents``, with each piece's checksum in place of its ids (they are neither stored nor shuffled)."""
    return pack(cut_documents(docs, tokenizer, word_ends, end_id, capacity, None), PIECE_ORDER, capacity).drop("row")
