"""Operator 9, token-ID output: directly addressable codes.

An id is split into 8-bit levels, lowest first.  Level 0 holds one byte for
every id; a continuation bitmap marks the ids that have more, and their next
byte stands in level 1 at the rank of that mark, and so on.  A rank directory
(marks before each block of 512) makes a rank one table look-up and one count
inside a block, so any single id is read by a few bytes per level, without
decoding its neighbours.

``write_ids`` encodes ``documents`` and writes one ``part-*.dac`` file for each
run of documents in ascending id order; ``read_ids`` reads the files back.
Files are written under a temporary name and renamed, and their names follow
from the partition, so a task that runs again leaves the same files.

File: ``DAC1``, u32 header length, JSON header (counts, byte places), then the
sections: document ids (i64), id-is-null flags (u8), first token of each
document (u64, with the end), and per level bytes, bitmap, rank directory.

Edge cases: a null or empty text has only the end id; a null doc_id sorts
first and stays null, rows of one id by text; rows repeated exactly are written once each; an empty
table writes no file and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import tokens
from .common import prepare, shuffle_partitions, steps, stored

MAGIC = b"DAC1"
BLOCK = 512
SEGMENT_TOKENS = 1 << 20
MANIFEST = "part int, segment int, path string, n_docs long, n_tokens long"


def pack_levels(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """(bytes, continuation bitmap, rank directory) of each level."""
    levels, rest = [], ids.astype("<u4")
    while len(rest) or not levels:
        more = rest > 255
        marks = np.packbits(more, bitorder="little")
        per_block = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        ranks = np.concatenate([[0], np.cumsum(per_block)[:-1]]) if len(per_block) else per_block
        levels.append(((rest & 255).astype(np.uint8).tobytes(), marks.tobytes(), ranks.astype("<u8").tobytes()))
        rest = rest[more] >> 8
    return levels


def file_bytes(doc_ids: list, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file; ``starts`` has the first token of each document and the end."""
    sections = [np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
                np.array([d is None for d in doc_ids], np.uint8).tobytes(),
                starts.astype("<u8").tobytes()]
    levels = pack_levels(ids)
    for level in levels:
        sections.extend(level)
    places = np.cumsum([0, *map(len, sections)]).tolist()
    head = json.dumps({"docs": len(doc_ids), "tokens": len(ids), "counts": [len(x[0]) for x in levels], "places": places}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections])


class DacFile:
    """Random access to one file through ``read(offset, length)``."""

    def __init__(self, read):
        if read(0, 4) != MAGIC:
            raise ValueError("not a DAC1 file")
        size = struct.unpack("<I", read(4, 4))[0]
        self.head = json.loads(read(8, size))
        self._read, self._base = read, 8 + size

    def section(self, k: int, start: int = 0, length: int | None = None) -> bytes:
        lo, hi = self.head["places"][k:k + 2]
        return self._read(self._base + lo + start, hi - lo if length is None else length)

    def documents(self) -> tuple[list, np.ndarray]:
        known = np.frombuffer(self.section(0), "<i8").tolist()
        null = np.frombuffer(self.section(1), np.uint8)
        return [None if n else d for d, n in zip(known, null)], np.frombuffer(self.section(2), "<u8").astype(np.int64)

    def _mark(self, level: int, at: int) -> int | None:
        """The id's place in the next level, or None where it ends."""
        block = at // BLOCK
        bits = self.section(4 + 3 * level, block * BLOCK // 8, (at % BLOCK) // 8 + 1)
        if not bits[-1] >> at % 8 & 1:
            return None
        before = int.from_bytes(bits, "little") & (1 << at % BLOCK) - 1
        return struct.unpack("<Q", self.section(5 + 3 * level, 8 * block, 8))[0] + before.bit_count()

    def token(self, at: int) -> int:
        """The id at place ``at``: one byte, one bitmap part and one rank for each level."""
        if not 0 <= at < self.head["tokens"]:
            raise IndexError(at)
        value = level = 0
        place: int | None = at
        while place is not None:
            value |= self.section(3 + 3 * level, place, 1)[0] << 8 * level
            place, level = self._mark(level, place), level + 1
        return value

    def tokens(self) -> np.ndarray:
        """All ids, level by level."""
        out = np.zeros(self.head["tokens"], "<u4")
        at = np.arange(len(out))
        for level, count in enumerate(self.head["counts"]):
            out[at] |= np.frombuffer(self.section(3 + 3 * level), np.uint8).astype("<u4") << np.uint32(8 * level)
            marks = np.unpackbits(np.frombuffer(self.section(4 + 3 * level), np.uint8), count=count, bitorder="little")
            at = at[marks.view(bool)]
        return out


def open_dac(path: str):
    """``DacFile`` of a path or URI; reads only the ranges it is asked for."""
    system, name = fs.FileSystem.from_uri(path)
    source = system.open_input_file(name)
    return DacFile(lambda start, length: source.read_at(length, start))


def _put(path: str, data: bytes) -> None:
    system, name = fs.FileSystem.from_uri(path)
    draft = f"{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, name)


def _writer(folder: str, tokenizer: str, word_ends: bool, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        docs, lengths, held, total = [], [], [], 0
        cache = tokens.library_cache(tokenizer, word_ends)

        def flush():
            path = f"{folder}/part-{part:05d}-{segment:05d}.dac"
            _put(path, file_bytes(docs, np.cumsum([0, *lengths]), np.concatenate(held)))
            return pa.RecordBatch.from_pylist([{"part": part, "segment": segment, "path": path, "n_docs": len(docs), "n_tokens": total}], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        for batch in batches:
            for step in steps(batch, "text"):
                ids, starts = tokens.encode_column(step.column("text"), cache)
                n = np.diff(starts) + 1
                with_end = np.insert(ids, starts[1:], np.uint32(end_id))
                docs += step.column("doc_id").to_pylist()
                lengths += n.tolist()
                held.append(with_end)
                total += len(with_end)
                if total >= SEGMENT_TOKENS:
                    yield flush()
                    docs, lengths, held, total, segment = [], [], [], 0, segment + 1
        if docs:
            yield flush()
    return write


def write_ids(docs: DataFrame, folder: str, tokenizer: str, word_ends: bool = False, end_id: int = 2) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write ``.dac`` files in ascending doc_id order.

    Returns the stored manifest: part, segment, path, n_docs, n_tokens; the
    order of (part, segment) is the order of the documents.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    # Rows of one id (null, above all) may be many: the range goes on by how their texts begin, then by row.
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, 64), "row").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    return stored(ordered.mapInArrow(_writer(folder, tokenizer, word_ends, end_id), MANIFEST), "dac-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The tokens before each file.  Only one row per partition meets in one task."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = (manifest.groupBy("part").agg(F.sum("n_tokens").alias("t"))
             .select("part", F.coalesce(F.sum("t").over(before.orderBy("part")), F.lit(0)).alias("part_start")))
    inside = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("segment")), F.lit(0))
    return (manifest.withColumn("inside", inside).join(parts, "part")
            .select("part", "segment", "path", "n_tokens", (F.col("part_start") + F.col("inside")).alias("start")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            dac = open_dac(path)
            docs, starts = dac.documents()
            raw, at = memoryview(dac.tokens().tobytes()), starts.tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(docs, pa.int64()),
                pa.array(starts[:-1] + base),
                pa.array(np.diff(starts)),
                pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at, at[1:])], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(manifest: DataFrame) -> DataFrame:
    """Each document's place, length and checksum, read from the files of a manifest."""
    spark = manifest.sparkSession
    files = with_starts(manifest).select("path", "start").repartition(shuffle_partitions(spark), "path")
    return files.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, word_ends: bool = False, end_id: int = 2) -> DataFrame:
    """Write and read back in a new folder of the shared directory."""
    return read_ids(write_ids(docs, shared_dir(spark, "token-files"), tokenizer, word_ends, end_id))
