"""Operator 8, line dedup: pairwise alignment of overlapping documents.

Texts are cut into units: lines, and with a ``span`` (operator 8 uses ``SPAN``)
long lines into content-defined pieces (a word begins a piece if its hash is the
smallest of some span of successive words of its line), so a passage that stands
inside a longer line is cut in the same places as its other copies.  Documents that share unit hashes are aligned
by patience diff (units that are unique in both, in longest increasing order,
then the stretches between them), and every aligned common block of at least
``MIN_WORDS`` words is deleted from the later document, the one with the larger
doc_id.  A block that stands elsewhere in the later document, or once more, is no
part of one increasing alignment: a shared run that no aligned block covers
begins an alignment of its own, of the stretches from there on.

A common passage of n words is cut alike from its first ``SPAN`` words to its
last, so n - 2 * SPAN + 1 words of it at least are common units: every passage
of over 50 words holds a block of ``MIN_WORDS``.  Inside longer lines up to
SPAN - 1 words before the block and SPAN after it stay.

Candidates come from runs: from each unit on, and up to each unit, the shortest
run of units with ``MIN_WORDS`` words.  Two documents share a block worth deleting
exactly if they share a run, and the runs inside a block cover it, so blocks of
any two documents go although not all pairs are aligned.  Each holder of a run is paired with its earliest holder, so
a rare run gives one pair, a run that a third of all documents hold gives one
pair for each, and no group is expanded into all pairs; no frequency is left
out.  Alignment needs only unit hashes, so texts are not sent along.  Runs only
propose (their keys are sums of unit hashes): what goes is decided by aligned units.

Units are compared as they are (lines are split at line feeds).  Null and empty
texts have one line without words and stay; a null doc_id is neither compared nor
changed; rows with one doc_id are not compared with one another; an empty table
gives no rows; extra columns are kept by ``clean`` (its own output names
``n_lines``, ``removed`` are replaced).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, steps, stored, text_column
from .near_dup import _SPACE, mixed

MIN_WORDS = 30
SPAN = 11
SALT_ROWS = 256
TEXT_KEY = "xxhash64(coalesce(cast(text as string), ''))"
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))
_VALUE[_SPACE] = 0


def cut_texts(data: np.ndarray, texts: np.ndarray, span: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The units of texts that stand one behind the other, each from its place in ``texts`` on: first byte, end, number of words, line and text of each.

    Lines are counted through all texts.  Every line starts a unit, and so does
    (with a ``span``, of 16 at most) the word with the smallest hash, the last one
    of equals, of each ``span`` successive words of a line.
    """
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = texts[texts < len(data)]
    first[begins] = word[begins]
    at = np.flatnonzero(first)
    feeds = np.flatnonzero(data == 10)
    # The last line of a text may be empty and begin where the next text does.
    text_of = np.concatenate([np.arange(len(texts)), np.searchsorted(texts, feeds, "right") - 1])
    lines = np.concatenate([texts, feeds + 1])
    order = np.lexsort((lines, text_of))
    lines, text_of = lines[order], text_of[order]
    starts, of = lines, np.arange(len(lines))
    line = np.searchsorted(lines, at, "right") - 1
    n = len(at) - span + 1 if span else 0
    if n > 0:
        value = mixed(np.add.reduceat(_VALUE[data], at)) & ~np.uint64(15)
        least = value[:n] | np.uint64(span - 1)
        for k in range(1, span):
            np.minimum(least, value[k:k + n] | np.uint64(span - 1 - k), out=least)
        place = np.arange(n) + (span - 1 - (least & np.uint64(15)).astype(np.int64))
        place = np.unique(place[line[:n] == line[span - 1:]])
        inner = place[(place > 0) & (line[place] == line[place - 1])]
        starts, of = np.concatenate([lines, at[inner]]), np.concatenate([of, line[inner]])
        order = np.argsort(starts, kind="stable")
        starts, of = starts[order], of[order]
    ends = np.append(starts[1:], len(data))
    text = text_of[of]
    ends[:-1] -= (of[1:] != of[:-1]) & (text[1:] == text[:-1])
    words = np.diff(np.searchsorted(at, np.append(starts, len(data) + 1)))
    return starts, ends, words, of, text


def cut(raw: bytes, span: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The units of a text: first byte, end, number of words and line of each."""
    return cut_texts(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64), span)[:4]


def _digests(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> list[int]:
    return [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


def unit_codes(raw: bytes, span: int | None) -> tuple[list[int], list[int]]:
    """The hash and the number of words of each unit."""
    starts, ends, words, _ = cut(raw, span)
    return _digests(raw, starts, ends), words.tolist()


_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def runs(codes: np.ndarray, words: np.ndarray, min_words: int = MIN_WORDS, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first units and ends of the shortest runs with ``min_words`` words from, and up to, each unit that has words, by first unit.

    A key is the polynomial of the run's unit hashes, modulo 2^64, mixed.
    ``bounds``: where the units of each text begin, and the end of the last, if
    they are of several texts; no run goes beyond its text.
    """
    size = words.astype(np.int64)
    low, high = (0, len(size)) if bounds is None else (np.repeat(x, np.diff(bounds)) for x in (bounds[:-1], bounds[1:]))
    after = np.cumsum(size)
    end = np.searchsorted(after, after - size + min_words) + 1
    full = np.flatnonzero((size > 0) & (end <= high))
    # The last unit from which on a run up to this one has enough words.
    start = np.searchsorted(after - size, after - min_words, "right") - 1
    back = np.flatnonzero((size > 0) & (start >= low))
    spans = np.unique(np.concatenate([full << 32 | end[full], start[back] << 32 | (back + 1)]))
    first, last = spans >> 32, spans & 0xFFFFFFFF
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _powers(_BASE, len(codes))[:-1], out=sums[1:])
    return mixed((sums[last] - sums[first]) * _powers(_INVERSE, len(codes))[first]), first, last


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of entries that are unique in both, in the longest increasing order."""
    in_a, in_b = Counter(a), Counter(b)
    place = {x: i for i, x in enumerate(a) if in_a[x] == 1}
    pairs = [(place[x], j) for j, x in enumerate(b) if in_b[x] == 1 and x in place]
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(tails, i)
        if k == len(tails):
            tails.append(i)
            at.append(n)
        else:
            tails[k], at[k] = i, n
        back.append(at[k - 1] if k else -1)
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _numbered(x: list) -> list[tuple]:
    seen: Counter = Counter()
    out = []
    for e in x:
        out.append((e, seen[e]))
        seen[e] += 1
    return out


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Patience diff: matched places (i, j), increasing in both.

    Where no entry is unique in both, the n-th occurrence of an entry in one
    is taken as that of the other.
    """
    out, regions = [], [(0, len(a), 0, len(b))]
    while regions:
        i, i_end, j, j_end = regions.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        x, y = a[i:i_end], b[j:j_end]
        found = [] if set(x).isdisjoint(y) else _anchors(x, y) or _anchors(_numbered(x), _numbered(y))
        last_i, last_j = i, j
        for di, dj in found:
            out.append((i + di, j + dj))
            regions.append((last_i, i + di, last_j, j + dj))
            last_i, last_j = i + di + 1, j + dj + 1
        if found:
            regions.append((last_i, i_end, last_j, j_end))
    return sorted(out)


def _blocks(pairs: list[tuple[int, int]], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, end) of the matched stretches of b, without gaps on either side, that have ``min_words`` words."""
    out, k = [], 0
    while k < len(pairs):
        n = 1
        while k + n < len(pairs) and pairs[k + n] == (pairs[k][0] + n, pairs[k][1] + n):
            n += 1
        j = pairs[k][1]
        if sum(words[j:j + n]) >= min_words:
            out.append((j, j + n))
        k += n
    return out


def _shared_alignment(a: list, b: list) -> list[tuple[int, int]]:
    """``align`` over the units that both hold; the others can match nothing."""
    in_a = set(a)
    at_b = [j for j, x in enumerate(b) if x in in_a]
    in_b = {b[j] for j in at_b}
    at_a = [i for i, x in enumerate(a) if x in in_b]
    return [(at_a[i], at_b[j]) for i, j in align([a[i] for i in at_a], [b[j] for j in at_b])]


def common_units(a: list, b: list, words: list[int], min_words: int = MIN_WORDS, seeds=lambda: ()) -> list[int]:
    """Units of ``b`` inside aligned common blocks of at least ``min_words`` words (``words``: of the units of b).

    ``seeds()``: (first unit of b, end, first unit of a) of the runs both share,
    by first unit; asked for only where units that both hold are left.
    """
    gone = bytearray(len(b))
    for j, end in _blocks(_shared_alignment(a, b), words, min_words):
        gone[j:end] = b"\1" * (end - j)
    # A further block lies in a stretch of shared units that is long enough and has not gone as a whole.
    in_a, total, stays, further = set(a), 0, False, False
    for x, n, out in zip(b, words, gone):
        total, stays = (total + n, stays or not out) if x in in_a else (0, False)
        further |= stays and total >= min_words
    for j, end, i in seeds() if further else ():
        if all(gone[j:end]):
            continue
        # The block was moved or repeated: align on from here, up to what has gone already.
        stop = gone.find(1, end)
        stop = len(b) if stop < 0 else stop
        for x, y in _blocks(align(a[i:i + stop - j], b[j:stop]), words[j:stop], min_words):
            gone[j + x:j + y] = b"\1" * (y - x)
    return [j for j, x in enumerate(gone) if x]


def described(texts: pa.LargeStringArray, min_words: int, span: int | None) -> tuple[list[bytes], list[bytes], pa.ListArray]:
    """Unit hashes, words of each unit and distinct run keys of every text, found in one go for all."""
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2].slice(places[0], places[-1] - places[0]).to_pybytes() if places[-1] > places[0] else b""
    starts, ends, words, _, text = cut_texts(np.frombuffer(raw, np.uint8), places[:-1] - places[0], span)
    codes = np.array(_digests(raw, starts, ends), np.uint64)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    keys, first, _ = runs(codes, words, min_words, bounds)
    of = text[first]
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    keys, of = keys[new], of[new]
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32()), pa.array(keys.view(np.int64)))
    part = lambda x, k: [x[a * k:b * k] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return part(codes.tobytes(), 8), part(words.astype(np.uint32).tobytes(), 4), lists


def _describe(min_words: int, span: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                codes, words, keys = described(text_column(step.column("text")), min_words, span)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), step.column("text_key"), pa.array(codes, pa.binary()), pa.array(words, pa.binary()), keys],
                    schema=pa.schema([step.schema.field("doc_id"), step.schema.field("text_key"), ("codes", pa.binary()), ("words", pa.binary()), ("keys", pa.list_(pa.int64()))]))
    return run


def _seeds(codes: np.ndarray, words: np.ndarray, keys: np.ndarray, places: np.ndarray, min_words: int):
    """(first unit, end, first unit in the other) of the runs whose keys are in the sorted ``keys`` (at ``places`` there)."""
    own, start, end = runs(codes, words, min_words)
    if not len(keys):
        return ()
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == own)
    return zip(start[hit].tolist(), end[hit].tolist(), places[at[hit]].tolist())


def _align(min_words: int):
    def run(later: pa.Table, first: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "text_key": [], "units": []}
        unpacked = lambda t: zip(*(t.column(c).to_pylist() for c in ("codes", "words")))
        if first.num_rows:
            firsts = []
            for codes, words in unpacked(first):
                c = np.frombuffer(codes, np.uint64)
                keys, places, _ = runs(c, np.frombuffer(words, np.uint32), min_words)
                keys, at = np.unique(keys, return_index=True)
                firsts.append((c.tolist(), keys, places[at]))
            for doc, key, (codes, words) in zip(later.column("doc_id").to_pylist(), later.column("text_key").to_pylist(), unpacked(later)):
                c, w = np.frombuffer(codes, np.uint64), np.frombuffer(words, np.uint32)
                b, sizes = c.tolist(), w.tolist()
                gone = {j for a, keys, places in firsts for j in common_units(a, b, sizes, min_words, lambda: _seeds(c, w, keys, places, min_words))}  # noqa: B023
                if gone:
                    out["doc_id"].append(doc)
                    out["text_key"].append(key)
                    out["units"].append(sorted(gone))
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "text_key": pa.array(out["text_key"], pa.int64()), "units": pa.array(out["units"], pa.list_(pa.int32()))})
    return run


def common_blocks(docs: DataFrame, min_words: int = MIN_WORDS, span: int | None = None) -> DataFrame:
    """doc_id, text_key, units: the units of each later document that stand in an earlier one."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", f"{TEXT_KEY} text_key", "cast(text as string) text").where("doc_id is not null")
    lined = stored(rows.mapInArrow(_describe(min_words, span), "doc_id long, text_key long, codes binary, words binary, keys array<long>"), "lines")
    keys = lined.select("doc_id", F.explode("keys").alias("key"))
    # One shuffle of the keys: an aggregate joined back would take two.
    firsts = keys.withColumn("first", F.min("doc_id").over(Window.partitionBy("key")))
    pairs = stored(firsts.where("first < doc_id").select("first", "doc_id").distinct(), "line-pairs")
    sizes = pairs.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    # Dealt out by document once: the aggregate and both joins go on from there.
    content = lined.drop("keys").repartition("doc_id").groupBy("doc_id", "text_key").agg(F.first("codes").alias("codes"), F.first("words").alias("words"))
    # Joined alike at every size: none of these sides is bounded.
    content = content.hint("merge")
    left = (pairs.join(sizes.hint("merge"), "first").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts"))).join(content, "doc_id")
            .select("first", "salt", "doc_id", "text_key", "codes", "words"))
    right = (sizes.join(content.withColumnRenamed("doc_id", "first"), "first")
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select("first", "salt", "codes", "words"))
    fresh = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns))  # noqa: E731  a cogroup's sides must not share columns
    found = fresh(left).groupBy("first", "salt").cogroup(fresh(right).groupBy("first", "salt")).applyInArrow(_align(min_words), "doc_id long, text_key long, units array<int>")
    return (found.groupBy("doc_id", "text_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("units")))).alias("units")))


def without(raw: bytes, gone: list[int], span: int | None) -> tuple[bytes, list[int]]:
    """A text without some of its units, and the lines that went as a whole (with their line feeds)."""
    starts, ends, _, line = cut(raw, span)
    stays = np.ones(len(starts), bool)
    stays[gone] = False
    left: dict[int, list[bytes]] = {}
    for a, b, k in zip(starts[stays].tolist(), ends[stays].tolist(), line[stays].tolist()):
        left.setdefault(k, []).append(raw[a:b])
    return b"\n".join(b"".join(x) for x in left.values()), [k for k in range(int(line[-1]) + 1) if k not in left]


def _delete(span: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                column, gone = step.column("text"), step.column("removed")
                some = pc.greater(pc.list_value_length(gone), 0)
                removed, texts = [[] for _ in range(len(gone))], []
                for row in np.flatnonzero(some.to_numpy(zero_copy_only=False)).tolist():
                    left, removed[row] = without(column[row].as_py().encode(), gone[row].as_py(), span)
                    texts.append(left.decode())
                sizes = pc.add(pc.count_substring(text_column(column), "\n"), 1).cast(pa.int32())
                new = {"text": pc.replace_with_mask(column, some, pa.array(texts, column.type)) if texts else column, "removed": pa.array(removed, pa.list_(pa.int32()))}
                columns = [new.get(name, column) for name, column in zip(step.schema.names, step.columns)]
                yield pa.RecordBatch.from_arrays([*columns, sizes], names=[*step.schema.names, "n_lines"])
    return run


def clean(docs: DataFrame, min_words: int = MIN_WORDS, span: int | None = None) -> DataFrame:
    """``docs`` with the blocks deleted from ``text``; ``removed``: the lines deleted as a whole, ``n_lines``: lines before.

    ``span``: cut long lines into pieces; without it the units are whole lines.
    """
    docs = docs.drop("n_lines", "removed")
    blocks = stored(common_blocks(docs, min_words, span), "blocks")
    # The whole row as one column: no name of the input meets one of ours.
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.expr(TEXT_KEY).alias("text_key"))
    # Texts are dealt out by document at every size; broadcasting the deletions
    # would only do while they are few.
    joined = (keyed.join(blocks.hint("merge"), ["doc_id", "text_key"], "left")
              .select("row.*", F.coalesce("units", F.array().cast("array<int>")).alias("removed")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema) + ", n_lines int"
    return joined.mapInArrow(_delete(span), schema)
