"""Operator 5, near duplicates: multi-index Hamming join of b-bit MinHash signatures.

A text is its set of distinct word shingles.  Its signature is ``CHUNKS`` x
``WIDTH`` MinHash values of 16 bits.  Two signatures that differ in at most
``CHUNKS`` * 2 - 1 places have, by the pigeonhole principle, a chunk with at
most one error; the index lists each chunk under every choice of its one
allowed error (the other places must agree), so all pairs under that distance
meet in a bucket.  A pair at the similarity threshold 0.8 differs in 11 of 56
places on average and misses all buckets with probability 4e-11; bucket mates
that differ in more than 27 places are not compared, so in all the pair is missed
with probability 5e-7.

Buckets are never expanded into all pairs.  Texts with equal sets are one
member.  First every member of a bucket is compared with the smallest one, and
links make components.  Then, in buckets that still hold several components,
members outside the largest one meet the others in bounded blocks; a pair
counts if its components differ, its sizes allow the similarity, its signatures
are near enough, and its known exact distances to the bucket's first member
(Jaccard distance is a metric) do not exclude it.  Such members are gathered in
verification groups, with each text once, where all of them are compared on the
full sets, and only links that join components leave the group.

Texts without words have the empty set, count 0 shingles and link with nothing;
with fewer words than a shingle has, the whole sequence is the one shingle.
Rows with one doc_id are one document for linking.  A null doc_id links with
nothing and is kept; an empty table gives no rows; other columns are ignored by
``classes`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, steps, stored, text_column
from .components import components

CHUNKS, WIDTH = 14, 4
PLACES = CHUNKS * WIDTH
REACH = 2 * CHUNKS - 1
PERCENT = 80
BLOCK = 1024
SALT_ROWS = 256
TEXT_KEY = "xxhash64(coalesce(cast(text as string), ''))"

_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20)
_FLIP, _TIMES = (_rng.integers(0, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_ORDER = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_codes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (ASCII letters in lower case), and the first word of each text (with the end)."""
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset:texts.offset + len(texts) + 1]
    lo, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8, n, lo)] if n else np.zeros(0, np.uint8)
    space = _SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets - lo] = True
    word = ~space
    starts = word.copy()
    starts[1:] &= space[:-1] | first[1:n]
    stops = word.copy()
    stops[:-1] &= space[1:] | first[1:n]
    begin, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    keep = np.concatenate([[0], np.cumsum(end - begin)]).astype("<i8")
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(keep), pa.py_buffer(data[word])])
    coded = words.dictionary_encode()
    known = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return known[coded.indices.to_numpy(zero_copy_only=False)] if len(begin) else np.zeros(0, np.uint64), np.searchsorted(begin, offsets - lo)


def shingle_sets(texts: pa.LargeStringArray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    codes, first = word_codes(texts)
    sums = np.zeros(max(0, len(codes) - words + 1), np.uint64)
    for k in range(words):
        sums += codes[k:k + len(sums)] * _ORDER[k]
    sums = mixed(sums)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(sums[a:b - words + 1]))
        elif b > a:
            short = (codes[a:b] * _ORDER[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([short])))
        else:
            out.append(sums[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The 16-bit MinHash values of non-empty sets, one row each."""
    out = np.empty((len(sets), PLACES), np.uint16)
    if not sets:
        return out
    every = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    for k in range(PLACES):
        least = np.minimum.reduceat((every ^ _FLIP[k]) * _TIMES[k], at)
        out[:, k] = mixed(least) >> np.uint64(48)
    return out


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                sets = shingle_sets(text_column(step.column("text")), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows = signatures([sets[i] for i in full])
                signature: list = [None] * len(sets)
                for i, row in zip(full, rows):
                    signature[i] = row.tobytes()
                key = [b"" if not len(s) else s.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(mixed(s + np.uint64(1))).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), step.column("text_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(key, pa.binary()), pa.array(signature, pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "signature"])
    return run


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets), signature of every text, stored."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", f"{TEXT_KEY} text_key")
    return stored(rows.mapInArrow(_describe(words), "doc_id long, text_key long, n_shingles long, set_key binary, signature binary"), "signatures")


def chunk_keys(rows: np.ndarray) -> np.ndarray:
    """The index keys of signatures: one for each chunk and each place of its allowed error."""
    parts = rows.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    out = np.empty((len(rows), CHUNKS, WIDTH), np.uint64)
    for gap in range(WIDTH):
        value = (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(gap))[None, :]
        for place in (p for p in range(WIDTH) if p != gap):
            value = (value << np.uint64(16)) | parts[:, :, place]
        out[:, :, gap] = mixed(value)
    return out.reshape(len(rows), PLACES)


def signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, PLACES)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = chunk_keys(signature_rows(batch.column("signature"))).view(np.int64)
            member = np.repeat(batch.column("id").to_numpy(), PLACES)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(member)], names=["key", "id"])


def _confirm(words: int):
    """(leader block) x (its texts) -> inter and union of each pair."""
    def run(members: pa.Table, leader: pa.Table) -> pa.Table:
        size = inter = np.zeros(0, np.int64)
        total = size
        ids = members.column("b")
        if members.num_rows and leader.num_rows:
            one = shingle_sets(text_column(leader.column("text").slice(0, 1)), words)[0]
            inter_, total_ = [], []
            for step in members.combine_chunks().to_batches(max_chunksize=256):
                for other in shingle_sets(text_column(step.column("text")), words):
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    inter_.append(common)
                    total_.append(len(one) + len(other) - common)
            inter, total = np.array(inter_, np.int64), np.array(total_, np.int64)
        else:
            ids = ids.slice(0, 0)
        a = pa.array(np.full(len(inter), leader.column("a")[0].as_py() if leader.num_rows else 0, np.int64))
        return pa.table({"a": a, "b": ids, "inter": inter, "total": total})
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """a, b, inter, total on the full sets, for distinct pairs (a, b); texts has (id, text).

    The texts of all b of one a meet the text of a in groups of about
    ``SALT_ROWS``; the text of a is sent once to each group.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    groups = pairs.groupBy("a").agg(F.max("salts").alias("salts"))
    fresh = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns))  # noqa: E731  a cogroup's sides must not share columns
    left = salted.join(texts.selectExpr("id b", "text"), "b").select("a", "salt", "b", "text")
    right = (groups.join(texts.selectExpr("id a", "text"), "a")
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select("a", "salt", "text"))
    keys = ["a", "salt"]
    found = fresh(left).groupBy(*keys).cogroup(fresh(right).groupBy(*keys)).applyInArrow(_confirm(words), "a long, b long, inter long, total long")
    return stored(found, "confirmed")


def salted(pairs: DataFrame) -> DataFrame:
    """Pairs with the number of groups that the pairs of each a are split into."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    return pairs.join(sizes, "a")


def size_allows(n: str, m: str):
    """The smaller set must hold ``PERCENT`` of the larger."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            near = (signature_rows(batch.column("s")) != signature_rows(batch.column("t"))).sum(1) <= REACH
            yield batch.select(["a", "b"]).filter(pa.array(near))


def near_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Those of the pairs whose sizes and signatures allow the similarity."""
    a = members.selectExpr("id a", "n na", "signature s")
    b = members.selectExpr("id b", "n nb", "signature t")
    sized = pairs.join(a, "a").join(b, "b").where(size_allows("na", "nb"))
    return sized.select("a", "b", "s", "t").mapInArrow(_distance, "a long, b long")


# Stands for g2 in the one cell of a bucket that has a block of either kind.
WHOLE = 1 << 62


def _cross(cell: pa.Table) -> pa.Table:
    """The verification groups of one cell of a bucket: outsiders of block g1 with the members of block g2 that may be near.

    A group is (top, t1, t2): ``top`` names the bucket's largest component, t1
    the share of an outsider, t2 that of another outsider or (-1 - share) of a
    member of the largest component.  Shares are the same in all buckets.
    """
    rows, ids, comp = signature_rows(cell.column("signature")), cell.column("id").to_numpy(), cell.column("component").to_numpy()
    n, far = cell.column("n").to_numpy(), cell.column("far").to_numpy(zero_copy_only=False)
    out, block = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("outside", "block"))
    g1, g2, key = (cell.column(c)[0].as_py() for c in ("g1", "g2", "key"))
    share, keys = cell.column("share").to_numpy(), chunk_keys(rows).view(np.int64)
    others = (block == g2) | (g2 == WHOLE)
    found: set[tuple[int, int, int]] = set()
    for i in np.flatnonzero(block == g1):
        j = np.flatnonzero(others & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i]))
                           & ~(np.abs(far - far[i]) > 1 - PERCENT / 100 + 1e-9))
        j = j[(rows[j] != rows[i]).sum(1) <= REACH]
        # A pair is placed by the first of its common buckets only.
        same = keys[j] == keys[i]
        for other in j[keys[i][same.argmax(1)] == key].tolist() if len(j) else ():
            t1, t2 = (share[i], -1 - share[other]) if not out[other] else sorted((share[i], share[other]))
            found.add((int(t1), int(t2), int(ids[i])))
            found.add((int(t1), int(t2), int(ids[other])))
    t1, t2, member = zip(*sorted(found)) if found else ((), (), ())
    top = np.full(len(found), cell.column("top")[0].as_py(), np.int64)
    return pa.table({"top": pa.array(top), "t1": pa.array(t1, pa.int64()), "t2": pa.array(t2, pa.int64()), "id": pa.array(member, pa.int64())})


def _verify(words: int):
    """Links on the full sets inside one verification group, as many as join its components."""
    def run(group: pa.Table) -> pa.Table:
        ids, comp = group.column("id").to_numpy(), group.column("component").to_numpy()
        outside = comp != group.column("top")[0].as_py()
        sets = [s for step in group.select(["text"]).combine_chunks().to_batches(max_chunksize=256) for s in shingle_sets(text_column(step.column("text")), words)]
        size = np.array(list(map(len, sets)))
        _, places = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(size) - size
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        a, b = [], []
        mark = np.zeros(int(places.max()) + 1, bool)
        for i in np.flatnonzero(outside).tolist():
            own = places[starts[i]:starts[i] + size[i]]
            mark[own] = True
            inter = np.add.reduceat(mark[places], starts, dtype=np.int64)
            mark[own] = False
            similar = (100 * inter >= PERCENT * (size + size[i] - inter)) & (comp != comp[i])
            for j in np.flatnonzero(similar).tolist():
                x, y = find(comp[i]), find(comp[j])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def blocks(count):
    """So many blocks that a block of hashed ids stays below ``BLOCK``."""
    return F.ceil(1.25 * count / BLOCK)


def verification_groups(buckets: DataFrame, members: DataFrame, labels: DataFrame, known: DataFrame) -> DataFrame:
    """(top, t1, t2, id): who meets whom on the full sets, from buckets that hold several components.

    The members of a bucket's largest component and the others (outsiders) lie
    in blocks of their own, below ``BLOCK`` members each.  Outsiders are the ones
    compared: a cell holds one block of them and one other block, so no cell holds
    more than two blocks, however many members of a bucket are linked to nobody.
    Candidates are not listed as pairs: both go to a verification group that
    holds each text once.  All
    buckets with one largest component feed the same groups, so the shares that
    make these up are counted over all of them: about ``BLOCK`` members each.
    """
    of = labels.withColumnRenamed("id", "id_")
    labelled = buckets.join(of, buckets.id == of.id_, "left").select("key", "id", "leader", F.coalesce("component", "id").alias("component"))
    sizes = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n_"))
    mixed_ = (sizes.groupBy("key").agg(F.max(F.struct("n_", "component")).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("n_").alias("all"))
              .where("parts > 1").select("key", F.col("top.component").alias("top"), blocks(F.col("all") - F.col("top.n_")).alias("outer"), blocks(F.col("top.n_")).alias("inner")))
    mixed_rows = stored(labelled.join(mixed_, "key").withColumn("outside", F.col("component") != F.col("top")), "mixed-buckets")
    feeds = mixed_rows.groupBy("top", "outside", "id").agg(F.lit(1).alias("one")).groupBy("top", "outside").agg(F.count(F.lit(1)).alias("n_"))
    # Only these need more than one share: at most a row for each BLOCK rows of ``feeds``.
    large = feeds.where(F.col("n_") > BLOCK).select("top", "outside", F.ceil(F.col("n_") / BLOCK).alias("shares"))
    distances = known.selectExpr("a leader", "b id", "1 - inter / total far").unionByName(known.selectExpr("a leader", "a id", "0D far").distinct())
    # Blocks of outsiders are numbered from 0, those of the largest component from -1 down.
    block = "CASE WHEN outside THEN pmod(xxhash64(id), outer) ELSE -1 - pmod(xxhash64(id), inner) END"
    pair = lambda x, y: f"named_struct('g1', {x}, 'g2', {y})"
    cells = f"""CASE WHEN outer = 1 AND inner = 1 THEN array({pair('0L', f'{WHOLE}L')})
                WHEN NOT outside THEN transform(sequence(0L, outer - 1), x -> {pair('x', 'block')})
                ELSE concat(transform(sequence(block, outer - 1), x -> {pair('block', 'x')}),
                            transform(filter(sequence(0L, block), x -> x < block), x -> {pair('x', 'block')}),
                            transform(sequence(1L, inner), x -> {pair('block', '-x')})) END"""
    rows = (mixed_rows.join(large, ["top", "outside"], "left").join(members, "id").join(distances, ["leader", "id"], "left")
            .withColumn("share", F.pmod(F.xxhash64("id"), F.coalesce("shares", F.lit(1).cast("long"))))
            .withColumn("block", F.expr(block)).withColumn("cell", F.explode(F.expr(cells))))
    places = (rows.select("key", "cell.g1", "cell.g2", "block", "id", "n", "signature", "component", "top", "outside", "share", F.coalesce("far", F.lit(float("nan"))).alias("far"))
              .groupBy("key", "g1", "g2").applyInArrow(_cross, "top long, t1 long, t2 long, id long"))
    return stored(places.distinct(), "verification-groups")


def cross_links(buckets: DataFrame, members: DataFrame, labels: DataFrame, known: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b): links between components, from buckets that hold several."""
    of = labels.withColumnRenamed("id", "id_")
    places = verification_groups(buckets, members, labels, known)
    placed = (places.join(of, places.id == of.id_, "left").select("top", "t1", "t2", "id", F.coalesce("component", "id").alias("component"))
              .join(texts, "id"))
    return placed.groupBy("top", "t1", "t2").applyInArrow(_verify(words), "a long, b long")


def links(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(id, component) of all linked members; members has (id, n, signature), one per distinct set."""
    keys = members.select("id", "signature").mapInArrow(_index, "key long, id long")
    leaders = keys.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    buckets = stored(keys.join(leaders, "key"), "buckets")
    held = buckets.select("id").distinct()
    # Rows with one id are one document: one text stands for it, the same as in ``classes``.
    texts = (docs.selectExpr("cast(doc_id as long) id", "cast(text as string) text", f"{TEXT_KEY} text_key").join(held.hint("merge"), "id", "left_semi")
             .groupBy("id").agg(F.min_by("text", "text_key").alias("text")))
    texts = stored(texts, "member-texts")
    firsts = stored(near_pairs(buckets.where("leader <> id").selectExpr("leader a", "id b").distinct(), members), "pairs")
    known = confirmed(salted(firsts), texts, words)
    similar = f"100 * inter >= {PERCENT} * total"
    labels = components(known.where(similar).select("a", "b"))
    more = stored(cross_links(buckets, members, labels, known, texts, words), "pairs")
    if more.isEmpty():
        return labels
    return components(known.where(similar).select("a", "b").unionByName(more))


def classes(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    rows = described(docs, words)
    own = (rows.where("doc_id is not null").groupBy("doc_id")
           .agg(F.min(F.struct("text_key", "n_shingles", "set_key", "signature")).alias("r")).select("doc_id", "r.*"))
    sets = own.where("n_shingles > 0").groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("id"), F.min("signature").alias("signature"))
    members = stored(sets.withColumnRenamed("n_shingles", "n"), "members")
    labels = links(docs, members.select("id", "n", "signature"), words)
    of_set = members.join(labels, "id", "left").select("set_key", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
    of_document = (own.select("doc_id", "set_key", "n_shingles").join(of_set, ["set_key", "n_shingles"])
                   .select("doc_id", F.col("component").alias("component_id")))
    joined = rows.select("doc_id", "n_shingles").join(of_document, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id."""
    out = classes(docs, words).where("not kept").select(F.col("doc_id").alias("dropped")).distinct()
    # Texts are dealt out by document at every size.
    return docs.join(out.hint("merge"), docs["doc_id"].cast("long") == out["dropped"], "left_anti")
