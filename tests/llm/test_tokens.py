"""Operators 1, 9 and 10 against the tokenizers library, and the file format against itself."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emberlog.llm import bpe_automaton, dac, packing, registered, tokens

from helpers import BYTE_BPE, SF, TEXTS, WORD_BPE, documents, texts_of

LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE_BPE, WORD_BPE)}


def ids(text, path=BYTE_BPE):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


@pytest.mark.parametrize("path,word_ends", [(BYTE_BPE, False), (WORD_BPE, True)])
def test_chunked_ids_are_the_librarys(path, word_ends):
    found, at = tokens.encode_column(pa.array(TEXTS, pa.string()), tokens.library_cache(path, word_ends))
    for text, a, b in zip(TEXTS, at, at[1:]):
        assert found[a:b].tolist() == ids(text, path), text


alphabet = st.sampled_from(list("abtheinx .,'\n\t\r12é́İ日   \x1c\x85<|>") + ["<|endoftext|>", " the", "aaaa", "'s", "🙂", "word%%%", "é.", "×!", "x...", "#$&", "it's;"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(alphabet, max_size=25).map("".join), max_size=5))
def test_random_texts(texts):
    column = pa.array(texts, pa.string())
    for encode, path in ((lambda c: tokens.encode_column(c, tokens.library_cache(BYTE_BPE)), BYTE_BPE),
                         (lambda c: tokens.encode_column(c, tokens.library_cache(WORD_BPE, True)), WORD_BPE),
                         (lambda c: bpe_automaton.encode_column(c, BYTE_BPE), BYTE_BPE)):
        found, at = encode(column)
        assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ids(t, path) for t in texts]
    found, at = bpe_automaton.encode_column(column, BYTE_BPE)
    assert bpe_automaton.decode_column(found, at, BYTE_BPE) == [LIBRARY[BYTE_BPE].decode(ids(t), skip_special_tokens=False) for t in texts]


def test_marks_are_cut_off_words_only():
    texts = pa.array(["ab... cd%%% é!x ×! 3. (a). it's; .. a", "," * 30 + " b" + "!" * 30], pa.string())
    chunks, first = tokens.chunk_column(tokens.text_column(texts))
    assert chunks.to_pylist()[:14] == ["ab", "...", " cd", "%%%", " é!x", " ×!", " 3.", " (a).", " it's", ";", " ..", " a", "," * 30, " b" + "!" * 30]
    assert first.tolist() == [0, 12, 14]
    assert not tokens.cuts_marks(["<|end|>", "[!]"]) and tokens.cuts_marks(["<|end|>"])


def test_cache_is_bounded_by_bytes(monkeypatch):
    """Texts without blanks are one chunk each: they are encoded and not kept; the rest fills two generations at most."""
    monkeypatch.setattr(tokens, "CACHE_BYTES", 20_000)
    cache = tokens.ChunkCache(*tokens.library_encoder(BYTE_BPE, False))
    long = ["日本語テキスト" * 3000 + str(i) for i in range(5)]
    found, at = tokens.encode_column(pa.array(long), cache)
    assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ids(t) for t in long] and not cache
    for step in range(12):
        texts = [" ".join(f"w{step}x{i}" for i in range(60)), "the same words. every step!"]
        found, at = tokens.encode_column(pa.array(texts), cache)
        assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ids(t) for t in texts]
    assert cache.older and len(cache) + len(cache.older) < 400
    assert "the" in cache or "the" in cache.older


def test_gadgets_keep_rule_order():
    """Overlapping and repeated rules on a tiny vocabulary, against merging rule by rule."""
    labels = {0: b"a", 1: b"b", 2: b"c", 3: b"ab", 4: b"bc", 5: b"aa", 6: b"aaa", 7: b"abc"}
    merges = [(1, 2, 4), (0, 0, 5), (0, 1, 3), (5, 0, 6), (3, 2, 7)]
    automaton = bpe_automaton.Automaton(labels, merges)

    def merged(word):
        out = [b"abc".index(x) for x in word]
        for a, b, c in merges:
            i = 0
            while i < len(out) - 1:
                if out[i:i + 2] == [a, b]:
                    out[i:i + 2] = [c]
                i += 1
        return out

    for n in range(1, 8):
        for k in range(3**n):
            word = bytes(b"abc"[k // 3**i % 3] for i in range(n))
            assert automaton.encode(word) == merged(word), word


def test_op10_awkward_and_whole_table(spark):
    got = Counter(tuple(r) for r in bpe_automaton.round_trip(documents(spark), BYTE_BPE).collect())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    row = lambda d, t: (d, len(ids(t)), sha(",".join(map(str, ids(t)))), sha(LIBRARY[BYTE_BPE].decode(ids(t), skip_special_tokens=False)))
    assert got == Counter(row(r.doc_id, r.text) for r in documents(spark).collect())
    assert bpe_automaton.round_trip(documents(spark, empty=True), BYTE_BPE).count() == 0
    whole = {r.doc_id: tuple(r) for r in registered.op10(spark, SF).collect()}
    assert whole == {d: row(d, t) for d, t in texts_of().items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1200))
def test_dac_round_trip_and_random_access(values):
    data = dac.file_bytes([5, None], np.array([0, len(values), len(values)]), np.array(values, "<u4"))
    touched = []

    def read(start, length):
        touched.append(length)
        return data[start:start + length]

    f = dac.DacFile(read)
    assert f.tokens().tolist() == values
    assert f.documents()[0] == [5, None]
    touched.clear()
    for at in range(0, len(values), 97):
        assert f.token(at) == values[at]
    assert all(n <= 65 for n in touched)  # never more than one bitmap block
    with pytest.raises(IndexError):
        f.token(len(values))


def test_op9_files(spark, tmp_path):
    docs = documents(spark)
    manifest = dac.write_ids(docs, f"file://{tmp_path}", WORD_BPE, word_ends=True)
    got = dac.read_ids(manifest).orderBy("start").collect()
    expected = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    start = 0
    for row, (known, doc, text) in zip(got, expected, strict=True):
        own = [*ids(text, WORD_BPE), 2]
        assert tuple(row) == (doc if known else None, start, len(own), crc(own))
        start += len(own)
    first = manifest.orderBy("part", "segment").first()
    assert dac.open_dac(first.path).token(0) == [*ids(expected[0][2], WORD_BPE), 2][0]
    assert dac.token_files(spark, documents(spark, empty=True), WORD_BPE, True).count() == 0


def test_op9_whole_table(spark):
    start, expected = 0, []
    for doc, text in sorted(texts_of().items()):
        own = [*ids(text, WORD_BPE), 2]
        expected.append((doc, start, len(own), crc(own)))
        start += len(own)
    assert sorted(map(tuple, registered.op9(spark, SF).collect())) == expected


def check_packing(rows, texts, capacity):
    """Every id in exactly one slot, slots gapless, only the first piece of a document short."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        own = [*ids(text), 2]
        pieces = sorted(by_doc.pop(doc), key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(own) // capacity)))
        assert all(p.length == capacity for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == crc(own[at:at + p.length])
            at += p.length
        assert at == len(own)
    assert not by_doc
    for slots in by_sequence.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence), sum(r.length for r in rows)


def test_op1_whole_table(spark):
    sequences, total = check_packing(registered.op1(spark, SF).collect(), texts_of(), 1024)
    assert sequences <= -(-total // 1024) + 1


def test_op1_awkward(spark):
    docs = documents(spark)
    rows = packing.pack_documents(docs, BYTE_BPE, capacity=64).collect()
    unique = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (None, 6)}
    check = [r for r in rows if r.doc_id in unique]
    assert sum(r.doc_id == 6 and r.piece == 0 for r in rows) == 3
    by = defaultdict(list)
    for r in check:
        assert len(r.ids) == 4 * r.length
        by[r.doc_id].append(r.piece)
    assert by.keys() == unique.keys()
    slots = defaultdict(list)
    for r in rows:
        slots[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in s) <= 64 and len(set(s)) == len(s) for s in slots.values())
    assert packing.pack_documents(documents(spark, empty=True), BYTE_BPE).count() == 0
    half = packing.pack_documents(docs, BYTE_BPE, capacity=64, id_bits=16)
    bare = lambda rows: sorted((r.doc_id or -1, r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in rows)
    assert bare(half.collect()) == bare(rows)


def test_pack_replaces_clashing_names_and_keeps_unfit_items(spark):
    items = spark.createDataFrame([(1, 3, "x", 9), (2, 3, "x", 9), (3, None, "x", 9), (4, 99, "x", 9), (5, 7, "x", 9)], "k long, length long, offset string, rank int")
    got = {r.k: r for r in packing.pack(items, ["k"], 10).collect()}
    assert got[3].sequence_id is got[4].sequence_id is None
    assert len({got[k].sequence_id for k in (1, 2, 5)}) == 2


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=20))
def test_plan_is_best_fit_decreasing(histogram):
    """The plan over counts needs as many sequences as best fit over single items."""
    rooms = []
    for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(50 - length)
    used = defaultdict(list)
    seen = Counter()
    for length, rank, items, first, each, offset in packing.plan(histogram, 50):
        assert rank == seen[length]
        seen[length] += items
        for n in range(items):
            used[first + n // each].append((offset + n % each * length, length))
    assert seen == Counter(histogram) and len(used) == len(rooms)
    for slots in used.values():
        ends = sorted(slots)
        assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:])) and ends[0][0] == 0 and sum(ends[-1]) <= 50
