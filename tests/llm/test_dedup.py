"""Operators 5 and 8 and the pipeline against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from emberlog.llm import line_dedup, near_dup, pii, quality, registered
from emberlog.llm.common import stored, text_column
from emberlog.llm.components import components
from helpers import SF, documents, texts_of
from test_tokens import check_packing


def shingles(text, words):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute_classes(texts, words):
    """doc -> smallest reachable doc over all pairs."""
    sets = {d: shingles(t, words) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:]}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check_classes(rows, texts, words):
    expected = brute_classes(texts, words)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_op5_whole_table(spark):
    check_classes(registered.op5(spark, SF).collect(), texts_of(), 4)


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.choice(len(w), edits, replace=False):
            w[at] = f"x{rng.integers(1 << 40)}"
        out.append(" ".join(w))
    return out


def test_op5_families_at_the_threshold_and_a_shared_passage(spark):
    """A large near-copy family, families just around 0.8, chains, and documents sharing half their words."""
    rng = np.random.default_rng(11)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 30, n)]
    texts = []
    for edits in (1, 2, 4, 5, 6, 8):
        texts += variants(rng, word(200), 25, edits)
    texts += variants(rng, word(150), 150, 2)
    passage = word(60)
    texts += [" ".join(word(15) + passage + word(15)) for _ in range(120)]
    chain = word(120)
    for _ in range(12):  # each near the one before, far from the first
        texts.append(" ".join(chain))
        chain = chain[5:] + word(5)
    texts += ["One two", "one TWO", "one two three", "", " \n", "É a b c d", "é a b c d", texts[0].upper()]
    order = rng.permutation(len(texts))
    docs = spark.createDataFrame([(int(i), t, "clash", "clash") for i, t in zip(order, texts)], "doc_id long, text string, component string, n_shingles string")
    check_classes(near_dup.classes(docs, 4).collect(), {int(i): t for i, t in zip(order, texts)}, 4)


def test_op5_awkward(spark):
    docs = documents(spark)
    rows = near_dup.classes(docs, 4).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[None][0].component_id is None and by[None][0].kept
    assert [r.component_id for r in by[6]] == [6, 6, 6]
    assert by[7][0].component_id == by[8][0].component_id == by[9][0].component_id == 7
    assert by[0][0].n_shingles == by[2][0].n_shingles == 0 and by[1][0].kept and by[4][0].n_shingles == 1
    assert near_dup.classes(documents(spark, empty=True), 4).count() == 0
    kept = near_dup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in (8, 9)) == sorted(str(r.doc_id) for r in kept.collect())


def test_signature_index_keeps_its_guarantee():
    """Any two signatures within REACH differences share a key, however the errors lie."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_dup.PLACES).astype(np.uint16)
        b = a.copy()
        at = rng.choice(near_dup.PLACES, near_dup.REACH, replace=False)
        b[at] ^= np.uint16(1)
        keys = near_dup.chunk_keys(np.array([a, b]))
        assert len(set(keys[0].tolist()) & set(keys[1].tolist()))


def test_op5_cells_stay_small_for_many_unlinked_members_of_a_bucket(spark, monkeypatch):
    """One bucket whose members are linked to nobody, beside a large component: no cell beyond two blocks, every pair in one cell."""
    block, outsiders, inner = 64, 700, 200
    monkeypatch.setattr(near_dup, "BLOCK", block)
    near_dup.prepare(spark)
    signature = np.arange(56, dtype=np.uint16).tobytes()
    ids = range(outsiders + inner)
    table = spark.createDataFrame([(i, 10, bytearray(signature)) for i in ids], "id long, n long, signature binary")
    labels = spark.createDataFrame([(i, outsiders) for i in range(outsiders, outsiders + inner)], "id long, component long")
    buckets = spark.createDataFrame([(5, i, 0) for i in ids], "key long, id long, leader long")
    known = spark.createDataFrame([], "a long, b long, inter long, total long")

    def members_of(cell):
        g1, g2 = cell.column("g1")[0].as_py(), cell.column("g2")[0].as_py()
        n = cell.num_rows
        return pa.table({"top": pa.array([g1] * n, pa.int64()), "t1": pa.array([g2] * n, pa.int64()), "t2": cell.column("block").cast(pa.int64()), "id": cell.column("id")})

    monkeypatch.setattr(near_dup, "_cross", members_of)
    rows = near_dup.verification_groups(buckets, table, labels, known).collect()
    cells = {}
    for r in rows:
        cells.setdefault((r.top, r.t1), {})[r.id] = r.t2
    assert max(map(len, cells.values())) <= 2 * block
    met = Counter()
    for (g1, g2), of in cells.items():
        for i, b in of.items():
            if b == g1:
                met.update(frozenset((i, j)) for j, c in of.items() if c == g2 and (g1 != g2 or i < j))
    wanted = {frozenset((i, j)) for i in range(outsiders) for j in ids if i != j}
    assert set(met) == wanted and set(met.values()) == {1}


def test_op5_verification_groups_stay_small_however_many_buckets_feed_them(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = np.random.default_rng(6)
    labels, members = [], []
    for i in range(80):  # two members of the large component and an outsider, alike in all places
        signature = rng.integers(0, 1 << 16, near_dup.PLACES).astype(np.uint16).tobytes()
        members += [(3 * i + k, 100, signature) for k in (1, 2, 3)]
        labels += [(3 * i + 1, 0), (3 * i + 2, 0)]
    near_dup.prepare(spark)
    table = spark.createDataFrame([(i, n, bytearray(x)) for i, n, x in members], "id long, n long, signature binary")
    keys = table.select("id", "signature").mapInArrow(near_dup._index, "key long, id long")
    buckets = keys.join(keys.groupBy("key").agg(F.min("id").alias("leader")), "key")
    known = spark.createDataFrame([], "a long, b long, inter long, total long")
    groups = defaultdict(set)
    for r in near_dup.verification_groups(buckets, table, spark.createDataFrame(labels, "id long, component long"), known).collect():
        groups[r.top, r.t1, r.t2].add(r.id)
    assert max(map(len, groups.values())) <= 4 * near_dup.BLOCK
    assert all(any({3 * i + k, 3 * i + 3} <= g for g in groups.values()) for i in range(80) for k in (1, 2))


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (20, 21), (5, 5), (3, 1), (3, 1)] + [(100, 100 + i) for i in range(1, 60)] + [(i, i + 1) for i in range(300, 340)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {1: 1, 2: 1, 3: 1, **{i: 6 for i in range(6, 11)}, 20: 20, 21: 20, **{100 + i: 100 for i in range(60)}, **{i: 300 for i in range(300, 341)}}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def blocks_brute(texts, min_words):
    """Lines to delete: every run of ``min_words`` words that a smaller doc_id holds as well."""
    held, out = {}, {}
    described = {}
    for d, t in sorted(texts.items()):
        lines = (t or "").split("\n")
        n = [len(x.split()) for x in lines]
        own = []
        for i in range(len(lines)):
            j, total = i, 0
            while j < len(lines) and total < min_words:
                total += n[j]
                j += 1
            if total >= min_words and n[i]:
                own.append((tuple(lines[i:j]), i, j))
                held.setdefault(tuple(lines[i:j]), d)
        described[d] = own
    for d, own in described.items():
        out[d] = {k for run, i, j in own if held[run] < d for k in range(i, j)}
    return out


def check_lines(rows, texts, min_words):
    """All of the shared runs go; besides them only lines without own words inside or beside aligned blocks."""
    expected = blocks_brute(texts, min_words)
    holders = defaultdict(set)
    for d, t in texts.items():
        for x in (t or "").split("\n"):
            holders[x].add(d)
    for doc, n_lines, gone in rows:
        lines = (texts[doc] or "").split("\n")
        assert n_lines == len(lines) and expected[doc] <= set(gone)
        for k in set(gone) - expected[doc]:
            assert min(holders[lines[k]]) < doc  # aligned with an earlier document's line


def test_op8_whole_table(spark):
    rows = [(r.doc_id, r.n_lines, [int(x) for x in r.removed.split(",") if x]) for r in registered.op8(spark, SF).collect()]
    assert len(rows) == len(texts_of())
    check_lines(rows, texts_of(), line_dedup.MIN_WORDS)


def test_op8_moved_repeated_and_hot_blocks(spark):
    rng = np.random.default_rng(4)
    line = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 1 << 30, n))
    p, q, short = line(55), "\n".join(line(12) for _ in range(5)), line(6)
    texts = {0: f"{line(20)}\n{p}\n{line(20)}\n{q}", 1: f"{q}\n{line(9)}\n{p}\n{line(9)}\n{p}", 2: f"{line(9)}\n{short}", 3: f"{short}\n{line(50)}",
             4: f"{p}", 5: "", 6: None, 7: "\n".join([line(40)] * 60), 8: line(33)}
    texts |= {20 + i: f"{line(10)}\n{p}\n{line(10)}" for i in range(120)}
    docs = spark.createDataFrame([(d, t, "clash", "x") for d, t in texts.items()], "doc_id long, text string, removed string, key_ string")
    rows = line_dedup.clean(docs).collect()
    assert {r.doc_id: r.text for r in rows if r.doc_id in (0, 2, 3, 5, 6, 7, 8)} == {d: texts[d] for d in (0, 2, 3, 5, 6, 7, 8)}
    check_lines([(r.doc_id, r.n_lines, r.removed) for r in rows], texts, line_dedup.MIN_WORDS)
    assert all(len(r.removed) == 1 and r.text.count("\n") == 1 for r in rows if r.doc_id >= 20)
    assert next(r for r in rows if r.doc_id == 1).removed == [0, 1, 2, 3, 4, 6, 8]


def test_op8_passages_inside_longer_lines(spark):
    rng = np.random.default_rng(8)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 30, n)]
    passages = [words(n) for n in (51, 52, 60, 82, 182)]
    texts, at = {}, {}
    for i, p in enumerate(passages):  # the first copy inside a line or as a line of its own, the later ones inside lines
        texts[i] = " ".join(words(200 * (i % 2)) + p + words(300 * (i % 2)))
        for d in (10 + i, 20 + i):
            before, after = words(100 + d), words(150)
            at[d] = (before, p, after)
            texts[d] = "\n".join([" ".join(words(8)), " ".join(before + p + after), " ".join(words(40))])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in line_dedup.clean(docs, span=line_dedup.SPAN).collect()}
    for d, r in rows.items():
        assert r.removed == [] and r.n_lines == texts[d].count("\n") + 1
        if d < 10:
            assert r.text == texts[d]
            continue
        before, p, after = at[d]
        head, long, tail = r.text.split("\n")
        assert [head, tail] == texts[d].split("\n")[::2]
        left = long.split(" ")
        kept = len(left) - len(before) - len(after)
        assert left[:len(before)] == before and left[-len(after):] == after and 0 <= kept <= 2 * line_dedup.SPAN - 1, (d, kept)


def test_op8_blocks_of_all_pairs(spark):
    """Also the short ends of blocks behind, or before, a run that an earlier document holds without them."""
    rng = np.random.default_rng(9)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, n)) for n in (35, 12, 8, 31, 9, 14, 5, 20)]
    own = lambda: " ".join(f"x{x}" for x in rng.integers(0, 1 << 30, 9))
    a, b = pool[:2]
    texts = {1: [own(), a, own()], 3: [own(), a, b, own()], 5: [own(), a, b, own()], 6: [own(), b, a], 7: [own(), b, a]}
    for d in range(10, 40):
        texts[d] = [x for k in rng.integers(0, 8, 4).tolist() for x in [own(), *pool[k:k + 3]]]
    expected = {d: set() for d in texts}
    for d, own_lines in texts.items():
        for e, others in ((e, x) for e, x in texts.items() if e < d):
            for i in range(len(own_lines)):
                for j in range(len(others)):
                    n = 0
                    while i + n < len(own_lines) and j + n < len(others) and own_lines[i + n] == others[j + n]:
                        n += 1
                    if sum(len(x.split()) for x in own_lines[i:i + n]) >= line_dedup.MIN_WORDS:
                        expected[d] |= set(range(i, i + n))
    docs = spark.createDataFrame([(d, "\n".join(x)) for d, x in texts.items()], "doc_id long, text string")
    for span in (None, line_dedup.SPAN):
        gone = {r.doc_id: set(r.removed) for r in line_dedup.clean(docs, span=span).collect()}
        assert gone[5] == {1, 2} and gone[7] == {1, 2}
        assert all(expected[d] <= gone[d] for d in texts)


def test_op8_alignment_decides(monkeypatch):
    """Runs propose, aligned blocks decide: also for moved and repeated blocks, and nothing goes without the alignment."""
    a, b = [1, 2, 3, 4, 5, 6, 7, 8], [5, 6, 7, 90, 1, 2, 3, 91, 5, 6, 7, 8, 92]
    words = [12] * len(b)

    def gone():
        array = lambda x: np.array(x, np.uint64)
        keys, places, _ = line_dedup.runs(array(a), np.full(len(a), 12))
        where = dict(zip(keys.tolist(), places.tolist()))
        own = zip(*(x.tolist() for x in line_dedup.runs(array(b), np.array(words))))
        return line_dedup.common_units(a, b, words, 30, lambda: [(i, j, where[k]) for k, i, j in own if k in where])

    assert gone() == [0, 1, 2, 4, 5, 6, 8, 9, 10, 11]
    assert line_dedup.common_units(a, b, words, 30) == [4, 5, 6, 8, 9, 10, 11]  # one increasing alignment
    monkeypatch.setattr(line_dedup, "align", lambda a, b: [])
    assert gone() == []


def test_op8_units_make_up_the_text():
    for raw in (b"", b"\n", b" a", b"a\n\n b  c \n", "\n".join([" ".join("the é x y".split() * 30)] * 2).encode()):
        starts, ends, words, line = line_dedup.cut(raw, line_dedup.SPAN)
        assert words.sum() == len(raw.split()) and line[-1] == raw.count(b"\n")
        assert line_dedup.without(raw, [], line_dedup.SPAN) == (raw, [])


def test_op8_texts_are_described_in_one_go(monkeypatch):
    texts = [None, "", "\n", "a", "é b\n", "", "\n\nx y", " z ", "\n".join([" ".join("the é x y".split() * 30)] * 2) + "\n", "b " * 50, "b " * 50, None]
    column = pa.array(["not in the slice", *texts], pa.string()).slice(1)
    calls, cut_texts = [], line_dedup.cut_texts
    for min_words, span in ((30, line_dedup.SPAN), (3, None), (4, 3)):
        own = [line_dedup.unit_codes((t or "").encode(), span) for t in texts]
        monkeypatch.setattr(line_dedup, "cut_texts", lambda *a: calls.append(a) or cut_texts(*a))
        codes, words, keys = line_dedup.described(text_column(column), min_words, span)
        monkeypatch.undo()
        assert [(np.frombuffer(c, np.uint64).tolist(), np.frombuffer(w, np.uint32).tolist()) for c, w in zip(codes, words)] == own
        assert keys.to_pylist() == [np.unique(line_dedup.runs(np.array(c, np.uint64), np.array(w), min_words)[0]).view(np.int64).tolist() for c, w in own]
    assert len(calls) == 3


def test_op8_unit_hashes_are_dealt_out_by_document_once(spark, capsys):
    line_dedup.common_blocks(documents(spark), span=line_dedup.SPAN).explain()
    plan = capsys.readouterr().out
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id#\w+, text_key#\w+", plan)) == 1  # of what was found


def test_op8_awkward(spark):
    docs = documents(spark)
    rows = line_dedup.clean(docs).collect()
    assert len(rows) == docs.count()
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r.text == ("" if r.doc_id == 8 else text[r.doc_id]), r.doc_id
    assert line_dedup.clean(documents(spark, empty=True)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_alignment_is_increasing_and_matches(a, b):
    pairs = line_dedup.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)
    if set(a) & set(b):
        assert pairs


def test_pipeline(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    before = docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        results[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    kept = {r.doc_id for r in results["quality_rules"].collect()}
    verdict = {r.doc_id: r for r in quality.verdicts(before, corpus_pipeline.table(spark, SF, "labels")).collect()}
    assert kept == {d for d, r in verdict.items() if r.kept}
    texts = {r.doc_id: r.text for r in results["quality_rules"].collect()}
    lined = {r.doc_id: r.text for r in results["line_dedup"].collect()}
    gone = blocks_brute(texts, line_dedup.MIN_WORDS)
    first = {}
    for d, t in sorted(texts.items()):
        for x in t.split("\n"):
            first.setdefault(x, d)
    for d, t in texts.items():
        left = [x for i, x in enumerate(t.split("\n")) if i not in gone[d]]
        assert gone[d] or lined[d] == t
        assert d in lined or all(first[x] < d for x in left)  # all of it aligned with earlier documents
        assert not gone[d] or len(lined.get(d, "")) <= len("\n".join(left))
    classes = brute_classes(lined, corpus_pipeline.NEAR_WORDS)
    single = {r.doc_id: r.text for r in results["near_dedup"].collect()}
    assert single == {d: t for d, t in lined.items() if classes[d][1] == d}
    clean = {r.doc_id: (r.text, r.n_chars) for r in results["personal_data"].collect()}
    assert clean == {d: (pii.masked(t), len(pii.masked(t))) for d, t in single.items()}
    sequences, total = check_packing(results["best_fit_packing"].collect(), {d: t for d, (t, _) in clean.items()}, 1024)
    assert sequences <= -(-total // 1024) + 1


def test_pipeline_stages_on_awkward_rows(spark):
    docs = documents(spark)
    for empty in (False, True):
        rows = docs.where("false") if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
            if name != "best_fit_packing":
                assert rows.columns == docs.columns
        assert (rows.count() == 0) == empty
