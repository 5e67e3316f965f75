"""Operators 4, 6 and 7 against plain forms of their rules."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberlog.llm import pii, quality, registered, toxicity
from helpers import SF, documents, rows_of, texts_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    """The base kinds by the patterns as they are stated."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and plain_luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


pieces = st.sampled_from(["a", "b.c", "@", ".", "-", "+", "%", "_", "1", "25", "255", "256", ".1", " ", "(", ")", "4111 1111 1111 1111",
                          "5500-0000-0000-0004", "+49 30 1234567", "x@y.z", "é", "\n", "00", "10.0.0.1"])


@settings(max_examples=800, deadline=None)
@given(st.lists(pieces, max_size=30).map("".join))
def test_base_spans_are_the_patterns(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE] == base(text)


def test_validators_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00.") == ["bank_account"]
    assert kinds("SSN 123-45-6789") == ["national_id"] and kinds("part 123-45-6789") == kinds("123-45-6789") == []
    assert kinds("amex card 378282246310005") == ["short_card"] and kinds("order 378282246310005") == []
    card = "4111 1111 1111 1111"
    assert pii.find_spans(f"credit card {card}")[0][3] > pii.find_spans(card)[0][3] > pii.find_spans(f"order {card}")[0][3]
    assert pii.masked("to a.b@c.de or +49 30 1234567!") == "to [EMAIL] or [PHONE]!"


def test_scans_are_linear():
    for text in ("1" * 400_000, "a" * 400_000, "a" * 200_000 + "@", "1." * 200_000, "+1" * 100_000, "+1" + " " * 300_000, "9 " * 200_000):
        pii.find_spans(text)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected_row(doc, text):
    spans = base(text or "")
    n = Counter(k for k, _, _ in spans)
    return (doc, *(n[k] for k in pii.BASE), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))


def test_op4_tables(spark):
    rows = registered.op4(spark, SF).collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(expected_row(d, t) for d, t in texts_of().items())
    docs = documents(spark)
    got = pii.digests(pii.find(docs)).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(expected_row(r.doc_id, r.text) for r in docs.collect())
    assert pii.find(documents(spark, empty=True)).count() == 0
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert masked.where("text is null").count() == docs.where("text is null").count()


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", " ", " ", "\n", "\t", "c c c c c c c c c ", "| x", "\x85", "\x1c"]), max_size=60).map("".join))
def test_counts_are_the_stated_ones(text):
    assert quality.text_stats(text.encode(), len(text))[:5] == plain_counts(text)


def test_op6_tables(spark):
    rows = registered.op6(spark, SF).collect()
    failed = lambda c: c[0] < 20 or 100 * c[4] > 30 * c[0]
    for r in rows:
        counts = plain_counts(texts_of_cache[r.doc_id])
        assert tuple(r)[1:6] == counts and r.base_failed == failed(counts) and not (r.base_failed and r.kept)
    assert len(rows) == len(texts_of_cache)
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 0), (None, 1, 0), (6, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.verdicts(docs, labels).count() == docs.count()
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and quality.verdicts(docs, labels).where("kept").count() == kept.count()
    assert quality.keep(documents(spark, empty=True), labels.where("false")).count() == 0


texts_of_cache = texts_of()


def test_exact_binomial_bound():
    def tail(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n in ((0, 50), (3, 200), (10, 80)):
        p = quality.upper_bound(k, n, 0.01)
        assert abs(tail(k, n, p) - 0.01) < 1e-6
    assert quality.upper_bound(0, 100, 0.05) == 1 - 0.05 ** (1 / 100) or abs(quality.upper_bound(0, 100, 0.05) - (1 - 0.05 ** 0.01)) < 1e-9


def test_cutoffs_keep_the_risk():
    good = [5000] + [0] * 100 + [3] * 5 + [0] * 95
    bad = [0] * 150 + [10] * 51
    level = quality.choose(good, bad, 0.01, 0.001)
    assert level and sum(good[level:]) == 0 and sum(bad[level:]) == sum(bad)
    assert quality.choose([20] + [0] * 200, bad, 0.01, 0.001) is None  # too few labels to certify anything
    assert quality.choose(good, [7] + [0] * 200, 0.01, 0.001) is None  # nothing to gain


def test_op6_learns_and_spares_good_documents(spark):
    """Symbol-laden documents are rejected by a learned cutoff, good ones are not."""
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(500)]
    text = lambda bad: " ".join(w + ("#*" if bad else "") for w in rng.choice(words, 60))
    rows = [(i, text(i % 5 == 0), "en", "s", 1) for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(2200)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.keep(docs, labels).collect()}
    assert kept == {i for i in range(2500) if i % 5}


def plain_segments(scores):
    """All maximal segments by their definition: best one first, then left and right of it."""
    if not len(scores):
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max(((sums[j] - sums[i], -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    return plain_segments(scores[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in plain_segments(scores[j:])] if True else []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-4, 4).map(lambda x: x + 0.0 if x else -0.5), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    got = toxicity.segments(np.array(scores))
    plain = plain_segments(np.array(scores))
    assert [s for _, _, s in got] == [s for _, _, s in plain]
    assert sum(s for _, _, s in got) == sum(s for _, _, s in plain)


def test_decay_is_the_root():
    scores, weights = np.array([-1.0, 2.0]), np.array([0.8, 0.2])
    lam = toxicity.decay(scores, weights)
    assert abs((weights * np.exp(lam * scores)).sum() - 1) < 1e-9


def toxic_corpus(spark, n=1500):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(800)]
    rows = []
    for i in range(n):
        w = list(rng.choice(words, 40))
        if i % 6 == 0:
            w[5:8] = ["Vile!", "nasty", "vile"]
        rows.append((i, " ".join(w), i % 6 == 0))
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows], "doc_id long, toxic int")
    return rows, docs, labels


def test_op7_held_out_accuracy_and_passages(spark):
    rows, docs, labels = toxic_corpus(spark)
    model = toxicity.learn(docs, labels, F.col("doc_id") < 1100)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(got[i].score >= 0.5) == x for i, _, x in rows if i >= 1100]
    assert np.mean(held) > 0.97
    assert any(p.start <= 5 and p.end >= 8 for i, _, x in rows if x and i >= 1100 for p in got[i].passages)


def test_op7_passages_of_documents_below_the_cut(spark):
    scores = np.full(toxicity.BUCKETS, -1.0)
    scores[toxicity._bucket(b"vile")] = 9.0
    docs = spark.createDataFrame([(1, "a b c Vile! vile d e"), (2, "a b c"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.Model(scores, 1.0, 1.0, -20.0)).collect()}
    assert got[1].score < 0.5 and [(p.start, p.end) for p in got[1].passages] == [(3, 5)]
    assert got[2].passages == [] == got[3].passages


def test_op7_awkward(spark):
    docs = documents(spark)
    _, more, labels = toxic_corpus(spark, 300)
    model = toxicity.learn(more, labels, F.lit(True))
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = labels.where("false")
    assert all(r.score < 0.5 for r in toxicity.score(docs, toxicity.learn(docs, empty, F.lit(True))).collect())
    assert toxicity.score(documents(spark, empty=True), model).count() == 0


def test_op7_whole_table(spark):
    rows = registered.op7(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts_of_cache)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
