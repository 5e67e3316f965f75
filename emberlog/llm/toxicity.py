"""Operator 7, toxicity: maximum-scoring segments over token log-odds.

``learn`` counts tokens in the labelled training documents (equal texts once)
and gives each token the log-odds of toxic against other texts with a Dirichlet
prior: both counts get ``FLAT`` and the token's share of ``PRIOR`` tokens.  The
log-odds are then drawn towards zero by ``DOUBT`` standard errors, so a token
that few texts hold says little.  Tokens are lower-cased words without outer
marks, hashed to ``BUCKETS`` buckets; that bounds the model (two floats a
bucket), whatever the vocabulary.

A text is a sequence of token scores (log-odds less ``DRIFT``, which makes the
expected score negative).  All its maximal scoring segments are found in linear
time (Ruzzo and Tompa's scan, over runs of equal sign).  A segment's chance
follows the extreme-value law of such sums: with lambda, the root of
E[exp(lambda s)] = 1 over other texts' tokens, a segment of score S in a text
of n tokens has the evidence lambda S - ln n.  The document's evidence is the
log of the sum of exp(evidence) over its segments; its probability is a
logistic function of it, fitted on training documents that were left out of the
counts.

Training rows are given by a condition (of more than ``TRAINING_ROWS``, a sample
by a hash of doc_id) and split by a hash of the text; labels are never used
elsewhere.  Scores cover all texts.  Repeated labels count once if they agree.  Null and
empty texts have no segments and get the score of no evidence; rows repeated
exactly get one row each; without labels of both kinds all scores are the share
of toxic labels (0 without labels); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, steps, stored, text_column

BUCKETS = 1 << 20
PRIOR = 1000.0
FLAT = 1.0
DOUBT = 2.0
DRIFT = 0.7
CLIP = 6.0
SIGNIFICANT = 0.0
TOKENS_KEPT = 300_000
TRAINING_ROWS = 200_000
EVIDENCE_STEP = 0.1
EVIDENCE_MIN, EVIDENCE_MAX = -30.0, 60.0
_MARKS = b".,;:!?\"'()[]*#$%&|<>-"


def _bucket(token: bytes) -> int:
    return zlib.crc32(token.decode("utf-8", "replace").lower().encode().strip(_MARKS)) % BUCKETS


class Buckets(dict):
    """token -> bucket, with bounded memory."""

    def __missing__(self, token):
        if len(self) >= TOKENS_KEPT:
            self.clear()
        out = self[token] = _bucket(token)
        return out


_BUCKETS = Buckets()


def token_buckets(raw: bytes) -> np.ndarray:
    words = raw.split()
    return np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for step in steps(batch, "text"):
            held: tuple[list, list] = ([], [])
            for raw, toxic in zip(text_column(step.column("text")).cast(pa.large_binary()), step.column("toxic").to_pylist()):
                held[toxic].append(token_buckets(raw.as_py()))
            for toxic in (0, 1):
                if held[toxic]:
                    at, n = np.unique(np.concatenate(held[toxic]), return_counts=True)
                    sums[toxic][at] += n
    at = np.flatnonzero(sums.any(0))
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], names=["bucket", "other", "toxic"])


def token_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens by bucket in other and in toxic texts; at most ``BUCKETS`` rows reach the driver."""
    prepare(labelled.sparkSession)
    rows = labelled.select("text", "toxic").mapInArrow(_count, "bucket long, other long, toxic long")
    other, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for batch in rows.groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow().to_batches():
        at = batch.column("bucket").to_numpy()
        other[at], toxic[at] = batch.column("other").to_numpy(), batch.column("toxic").to_numpy()
    return other, toxic


def log_odds(other: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log-odds of each bucket under the Dirichlet prior, drawn towards zero by their standard error."""
    total = other + toxic
    prior = FLAT + PRIOR * total / max(total.sum(), 1.0)
    a, b = toxic + prior, other + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    doubt = DOUBT * np.sqrt(1 / a + 1 / b)
    return np.clip(np.sign(odds) * np.maximum(0, np.abs(odds) - doubt), -CLIP, CLIP)


def decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1 (the mean score is negative)."""
    weights = weights / weights.sum()
    if (weights * scores).sum() >= 0 or not (scores[weights > 0] > 0).any():
        return 1.0
    lo, hi = 0.0, 1.0
    while (weights * np.exp(hi * scores)).sum() < 1 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        if (weights * np.exp(mid * scores)).sum() < 1:
            lo = mid
        else:
            hi = mid
    return lo or 1.0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time."""
    positive = scores > 0
    if not positive.any():
        return []
    change = np.flatnonzero(np.diff(positive)) + 1
    starts = np.concatenate([[0], change])
    ends = np.append(change, len(scores)).tolist()
    sums = np.add.reduceat(scores, starts).tolist()
    # Each candidate: start, end, total before it, total after it, and the
    # nearest earlier candidate with a smaller total before it.
    stack: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for start, end, value in zip(starts.tolist(), ends, sums):
        before, total = total, total + value
        if value <= 0:
            continue
        left, right, low, high = start, end, before, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((left, right, low, high, j))
                break
            left, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, high - low) for a, b, low, high, _ in stack]


class Model:
    """Bucket scores, the decay lambda and the logistic calibration (slope, offset)."""

    def __init__(self, scores: np.ndarray, decay_: float, slope: float = 1.0, offset: float = 0.0):
        self.scores, self.decay, self.slope, self.offset = scores.astype(np.float32), decay_, slope, offset

    def passages(self, raw: bytes) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of tokens, and (start, end, evidence) of every segment, places in tokens."""
        at = token_buckets(raw)
        found = segments(self.scores[at].astype(np.float64)) if len(at) else []
        return len(at), [(a, b, self.decay * s - math.log(len(at))) for a, b, s in found]

    def evidence(self, raw: bytes) -> float:
        return self.total(self.passages(raw)[1])

    @staticmethod
    def total(found: list[tuple[int, int, float]]) -> float:
        """The evidence of all segments of a text."""
        if not found:
            return EVIDENCE_MIN
        top = max(e for _, _, e in found)
        return max(EVIDENCE_MIN, min(EVIDENCE_MAX, top + math.log(sum(math.exp(e - top) for _, _, e in found))))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.slope * evidence + self.offset))))


def _evidence(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = text_column(batch.column("text")).cast(pa.large_binary())
            yield pa.RecordBatch.from_arrays([pa.array([model.evidence(t.as_py()) for t in texts]), batch.column("toxic")], names=["evidence", "toxic"])
    return run


def logistic(x: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit to binned counts (Newton steps, slight ridge on the slope)."""
    a, b = 0.1, math.log((n1.sum() + 1) / (n0.sum() + 1))
    n = n0 + n1
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g = np.array([((n1 - n * p) * x).sum() - 1e-3 * a, (n1 - n * p).sum()])
        w = n * p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]])
        move = np.linalg.solve(h, g)
        size = np.abs(move).max()
        a, b = (a, b) + move * min(1.0, 2 / size if size else 1.0)
        if size < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> Model:
    """A model from the labelled documents for which ``training`` (on doc_id) holds.

    Three quarters of them give the counts, one quarter the calibration.
    """
    prepare(docs.sparkSession)
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & training).groupBy("doc_id")
             .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("t2")).where("toxic = t2").drop("t2")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS))
    marks = stored(marks, "toxic-labels")
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    # At most TRAINING_ROWS short rows are broadcast, so no text is shuffled.
    # Equal texts with one label count once, and all in one fold.
    known = (texts.join(F.broadcast(marks), "doc_id")
             .groupBy(F.xxhash64("text").alias("hash"), F.length("text").alias("size"), "toxic").agg(F.min("doc_id").alias("doc_id")))
    known = stored(known.select("doc_id", "toxic", F.pmod("hash", F.lit(4)).alias("fold")), "toxic-texts")
    chosen = lambda rows: texts.join(F.broadcast(rows.select("doc_id", "toxic")), "doc_id")
    other, toxic = token_counts(chosen(known.where("fold <> 0")))
    if not other.sum() or not toxic.sum():
        share = known.agg(F.avg("toxic")).first()[0] or 0.0
        return Model(np.full(BUCKETS, -1.0), 1.0, 0.0, math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    scores = log_odds(other, toxic) - DRIFT
    model = Model(scores, decay(scores, other + FLAT * (other + toxic > 0)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held = chosen(known.where("fold = 0")).select("text", "toxic").mapInArrow(_evidence(shared), "evidence double, toxic int")
    bins = held.groupBy(F.round(F.col("evidence") / EVIDENCE_STEP).alias("bin")).agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0")).collect()
    if not sum(r["n1"] for r in bins) or not sum(r["n0"] for r in bins):
        return model
    x, n1, n0 = (np.array([float(r[c]) for r in bins]) for c in ("bin", "n1", "n0"))
    model.slope, model.offset = logistic(x * EVIDENCE_STEP, n0, n1)
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for step in steps(batch, "text"):
                values, spans = [], []
                for raw in text_column(step.column("text")).cast(pa.large_binary()):
                    raw = raw.as_py()
                    _, found = model.passages(raw)
                    values.append(model.probability(model.total(found)))
                    spans.append([{"start": a, "end": b, "evidence": e} for a, b, e in found if e > SIGNIFICANT])
                yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(values, pa.float64()), pa.array(spans, _PASSAGES)], names=["doc_id", "score", "passages"])
    return run


_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, and the significant passages (token places) of every document."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_score(shared), "doc_id long, score double, passages array<struct<start: int, end: int, evidence: double>>")
