"""Operator 6, quality rules with risk-controlled thresholds.

Each whole text gets counts and shares.  Base rules reject on their own.  For
every further rule a cutoff is chosen in each stratum (language) from the
labelled documents, which no rule was fitted on: among cutoffs taken from the
most lenient to stricter ones, those whose exact (Clopper-Pearson) upper bound
on the share of good documents rejected stays within the rule's part of
``RISK`` are certified, and testing stops at the first that is not, so the
order of tests costs no error.  The level of each bound is ``ERROR`` divided by
the number of rules and strata (Bonferroni), and the rules' risks add up to
``RISK``: with probability 1 - ``ERROR`` no stratum loses more than that share
of good documents.  Of the certified cutoffs the one with the best gain counts:
bad documents caught, less ``CARE`` times good ones lost; a rule without gain,
or without enough labels to certify anything, rejects nothing.

The driver sees only counts per stratum, rule and level (at most ``LEVELS`` + 1
levels).  A null text has no words; a null language is a stratum of its own;
rows repeated exactly get one row each; repeated labels of a document count
once if they agree, and not at all if they differ; without labels only the base
rules reject; an empty table gives no rows; ``keep`` keeps all columns.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, steps, stored, text_column

RISK, ERROR, CARE = 0.05, 0.05, 20.0
LEVELS = 200
RULES = ("symbol_share", "upper_share", "dup_line_share", "repeat_share", "adjacent_share", "mark_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Fixed values of the base rules.
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_MARKS = b"!?="
_MIX = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)]


def repeated_words(words: list[bytes], codes: np.ndarray) -> int:
    """Words inside 8-word windows that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    sums = np.zeros(n, np.uint64)
    for k, factor in enumerate(_MIX):
        sums += codes[k:k + n] * np.uint64(factor)
    ordered = np.sort(sums)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(sums, twice)).tolist()
    windows = [tuple(words[i:i + WINDOW]) for i in at]
    seen = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int64)
    hits = [i for i, w in zip(at, windows) if seen[w] > 1]
    np.add.at(edge, hits, 1)
    np.add.at(edge, [i + WINDOW for i in hits], -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(raw: bytes, points: int) -> tuple:
    """The counts, then the rules' shares, of a text with ``points`` code points."""
    words = raw.split()
    n = len(words)
    codes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    chars = points - (len(raw) - len(raw.translate(None, _SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words, codes)
    share = lambda a, b: a / b if b else 0.0
    return (n, chars, symbols, dup_lines, repeats,
            share(symbols, chars), share(len(raw) - len(raw.translate(None, _UPPER)), chars),
            share(dup_lines, len(lines)), share(repeats, n),
            share(int((codes[1:] == codes[:-1]).sum()), n),
            share(len(raw) - len(raw.translate(None, _MARKS)), chars))


def _stat_columns(step: pa.RecordBatch) -> list[pa.Array]:
    texts = text_column(step.column("text"))
    points = pc.utf8_length(texts).to_pylist()
    rows = [text_stats(raw, p) for raw, p in zip(texts.cast(pa.large_binary()).to_pylist(), points)]
    columns = list(zip(*rows))
    return [pa.array(c, pa.int64()) for c in columns[:len(COUNTS)]] + [pa.array(c, pa.float64()) for c in columns[len(COUNTS):]]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "text"):
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), step.column("stratum"), *_stat_columns(step)], names=["doc_id", "stratum", *COUNTS, *RULES])


def stats(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, the counts and the shares of every whole text, stored."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(cast(lang as string), '') stratum", "cast(text as string) text")
    schema = "doc_id long, stratum string, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{r} double" for r in RULES])
    return stored(rows.mapInArrow(_stats, schema), "quality-stats")


def base_failed():
    """The base rules on the counts."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def upper_bound(lost: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest share p for which ``lost`` or fewer of n have probability ``error``."""
    if lost >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) for k in range(lost + 1)]
    lo, hi = lost / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        if sum(math.exp(c + k * math.log(p) + (n - k) * math.log1p(-p)) for k, c in enumerate(logs)) > error:
            lo = p
        else:
            hi = p
    return hi


def choose(good: list[int], bad: list[int], risk: float, error: float) -> int | None:
    """The lowest rejected level, from counts of good and bad documents by level; None: reject nothing.

    Level ``k`` rejects documents at level k and above; tests go from the top level down.
    """
    n_good, n_bad = sum(good), sum(bad)
    best, chosen, lost, caught = 0.0, None, 0, 0
    for level in range(len(good) - 1, 0, -1):
        lost, caught = lost + good[level], caught + bad[level]
        if not n_good or lost > risk * n_good or upper_bound(lost, n_good, error) > risk:
            break
        gain = caught / max(n_bad, 1) - CARE * lost / n_good
        if gain > best:
            best, chosen = gain, level
    return chosen


def level(rule: str):
    """A share as a level from 0 to ``LEVELS``; only 0 itself is level 0."""
    return F.least(F.ceil(F.col(rule) * LEVELS), F.lit(LEVELS)).cast("int")


def fit(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[tuple[str, str], int]:
    """(stratum, rule) -> lowest rejected level, from all labelled documents that pass the base rules."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("q2")).where("quality = q2").drop("q2"))
    known = measured.where(~base_failed()).join(marks, "doc_id")
    each = known.select("stratum", "quality", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), level(r).alias("level")) for r in RULES))).alias("x"))
    counts = each.groupBy("stratum", "x.rule", "x.level").agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect()
    tables: dict = {}
    for row in counts:
        good, bad = tables.setdefault((row["stratum"], row["rule"]), ([0] * (LEVELS + 1), [0] * (LEVELS + 1)))
        good[row["level"]], bad[row["level"]] = row["good"], row["bad"]
    chosen = {k: choose(*t, risk / len(RULES), error / len(tables)) for k, t in tables.items()}
    return {k: v for k, v in chosen.items() if v is not None}


def rejected(cutoffs: dict[tuple[str, str], int]):
    """The chosen cutoffs as a condition."""
    out = F.lit(False)
    for (stratum, rule), lowest in sorted(cutoffs.items()):
        out = out | (F.col("stratum").eqNullSafe(stratum) & (level(rule) >= lowest))
    return out


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the shares of every document."""
    measured = stats(docs)
    cutoffs = fit(measured, labels)
    return (measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected(cutoffs))
            .select("doc_id", *COUNTS, "base_failed", "kept", "stratum", *RULES))


def _keeper(cutoffs: dict[tuple[str, str], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                columns = dict(zip((*COUNTS, *RULES), _stat_columns(step)))
                strata = np.array([s or "" for s in step.column("lang").cast(pa.string()).to_pylist()], object)
                n, repeats = (columns[c].to_numpy() for c in ("n_words", "n_repeat_words"))
                out = (n < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n)
                for (stratum, rule), lowest in cutoffs.items():
                    levels = np.minimum(np.ceil(columns[rule].to_numpy() * LEVELS), LEVELS)
                    out |= (strata == stratum) & (levels >= lowest)
                yield step.filter(pa.array(~out))
    return run


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, all columns kept; texts are measured again rather than shuffled."""
    cutoffs = fit(stats(docs), labels)
    return docs.mapInArrow(_keeper(cutoffs), docs.schema)
