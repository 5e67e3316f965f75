"""Operator 4, personal data: patterns propose, checks confirm, context decides.

Regular expressions propose spans in whole texts.  Validators confirm them:
address parts, digit counts, the Luhn sum of card numbers, the mod-97 sum of
bank account numbers.  Each span has a score: the kind's own weight, raised by
words nearby that speak for it and lowered by words that speak against it.

Spans of the base kinds (email, ip, card, phone) stay whatever their score.
The method adds spans of further kinds (bank account, national id, short card)
that are confirmed, reach ``THRESHOLD`` and overlap no base span.

All scans take time in proportion to the text.  Places are code points, end
exclusive.  A null or empty text has no spans; rows repeated exactly and null
doc_ids stay, one result row for each; an empty table gives no rows; other
columns are ignored by ``find`` and kept by ``mask``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, steps

BASE = ("email", "ip", "card", "phone")
ADDED = ("bank_account", "national_id", "short_card")
KINDS = BASE + ADDED
THRESHOLD = 0.6
NEAR = 48

# The base patterns' character classes (see the module text of the query).
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# weight without context, words that speak for the kind, words that speak against it
CONTEXT = {
    "email": (0.9, ("mail", "contact", "kontakt", "correo"), ("example",)),
    "ip": (0.6, ("ip", "address", "host", "server", "login"), ("version", "section", "release")),
    "card": (0.8, ("card", "visa", "credit", "karte", "carte", "tarjeta"), ("order", "isbn", "tracking")),
    "phone": (0.7, ("phone", "call", "tel", "mobile", "fax"), ("order", "isbn")),
    "bank_account": (0.7, ("iban", "bank", "account", "konto", "compte", "cuenta"), ("sample",)),
    "national_id": (0.4, ("ssn", "social security", "national id", "tax id"), ("order", "part", "isbn")),
    "short_card": (0.4, ("card", "amex", "credit", "karte", "carte", "tarjeta"), ("order", "isbn", "tracking")),
}
FOR, AGAINST = 0.3, 0.2


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check sum of international bank account numbers."""
    moved = account[4:] + account[:4]
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m[0].split(".")):
            yield m.span()


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of all confirmed spans; base kinds by the base rules."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b
    for a, b in addresses(text):
        yield "ip", a, b
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= 13:
            digits = digits_of(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card" if len(digits) >= 16 else "short_card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                yield "phone", *m.span()
    for m in _ACCOUNT.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "bank_account", *m.span()
    for m in _NATIONAL.finditer(text):
        yield "national_id", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's weight, moved by the words nearby, between 0 and 1."""
    weight, good, bad = CONTEXT[kind]
    around = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()
    weight += FOR * any(w in around for w in good) - AGAINST * any(w in around for w in bad)
    return round(min(1.0, max(0.0, weight)), 3)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by kind in the order of ``KINDS``, then start."""
    found = list(proposals(text))
    if not found:
        return []
    base = sorted((a, b) for kind, a, b in found if kind in BASE)
    out = []
    for kind, a, b in found:
        value = score(text, kind, a, b)
        if kind in BASE or value >= THRESHOLD and not any(x < b and a < y for x, y in base):
            out.append((kind, a, b, value))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
_SPANS_SQL = "array<struct<kind: string, start: int, end: int, score: double>>"


def _texts(step: pa.RecordBatch) -> list[str]:
    return [t or "" for t in step.column("text").to_pylist()]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "text"):
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t)] for t in _texts(step)]
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(spans, _SPANS)], names=["doc_id", "spans"])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, spans of every whole text."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_find, f"doc_id long, spans {_SPANS_SQL}")


def masked(text: str) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first counts."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, kind) for kind, a, b, _ in find_spans(text)):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, "text"):
            at = step.schema.get_field_index("text")
            texts = [None if t is None else masked(t) for t in step.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, step.schema.field(at).type) if i == at else c for i, c in enumerate(step.columns)], schema=step.schema)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced by their kinds, all columns kept."""
    prepare(docs.sparkSession)
    return docs.mapInArrow(_mask, docs.schema)


def digests(spans: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))
