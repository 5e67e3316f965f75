"""Timestamp parsing: ordered format lists, ANSI-safe (``try_to_timestamp``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# Formats the silver stage accepts for ``ts``, in order.
SILVER_TS_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
]
# ... and for ``eventtime`` when ``ts`` fails.
SILVER_EVENTTIME_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"]

# Best-effort times of the serving loads.  A text is first turned into its shape
# (every digit 9, every letter a); a shape has one format, so a text is parsed
# once.  Fixed values: shape (a pattern where it has a quantifier or a class) and
# format, the frequent ones first.
SHAPES = [
    ("9999-99-99 99:99:99", "yyyy-MM-dd HH:mm:ss"),
    ("9999-99-99a99:99:99", "yyyy-MM-dd'T'HH:mm:ss"),
    ("9999-99-99a99:99:99[.]9{1,9}a", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSSXXX"),
    ("9999-99-99a99:99:99a", "yyyy-MM-dd'T'HH:mm:ssXXX"),
    ("9999-99-99 99:99:99[.]9{1,9}", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"),
    ("9999-99-99a99:99:99[.]9{1,9}", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS"),
    ("9999-99-99a99:99:99[.]9{1,9}[+-]99:99", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSSXXX"),
    ("9999-99-99a99:99:99[+-]99:99", "yyyy-MM-dd'T'HH:mm:ssXXX"),
    ("9999-99-99a99:99:99[+-]9999", "yyyy-MM-dd'T'HH:mm:ssXX"),
    ("9999-99-99a99:99:99[.]9{1,9}[+-]9999", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSSXX"),
    ("9999-99-99 99:99:99[+-]99:99", "yyyy-MM-dd HH:mm:ssXXX"),
    ("9999-99-99 99:99:99 ?[+-]9999", "yyyy-MM-dd HH:mm:ss[ ]XX"),
    ("9999-99-99 99:99", "yyyy-MM-dd HH:mm"),
    ("9999-99-99a99:99", "yyyy-MM-dd'T'HH:mm"),
    ("9999-99-99", "yyyy-MM-dd"),
    ("99/99/9999 99:99:99", "dd/MM/yyyy HH:mm:ss"),
    ("99/99/9999 99:99", "dd/MM/yyyy HH:mm"),
    ("99/99/9999", "dd/MM/yyyy"),
    ("99/99/99 99:99:99", "dd/MM/yy HH:mm:ss"),
    ("9999/99/99 99:99:99", "yyyy/MM/dd HH:mm:ss"),
    ("99-99-9999 99:99:99", "dd-MM-yyyy HH:mm:ss"),
    ("99.99.9999 99:99:99", "dd.MM.yyyy HH:mm:ss"),
    ("9?9 aaa 9999 99:99:99", "d MMM yyyy HH:mm:ss"),
    ("9?9 aaa 9999 99:99:99 [+-]9999", "d MMM yyyy HH:mm:ss XX"),
    ("aaa 9?9 9999 99:99:99", "MMM d yyyy HH:mm:ss"),
    ("99/aaa/9999:99:99:99 [+-]9999", "dd/MMM/yyyy:HH:mm:ss XX"),
    ("99999999999999", "yyyyMMddHHmmss"),
    ("99999999a999999a", "yyyyMMdd'T'HHmmssXXX"),
    ("99999999", "yyyyMMdd"),
]
# Digits of an epoch and its unit.
EPOCHS = {"9{9,10}": "timestamp_seconds", "9{13}": "timestamp_millis", "9{16}": "timestamp_micros"}
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fallback_ts(fallback=None) -> Column:
    """``fallback`` (Column, str literal or None) -> Column; None = now."""
    if fallback is None:
        return F.current_timestamp()
    if isinstance(fallback, Column):
        return fallback
    return F.lit(fallback).cast("timestamp")


def now() -> Column:
    """``current_timestamp`` as a value that is handed to generated code, not written into it.

    A stream puts its time into each micro-batch's plan; as a number in the code it
    would have every micro-batch compiled anew.  A higher-order function is evaluated as it is.
    """
    return F.get(F.transform(F.array(F.current_timestamp()), lambda t: t), F.lit(0))


def parse_first(c, formats) -> list[Column]:
    """One ``try_to_timestamp`` per format (null on failure, never throws)."""
    c = col_(c)
    return [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]


def shape(c: Column) -> Column:
    """A text with 9 for every digit and a for every ASCII letter."""
    return F.translate(c, "0123456789" + _LETTERS, "9" * 10 + "a" * len(_LETTERS))


def best_effort(c, second_precision: bool = True) -> Column:
    """The time that a text states in one of the known shapes, else null.

    A weekday before the rest (``Mon, ``) is skipped, epochs are seconds, milli-
    or microseconds by their digits.  Serving tables store second precision, so
    the result is truncated.
    """
    c = F.regexp_replace(F.trim(col_(c)), "^[A-Za-z]{3}, ", "")
    kind, out = shape(c), None
    for pattern, fmt in SHAPES:
        exact = not set(pattern) & set("[]{}?")
        hit = kind == pattern if exact else kind.rlike(f"^{pattern}$")
        parsed = F.try_to_timestamp(c, F.lit(fmt))
        out = F.when(hit, parsed) if out is None else out.when(hit, parsed)
    for digits, unit in EPOCHS.items():
        out = out.when(kind.rlike(f"^{digits}$"), getattr(F, unit)(c.try_cast("long")))
    return F.date_trunc("second", out) if second_precision else out


def best_effort_ts(c, fallback=None, second_precision: bool = True) -> Column:
    """``best_effort``, else ``fallback``."""
    return F.coalesce(best_effort(c, second_precision), now() if fallback is None else fallback_ts(fallback))
