"""String helpers as Column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ``trim`` in Spark removes spaces only; the parsers strip all ASCII
# whitespace (space, tab, LF, VT, FF, CR) -- a character-set trim, no regex.
WHITESPACE = " \t\n\x0b\x0c\r"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace (space, tab, CR, LF, FF, VT).

    ``btrim`` walks the whole text, so one with nothing to remove (it begins
    with ``!`` or above and ends in no whitespace) is left as it is.
    """
    c = col_(c)
    touched = c < "!"
    for blank in WHITESPACE:
        touched |= c.endswith(blank)
    return F.when(touched, F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def trim_quotes(c) -> Column:
    """Remove leading and trailing runs of double quotes (most texts have none and are left as they are)."""
    c = col_(c)
    return F.when(c.startswith('"') | c.endswith('"'), F.btrim(c, F.lit('"'))).otherwise(c)


def clean_field(c) -> Column:
    """Strip whitespace, then the quote runs at both ends."""
    return trim_quotes(strip_ws(c))


def int_prefix(c, default: int = 0, type_name: str = "int") -> Column:
    """Leading optionally-signed digits as an integer, commas dropped, else default.

    Mirrors the "parse what you can from the left" integer conversion of the
    batch parser: ``' 12abc'`` -> 12, ``'1,234'`` -> 1234, ``'443.0'`` -> 443,
    ``'x'`` -> default; a number too large for the type is the default.  A
    clean integer takes the plain cast and never meets the regex.
    """
    digits = F.regexp_extract(F.replace(col_(c), F.lit(","), F.lit("")), r"^\s*([+-]?\d+)", 1)
    return F.coalesce(try_whole(c, type_name), _try_cast(F.nullif(digits, F.lit("")), type_name), F.lit(default).cast(type_name))


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def try_whole(c, type_name: str) -> Column:
    """``try_cast`` to a whole number; a text that holds a letter, comma or point is none and throws nothing on the way."""
    c = col_(c)
    return F.when((c != "") & ~c.rlike("[A-Za-z,.]"), _try_cast(c, type_name))


def to_int(c, default: int | None = 0, type_name: str = "int") -> Column:
    """Whole-string integer conversion with a default on failure."""
    v = try_whole(strip_ws(c), type_name)
    return v if default is None else F.coalesce(v, F.lit(default).cast(type_name))


def to_float(c, default: float | None = 0.0) -> Column:
    v = _try_cast(strip_ws(c), "float")
    return v if default is None else F.coalesce(v, F.lit(default).cast("float"))


def is_blank(c) -> Column:
    """Null, empty or whitespace-only (a text that begins with ``!`` or above is not, and is not trimmed)."""
    c = col_(c)
    return c.isNull() | ((c < "!") & (strip_ws(c) == ""))


def default_if_blank(c, default: str = "") -> Column:
    """Null, blank, or an unresolved ``%{...}`` placeholder -> default."""
    c = col_(c)
    return F.when(is_blank(c) | c.startswith("%{"), F.lit(default)).otherwise(c)


# ---------------------------------------------------------------------------
# key=value extraction
# ---------------------------------------------------------------------------
# Tokens are separated by single spaces and split at the first '='.  All keys
# and all values of a text are taken out in one regex pass each, and a key's
# value is looked up by its place in the list of keys: the cost of a text does
# not rise with the number of keys asked for.  The FIRST occurrence wins, and a
# repeated key never throws (unlike ``str_to_map``).


def kv_text(text) -> Column:
    """Search text for ``kv_names`` and ``kv_values``: a leading space added, null -> ''."""
    return F.concat(F.lit(" "), F.coalesce(col_(text), F.lit("")))


def kv_names(padded) -> Column:
    """The keys of the `` key=value`` tokens, in order."""
    return F.regexp_extract_all(col_(padded), F.lit(" ([^ =]*+)="), F.lit(1))


def kv_values(padded) -> Column:
    """Their values, which run to the next space."""
    return F.regexp_extract_all(col_(padded), F.lit(" [^ =]*+=([^ ]*+)"), F.lit(1))


def kv_value(names, values, key: str) -> Column:
    """Value of the first token named ``key`` (null if there is none)."""
    return F.get(col_(values), F.array_position(col_(names), key).cast("int") - 1)


def with_kv(df, text_col: str, keys, prefix: str = "_v_"):
    """Add one column ``<prefix><key>`` per key (raw value or null).

    Names and values are materialised first, so each pass runs once per row.
    """
    pad, names, values = f"{prefix}_text", f"{prefix}_names", f"{prefix}_values"
    df = df.withColumn(pad, kv_text(text_col))
    df = df.select(*[c for c in df.columns if c != pad], kv_names(pad).alias(names), kv_values(pad).alias(values))
    return df.select(*[c for c in df.columns if c not in (names, values)], *[kv_value(names, values, k).alias(f"{prefix}{k}") for k in keys])
