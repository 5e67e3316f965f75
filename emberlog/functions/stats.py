"""Aggregate helpers.

``exact_avg`` adds integers, so the result does not depend on how rows are
split across tasks or in which order partial sums merge.  A floating-point
``avg`` can change in its last bits between two runs on a cluster (different
partitioning, speculative tasks); reports that are recomputed idempotently
should not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# A value is split into units of 2^-20 and, of what is left, units of 2^-63;
# both are exact for every 32-bit float whose last bit is 2^-63 or more.
HIGH, LOW = 1 << 20, 1 << 43
EXACT_LIMIT = 1e12


def exact_avg(c) -> Column:
    """Average over non-null values of any numeric column, nothing rounded before the division.

    Values of 10^12 and more, and non-finite ones, are added as doubles.
    """
    x = col_(c).cast("double")
    plain = F.abs(x) < EXACT_LIMIT
    scaled = F.when(plain, x * HIGH)
    high = F.floor(scaled)
    low = ((scaled - high.cast("double")) * LOW).cast("long")
    total = F.coalesce(F.sum(high.cast("decimal(38,0)")).cast("double"), F.lit(0.0)) / F.lit(float(HIGH)) \
        + F.coalesce(F.sum(low.cast("decimal(38,0)")).cast("double"), F.lit(0.0)) / F.lit(float(HIGH * LOW))
    rest = F.coalesce(F.sum(F.when(~plain, x)), F.lit(0.0))
    return F.when(F.count(x) > 0, (total + rest) / F.count(x))


def exact_avg_long(c) -> Column:
    """Average of an integer column from its exact sum."""
    x = col_(c).cast("decimal(38,0)")
    return (F.sum(x).cast("double") / F.count(x)).cast("double")


def round_half_even(c, digits: int) -> Column:
    """A double rounded half to even at ``digits`` decimals, as a report shows it."""
    return F.rint(col_(c) * F.lit(10.0 ** digits)) / F.lit(10.0 ** digits)


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (nulls count as false)."""
    return F.count(F.when(cond, F.lit(1)))


def sorted_set(c) -> Column:
    """Distinct values as a sorted array (deterministic ``collect_set``)."""
    return F.sort_array(F.collect_set(col_(c)))
