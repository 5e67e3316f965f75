"""Reports as mergeable states.

A report groups rows by its keys.  ``partial`` gives, per key, states that add
up: counts, sums, maxima, the integer limbs of exact averages, and the values
met of each counted column.  ``merge`` puts states of several partials together
(days, shards), ``finish`` turns them into the report's columns.  A report of
rows is ``finish(partial(rows))``; one that is kept up by day stores partials
and reads no row again.

Distinct values are exact and mergeable: an IPv4 address is a number, 64
neighbours share one row with a 64-bit word (``bit_or``), so a dense network
takes a bit for each address and a lone address one row; any other text is a row
of its own.  Several counted columns are stacked, one row for each, before the
partial aggregation; nothing is expanded by grouping sets, and what crosses the
network is one row for each task, key and word.

Averages are exact as in ``functions.stats``: values in units of 2^-20 and
2^-63 are cut into limbs of at most 22 bits, so plain 64-bit sums hold for
2^41 rows of a key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIGH, LOW = 1 << 20, 1 << 43
WORD = ("which", "block", "other", "word")


@dataclass(frozen=True)
class Report:
    """``keys``, ``inputs``: name -> SQL over the rows; the other fields: name -> SQL over keys and inputs.

    ``averages`` and ``long_averages`` name inputs (double, integer);
    ``distinct``: counted inputs; ``addresses``: those of them that hold IP
    addresses as a rule.  ``columns``: the report's columns, as SQL over all names.
    """

    keys: dict[str, str]
    inputs: dict[str, str]
    columns: tuple[str, ...]
    where: str = "true"
    sums: dict[str, str] = field(default_factory=dict)
    maxima: dict[str, str] = field(default_factory=dict)
    averages: dict[str, str] = field(default_factory=dict)
    long_averages: dict[str, str] = field(default_factory=dict)
    distinct: dict[str, str] = field(default_factory=dict)
    addresses: tuple[str, ...] = ()

    # -- the states --

    def _limbs(self) -> dict[str, str]:
        """Additive parts of the averages: name -> SQL over the prepared rows."""
        out = {}
        for name, c in self.averages.items():
            h, low = f"_h_{name}", f"_l_{name}"
            out |= {f"{name}_1": f"sum(shiftright({h}, 40))", f"{name}_2": f"sum(shiftright({h}, 20) & 1048575)", f"{name}_3": f"sum({h} & 1048575)",
                    f"{name}_4": f"sum(shiftright({low}, 22))", f"{name}_5": f"sum({low} & 4194303)",
                    f"{name}_rest": f"sum(CASE WHEN NOT abs({c}) < 1e12D THEN {c} END)", f"{name}_n": f"count({c})"}
        for name, c in self.long_averages.items():
            out |= {f"{name}_1": f"sum(shiftright({c}, 44))", f"{name}_2": f"sum(shiftright({c}, 22) & 4194303)", f"{name}_3": f"sum({c} & 4194303)", f"{name}_n": f"count({c})"}
        return out

    def _prepared(self, rows: DataFrame) -> DataFrame:
        out = rows.where(self.where).selectExpr(*(f"{sql} AS {name}" for name, sql in {**self.keys, **self.inputs}.items()))
        if self.averages:
            out = out.selectExpr("*", *(f"CASE WHEN abs({c}) < 1e12D THEN floor({c} * {HIGH}D) END AS _h_{name}" for name, c in self.averages.items()))
            out = out.selectExpr("*", *(f"CAST(({c} * {HIGH}D - CAST(_h_{name} AS DOUBLE)) * {LOW}D AS BIGINT) AS _l_{name}" for name, c in self.averages.items()))
        return self._stacked(out) if self.distinct else out

    def _stacked(self, rows: DataFrame) -> DataFrame:
        """One row for each counted column: which, block, other, word; the measures count in the first."""
        names = list(self.distinct.values())
        ips = [c for c in names if c in self.addresses]
        rows = rows.selectExpr("*", *(f"split({c}, '[.]') AS _p_{c}" for c in ips))
        rows = rows.selectExpr("*", *("CASE WHEN size(_p_{0}) = 4 THEN try_cast(_p_{0}[0] AS BIGINT) * 16777216 + try_cast(_p_{0}[1] AS BIGINT) * 65536"
                                      " + try_cast(_p_{0}[2] AS BIGINT) * 256 + try_cast(_p_{0}[3] AS BIGINT) END AS _v_{0}".format(c) for c in ips))
        # A number counts as the address only where it is written back as the same text.
        rows = rows.selectExpr("*", *("CASE WHEN _v_{0} BETWEEN 0 AND 4294967295 AND concat_ws('.', shiftright(_v_{0}, 24), shiftright(_v_{0}, 16) & 255, shiftright(_v_{0}, 8) & 255, _v_{0} & 255) = {0}"
                                      " THEN _v_{0} END AS _n_{0}".format(c) for c in ips))

        def word(k: int, c: str) -> str:
            if c not in ips:
                return f"{k}, CAST(NULL AS BIGINT), {c}, CASE WHEN {c} IS NOT NULL THEN 1L END"
            return f"{k}, shiftright(_n_{c}, 6), CASE WHEN _n_{c} IS NULL THEN {c} END, CASE WHEN _n_{c} IS NOT NULL THEN shiftleft(1L, CAST(_n_{c} & 63 AS INT)) WHEN {c} IS NOT NULL THEN 1L END"

        stack = f"stack({len(names)}, {', '.join(word(k, c) for k, c in enumerate(names))}) AS ({', '.join(WORD)})"
        return rows.selectExpr("*", stack)

    def _grouping(self, extra: tuple[str, ...]) -> list[str]:
        return [*extra, *self.keys, *(WORD[:3] if self.distinct else ())]

    def partial(self, rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """States of ``rows`` by key (and by the columns ``extra``, as a day)."""
        keyed = self if not extra else Report(**{**self.__dict__, "keys": {**{e: e for e in extra}, **self.keys}})
        only = " FILTER (WHERE which = 0)" if self.distinct and len(self.distinct) > 1 else ""
        states = {**self.sums, **{n: f"max({c})" for n, c in self.maxima.items()}, **self._limbs()}
        aggs = [F.expr(f"{sql}{only}").alias(name) for name, sql in states.items()]
        if self.distinct:
            aggs.append(F.expr("bit_or(word)").alias("word"))
        return keyed._prepared(rows).groupBy(*self._grouping(extra)).agg(*aggs)

    def merge(self, states: DataFrame) -> DataFrame:
        """States of several partials put together by key."""
        additive = [*self.sums, *self._limbs()]
        aggs = [F.expr(f"sum({n})").alias(n) for n in additive] + [F.expr(f"max({n})").alias(n) for n in self.maxima]
        if self.distinct:
            aggs.append(F.expr("bit_or(word)").alias("word"))
        return states.groupBy(*self._grouping(())).agg(*aggs)

    def finish(self, merged: DataFrame) -> DataFrame:
        """The report's columns from states that are merged by key."""
        if self.distinct:
            aggs = [F.expr(f"sum({n})").alias(n) for n in [*self.sums, *self._limbs()]] + [F.expr(f"max({n})").alias(n) for n in self.maxima]
            aggs += [F.expr(f"coalesce(sum(bit_count(word)) FILTER (WHERE which = {k}), 0)").alias(name) for k, name in enumerate(self.distinct)]
            merged = merged.groupBy(*self.keys).agg(*aggs)
        whole = lambda name, parts: " + ".join(f"CAST(coalesce({name}_{k}, 0) AS DECIMAL(20,0)) * {scale}BD" for k, scale in parts)
        averages = [f"CASE WHEN {n}_n > 0 THEN (CAST({whole(n, ((1, 1 << 40), (2, 1 << 20), (3, 1)))} AS DOUBLE) / {HIGH}D + CAST({whole(n, ((4, 1 << 22), (5, 1)))} AS DOUBLE) / {float(HIGH * LOW)}D"
                    f" + coalesce({n}_rest, 0D)) / {n}_n END AS {n}" for n in self.averages]
        averages += [f"CAST({whole(n, ((1, 1 << 44), (2, 1 << 22), (3, 1)))} AS DOUBLE) / {n}_n AS {n}" for n in self.long_averages]
        names = [*self.keys, *self.sums, *self.maxima, *self.distinct]
        return merged.selectExpr(*names, *averages).selectExpr(*self.columns)

    def of(self, rows: DataFrame) -> DataFrame:
        """The report of ``rows``."""
        return self.finish(self.partial(rows))
