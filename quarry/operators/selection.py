"""Exact quantiles of many columns at once, by narrowing, without sorting or numbering a row.

1. One pass summarises all columns in mergeable quantile sketches, which propose
   values around each wanted rank.
2. The next pass counts, for all columns together, the values below and up to each
   proposal: exact ranks, so each wanted value now lies strictly between two proposals,
   or is one of them.
3. If at most LEFT values remain in between, a last pass counts them one by one (one
   aggregate for all brackets); otherwise steps 1 and 2 are repeated inside the brackets, which
   shrink by a factor of some ACCURACY / 5 each time.

So three passes serve LEFT * ACCURACY / 5 rows and five the square of ACCURACY / 5 times as many, for any number of columns.  Proposals,
counts and at most LEFT counted values for each quantile reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Inverse of the sketch's rank error.
ACCURACY = 10_000
#: Values between two proposals that are counted one by one.
LEFT = 20_000


@dataclass
class _Wanted:
    """The ``rank``-th smallest value of a column: after ``upto_low`` values up to ``low``, and below ``high`` (None: no bound)."""

    column: str
    p: float
    kind: DataType
    rank: int = 0
    low: object = None
    upto_low: int = 0
    high: object = None
    inside: int = 0
    value: object = None
    found: bool = False

    def literal(self, v) -> Column:
        return F.lit(v).cast(self.kind)

    def within(self) -> Column:
        c, ok = F.col(self.column), F.col(self.column).isNotNull()
        ok = ok & (c > self.literal(self.low)) if self.low is not None else ok
        return ok & (c < self.literal(self.high)) if self.high is not None else ok

    def settle(self, proposals: list[tuple]) -> None:
        """Narrow by (value, values below it, values up to it), in ascending order."""
        for v, below, upto in proposals:
            if below < self.rank <= upto:
                self.value, self.found = v, True
                return
            if upto < self.rank:
                self.low, self.upto_low = v, upto
            else:
                self.high, self.inside = v, below - self.upto_low
                return
        self.inside = self.inside if self.high is not None else self.inside - self.upto_low


def _proposals(df: DataFrame, active: list[_Wanted]) -> list[list]:
    """Values around each rank, from a sketch of what lies inside its bracket."""
    aggs = []
    for k, w in enumerate(active):
        share, slack = (w.rank - w.upto_low) / max(w.inside, 1), 2.5 / ACCURACY
        points = [min(1.0, max(0.0, share + d)) for d in (-slack, 0.0, slack)]
        aggs.append(F.percentile_approx(F.when(w.within(), F.col(w.column)), points, ACCURACY).alias(f"q{k}"))
    got = df.agg(*aggs).first()
    return [sorted(set(got[f"q{k}"] or []), key=lambda v: (v != v, v)) for k in range(len(active))]


def _rank(df: DataFrame, active: list[_Wanted], proposed: list[list]) -> None:
    """Exact ranks of all proposals in one pass."""
    aggs = []
    for k, (w, values) in enumerate(zip(active, proposed, strict=True)):
        for j, v in enumerate(values):
            c = F.col(w.column)
            aggs += [F.count_if(c < w.literal(v)).alias(f"b{k}_{j}"), F.count_if(c <= w.literal(v)).alias(f"u{k}_{j}")]
    got = df.agg(*aggs).first()
    for k, (w, values) in enumerate(zip(active, proposed, strict=True)):
        w.settle([(v, got[f"b{k}_{j}"], got[f"u{k}_{j}"]) for j, v in enumerate(values)])


def _exact(text: str, number: float, kind: DataType):
    name = kind.typeName()
    return number if name in ("double", "float") else Decimal(text) if name == "decimal" else int(text)


def _count(df: DataFrame, active: list[_Wanted]) -> None:
    """Count the single values inside all brackets, in one pass, and read the ranks off."""
    parts = []
    for k, w in enumerate(active):
        c = F.col(w.column)
        parts.append(F.when(w.within(), F.struct(F.lit(k).alias("k"), c.cast("double").alias("number"), c.cast("string").alias("text"))))
    rows = df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("x")).select("x.*")
    values: list[list] = [[] for _ in active]
    for r in rows.groupBy("k", "number", "text").count().collect():
        values[r.k].append((_exact(r.text, r.number, active[r.k].kind), r["count"]))
    for w, found in zip(active, values, strict=True):
        at = w.upto_low
        for v, n in sorted(found, key=lambda x: (x[0] != x[0], x[0])):  # NaN is the largest
            at += n
            if at >= w.rank:
                w.value, w.found = v, True
                break


def exact_quantiles(df: DataFrame, probs: dict[str, Sequence[float]]) -> dict[str, dict[float, object]]:
    """Discrete quantiles of numeric columns (NULLs skipped): the value at position ceil(p * n); None without values."""
    wanted = [_Wanted(c, p, df.schema[c].dataType) for c, ps in probs.items() for p in dict.fromkeys(ps)]
    if wanted:
        df = df.select(list(probs))
        sizes = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(probs)]).first()
        for w in wanted:
            w.inside = sizes[f"n{list(probs).index(w.column)}"]
            w.rank, w.found = max(1, math.ceil(w.p * w.inside)), w.inside == 0
    while active := [w for w in wanted if not w.found]:
        before = [w.inside for w in active]
        if max(before) > LEFT:
            _rank(df, active, _proposals(df, active))
            if any(w.inside < n or w.found for w, n in zip(active, before, strict=True)):
                continue
        _count(df, [w for w in active if not w.found])
    return {c: {p: next(w.value for w in wanted if (w.column, w.p) == (c, p)) for p in ps} for c, ps in probs.items()}
