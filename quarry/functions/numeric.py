"""Exact money arithmetic.

The inputs hold two-decimal amounts in doubles.  Sums of doubles depend on
the order rows arrive in, so money is cast to a decimal first, summed
exactly, and turned back into a double only at the end.  Averages are the
exact sum divided by the count, both as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of a two-decimal amount, returned as double."""
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    """Exact sum over count, as double (NULLs skipped like AVG)."""
    x = money(c)
    return F.sum(x).cast("double") / F.count(x).cast("double")

