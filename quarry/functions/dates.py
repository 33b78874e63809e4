"""Date helpers.

``CURRENT_DATE()`` changes every day; queries take the query date as a
parameter instead so their results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AS_OF = "2002-01-01"


def as_of_date(as_of: str = AS_OF) -> Column:
    return F.lit(as_of).cast("date")


def year_range(col: str, first_year: int, last_year: int | None = None) -> Column:
    """``first_year <= year(col) <= last_year`` as a range on the raw column,
    so the predicate is pushed down to the file scan."""
    last_year = first_year if last_year is None else last_year
    lo = F.lit(f"{first_year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{last_year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(col) >= lo) & (F.col(col) < hi)
