"""Seeded synthetic rows, generated on the executors.

The reference builds its sample staff table in a driver loop with an
unseeded random generator.  Here every column is a pure function of the row
id and a seed -- a Lehmer (MINSTD) sequence, x -> x * 48271 mod (2^31 - 1),
in 64-bit integer arithmetic -- so the table is the same on every run and
any engine can recompute it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODULUS = 2147483647  # 2^31 - 1
MULTIPLIER = 48271

# Fixed values of the generated table.
DEPARTMENTS = ["sales", "engineering", "finance", "people", "operations"]
CITIES = ["north", "south", "east", "west", "central"]
FIRST_DAY = "2022-01-01"
DAYS = 731  # 2022-01-01 .. 2024-01-01
SALARY_MIN_CENTS = 300_000
SALARY_SPAN_CENTS = 1_200_001  # salaries 3000.00 .. 15000.00


def lehmer_draws(id_col: Column, seed: int, n: int) -> list[Column]:
    draws, x = [], F.pmod(id_col.cast("bigint") * MULTIPLIER + seed, F.lit(MODULUS))
    for _ in range(n):
        draws.append(x)
        x = F.pmod(x * MULTIPLIER, F.lit(MODULUS))
    return draws


def _pick(values: list[str], draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw % len(values) + 1).cast("int"))


def synthetic_staff(ids: DataFrame, seed: int = 42, id_col: str = "id") -> DataFrame:
    """One staff row per id: name, department, city, salary, hire date."""
    r1, r2, r3, r4 = lehmer_draws(F.col(id_col), seed, 4)
    cents = SALARY_MIN_CENTS + r3 % SALARY_SPAN_CENTS
    return ids.select(
        F.col(id_col).alias("id"),
        F.concat(F.lit("staff_"), F.col(id_col).cast("string")).alias("name"),
        _pick(DEPARTMENTS, r1).alias("department"),
        _pick(CITIES, r2).alias("city"),
        (cents.cast("double") / 100).alias("salary"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (r4 % DAYS).cast("int")).alias("hired"),
    )


def synthetic_staff_range(spark, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows from ``spark.range`` (ids 0..n-1), spread over the cluster."""
    return synthetic_staff(spark.range(n), seed)
