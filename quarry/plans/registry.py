"""Registry of named queries.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the input
tables; most have an oracle: the same result as DuckDB SQL over the same
parquet files.  ``__spark_entry__`` exposes both dictionaries.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

_PLAN_MODULES = (
    "quarry.plans.relational",
    "quarry.plans.scalars",
    "quarry.plans.io",
    "quarry.plans.catalog",
    "quarry.plans.layout",
    "quarry.plans.versions",
    "quarry.plans.etl",
)


def query(key: str, oracle: str | None = None):
    """Register ``fn`` under ``key`` with an optional DuckDB oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return deco


def range_partitions(spark: SparkSession) -> int:
    """The queries deal and number their rows in as many partitions as the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def load_all() -> None:
    for name in _PLAN_MODULES:
        importlib.import_module(name)


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
