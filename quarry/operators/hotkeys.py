"""Heavy hitters of join and layout keys, from a mergeable frequent-items sketch.

One aggregate pass per input: every task summarises its keys in a bounded table,
summaries merge in the shuffle, and a row for each input reaches the driver.
The sketch never names a key that is not there, and it names every
key above its error bound, so the list is complete for all shares that matter
to a task, and its length is bounded by the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

#: The most keys that one sketch may track.
MOST_TRACKED = 1_000_000

_PLAIN = (BooleanType, ByteType, ShortType, IntegerType, LongType, StringType, DateType, TimestampType, TimestampNTZType, DecimalType)


def _one_zero(c: Column, kind: DataType) -> Column:
    """Floating-point zeros are one key, as in a join."""
    return F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c) if isinstance(kind, (FloatType, DoubleType)) else c


def key_item(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key as one value that the sketch can count: equal for equal keys, different for different ones.

    A single column of a plain type stands for itself; several columns, or other
    types, are written as text.  NULL if any of the columns is.
    """
    kinds = [df.schema[k].dataType for k in keys]
    if len(keys) == 1 and isinstance(kinds[0], _PLAIN):
        return F.col(keys[0])
    parts = [_one_zero(F.col(k), kind).alias(f"k{i}") for i, (k, kind) in enumerate(zip(keys, kinds, strict=True))]
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return F.when(present, F.to_json(F.struct(*parts)))


@dataclass(frozen=True)
class KeyCounts:
    """Rows, rows with a NULL key, and the frequent keys of an input (item -> estimated rows, too high by at most ``error``)."""

    rows: int
    nulls: int
    frequent: dict
    error: float


def frequent_keys(df: DataFrame, items: dict[str, Column], partitions: int, parts: int = 2) -> dict[str, KeyCounts]:
    """For each named item column, the keys with more than 1 / (``parts`` * ``partitions``) of the rows.

    All items are summarised in the same pass.  The sketch tracks eight keys for
    each one that can pass the share, so its error is a small part of the share; beyond
    MOST_TRACKED keys the share is raised to what the sketch can tell apart.
    """
    most = min(parts * partitions, MOST_TRACKED // 8)
    tracked = 1 << (8 * most - 1).bit_length()
    tracked = min(max(tracked, 64), MOST_TRACKED)
    aggs = [F.count(F.lit(1)).alias("rows")]
    typed = df.select(*[c.alias(f"i{k}") for k, c in enumerate(items.values())])
    for k in range(len(items)):
        aggs += [F.count_if(F.col(f"i{k}").isNull()).alias(f"n{k}")]
        aggs += [F.expr(f"approx_top_k(i{k}, {min(most + 1, tracked)}, {tracked})").alias(f"t{k}")]
    got = typed.agg(*aggs).first()
    out = {}
    for k, name in enumerate(items):
        share = max(got.rows, 1) / most
        top = {x["item"]: x["count"] for x in got[f"t{k}"] or [] if x["item"] is not None and x["count"] > share}
        out[name] = KeyCounts(got.rows, got[f"n{k}"], top, got.rows / (0.75 * tracked))
    return out
