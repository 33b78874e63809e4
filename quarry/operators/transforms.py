"""Partition transforms: layouts by values derived from a column, and the predicates that follow for them.

A layout stores rows in folders by transforms of its columns (identity, year,
month, day, hour, bucket, truncate).  Readers name predicates on the columns
themselves; each is projected onto the derived columns, where it prunes
folders before any file is opened, and is then applied to the rows as well.  One predicate
goes to every layout of a table in turn, whatever each is partitioned by.

What follows from a predicate on the source, for a derived value t:

* identity -- the same comparison.
* year, month, day, hour, truncate -- monotone: ``=`` and IN give t = t(v), ``<`` and ``<=`` give t <= t(v),
  ``>`` and ``>=`` give t >= t(v).  Where the type has a next value (dates, times, integers), a strict bound is
  closed first, so that ``date < 1996-01-01`` does not read 1996.
* bucket -- ``=`` and IN give the buckets of the values; ranges give nothing.
* IS NULL, IS NOT NULL -- the same for every transform: NULL has a folder of its own.

Spark writes an empty string into the NULL folder too, so predicates that an empty string can satisfy keep that folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from quarry.sources import files

_INTEGERS = (ByteType, ShortType, IntegerType, LongType)
_TIMES = (DateType, TimestampType, TimestampNTZType)
_PLAIN = (*_INTEGERS, StringType, DateType, DecimalType, BooleanType)
OPERATORS = ("=", "in", "<", "<=", ">", ">=", "between", "is null", "is not null")


@dataclass(frozen=True)
class Transform:
    """``kind`` of ``column``; ``n`` is the number of buckets or the width of truncate."""

    kind: str
    column: str
    n: int | None = None

    @property
    def name(self) -> str:
        """Of the derived column, which is also the folder's."""
        return f"{self.column}_{self.kind}" + (f"_{self.n}" if self.n else "")

    def check(self, kind: DataType) -> None:
        ok = {
            "identity": isinstance(kind, _PLAIN),
            "year": isinstance(kind, _TIMES),
            "month": isinstance(kind, _TIMES),
            "day": isinstance(kind, _TIMES),
            "hour": isinstance(kind, (TimestampType, TimestampNTZType)),
            "bucket": isinstance(kind, (*_PLAIN, TimestampType, TimestampNTZType)),
            "truncate": isinstance(kind, (*_INTEGERS, StringType, DecimalType)),
        }
        if self.kind not in ok:
            raise ValueError(f"unknown transform {self.kind!r}")
        if not ok[self.kind]:
            raise ValueError(f"{self.kind} of {self.column}: not for {kind.simpleString()}")
        if self.kind in ("bucket", "truncate") and not (self.n and self.n > 0):
            raise ValueError(f"{self.kind} needs a positive number")

    def apply(self, value: Column, kind: DataType) -> Column:
        """The derived value; NULL for NULL."""
        if self.kind == "identity":
            return value
        if self.kind in ("year", "month", "day", "hour"):
            if isinstance(kind, TimestampType):  # by UTC, so that no session's zone moves a row
                day = F.date_from_unix_date(F.floor(F.unix_micros(value) / 86_400_000_000).cast("int"))
                hour = F.pmod(F.floor(F.unix_micros(value) / 3_600_000_000), F.lit(24))
            else:
                day, hour = value.cast("date"), F.hour(value) if self.kind == "hour" else None
            if self.kind == "hour":
                return F.when(value.isNotNull(), F.concat(day.cast("string"), F.lit("-"), F.lpad(hour.cast("string"), 2, "0")))
            return {"year": F.year(day), "month": F.trunc(day, "month"), "day": day}[self.kind]
        if self.kind == "bucket":
            return F.when(value.isNotNull(), F.pmod(F.hash(value), F.lit(self.n)))
        if isinstance(kind, StringType):
            return F.substring(value, 1, self.n)
        if isinstance(kind, DecimalType):
            return (value - F.pmod(value, F.lit(self.n).cast("decimal(10,0)"))).cast(kind)
        return (value.cast("decimal(20,0)") - F.pmod(value, F.lit(self.n).cast("bigint")).cast("decimal(20,0)")).cast("decimal(20,0)")

    def kind_of(self, kind: DataType) -> DataType:
        if self.kind in ("year", "bucket"):
            return IntegerType()
        if self.kind in ("month", "day"):
            return DateType()
        if self.kind == "hour":
            return StringType()
        if self.kind == "truncate" and isinstance(kind, _INTEGERS):
            return DecimalType(20, 0)
        return kind


@dataclass(frozen=True)
class Predicate:
    """``column`` ``op`` ``value`` (a list for IN, a pair for BETWEEN, nothing for the NULL tests)."""

    column: str
    op: str
    value: object = None

    def __post_init__(self):
        if self.op not in OPERATORS:
            raise ValueError(f"unknown operator {self.op!r}")

    def on(self, kind: DataType) -> Column:
        """The predicate on the source column."""
        c, lit = F.col(self.column), lambda v: F.lit(v).cast(kind)
        if self.op == "is null":
            return c.isNull()
        if self.op == "is not null":
            return c.isNotNull()
        if self.op == "in":
            return c.isin([lit(v) for v in self.value]) if self.value else F.lit(False)
        if self.op == "between":
            return c.between(lit(self.value[0]), lit(self.value[1]))
        return {"=": c == lit(self.value), "<": c < lit(self.value), "<=": c <= lit(self.value), ">": c > lit(self.value), ">=": c >= lit(self.value)}[self.op]


def _closed(value: Column, kind: DataType, up: bool) -> Column | None:
    """The next value after (before) a strict bound; None if the type has none."""
    if isinstance(kind, DateType):
        return F.date_add(value, 1 if up else -1)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return value + F.expr(f"INTERVAL '{'' if up else '-'}0.000001' SECOND")
    if isinstance(kind, _INTEGERS):
        return value.cast("decimal(20,0)") + F.lit(1 if up else -1).cast("decimal(1,0)")
    return None


def projected(predicate: Predicate, transform: Transform, kind: DataType) -> Column | None:
    """The condition on the derived column that every row satisfying the predicate meets; None if there is none."""
    if transform.column != predicate.column:
        return None
    t, op = F.col(f"`{transform.name}`"), predicate.op
    if op == "is null":
        return t.isNull()
    text = isinstance(kind, StringType) and transform.kind in ("identity", "truncate")
    if op == "is not null":
        return None if text else t.isNotNull()
    lit = lambda v: F.lit(v).cast(kind)
    value = lambda v: transform.apply(lit(v), kind)
    if op in ("=", "in"):
        values = list(predicate.value) if op == "in" else [predicate.value]
        if not values:
            return F.lit(False)
        found = t.isin([value(v) for v in values])
        return found | t.isNull() if text and "" in values else found
    if transform.kind == "bucket":
        return None
    low, high = (predicate.value if op == "between" else (predicate.value, None) if op in (">", ">=") else (None, predicate.value))
    found = F.lit(True)
    for bound, up in ((low, True), (high, False)):
        if bound is None:
            continue
        edge = lit(bound)
        if op in ("<", ">"):
            closed = _closed(edge, kind, up)
            if transform.kind == "identity":
                found = found & (t > edge if up else t < edge)
                continue
            edge = closed if closed is not None else edge
        edge = transform.apply(edge, kind)
        found = found & (t >= edge if up else t <= edge)
    may_be_empty = text and (low is None or low == "")
    return found | t.isNull() if may_be_empty else found


@dataclass(frozen=True)
class Layout:
    """Rows of ``schema`` stored below ``path`` in folders by ``transforms``."""

    path: str
    transforms: tuple[Transform, ...]
    schema: StructType


def write_layout(df: DataFrame, path: str, transforms: Sequence[Transform]) -> Layout:
    """Store ``df`` by the transforms; a folder that is large is written by several tasks."""
    for t in transforms:
        t.check(df.schema[t.column].dataType)
    if clash := {t.name for t in transforms} & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")
    rows = df.withColumns({t.name: t.apply(F.col(t.column), df.schema[t.column].dataType) for t in transforms})
    files.write_clustered(rows, path, [t.name for t in transforms])
    return Layout(path, tuple(transforms), df.schema)


def scan(spark: SparkSession, layouts: Sequence[Layout], predicates: Sequence[Predicate] = ()) -> DataFrame:
    """The rows of all layouts for which every predicate is TRUE; columns that a layout lacks are NULL."""
    if not layouts:
        raise ValueError("no layout to scan")
    parts = []
    for layout in layouts:
        kinds = {f.name: f.dataType for f in layout.schema.fields}
        derived = [StructField(t.name, t.kind_of(kinds[t.column])) for t in layout.transforms]
        rows = files.read_partitioned(spark, layout.path, schema=StructType([*layout.schema.fields, *derived]))
        for p in predicates:
            for t in layout.transforms:
                if (condition := projected(p, t, kinds[t.column])) is not None:
                    rows = rows.where(condition)
            rows = rows.where(p.on(kinds[p.column])) if p.column in kinds else rows.where(F.lit(p.op == "is null"))
        parts.append(rows.select(*[F.col(f"`{c}`") for c in kinds]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
