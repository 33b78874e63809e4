"""Versioned data as DataFrames: a history whose rows carry the snapshots they live in.

``History.rows`` has the data columns plus ``__valid_from`` (the snapshot that added
the row) and ``__valid_to`` (the one that removed it, NULL while it lives);
``History.snapshots`` has one row per change (snapshot_id, committed_at,
operation).  Every operator takes a history and returns another one or a plain
DataFrame; nothing is stored.  A caller who keeps a history writes ``rows`` and
``snapshots`` as ordinary tables.

Results: a predicate that is NULL for a row does not delete it; a batch is
matched by column name, and a column that it lacks is NULL.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructType

from quarry.operators import ordered

FROM, TO = "__valid_from", "__valid_to"
SNAPSHOT_SCHEMA = "snapshot_id bigint, committed_at timestamp_ntz, operation string"


@dataclass(frozen=True)
class History:
    rows: DataFrame
    snapshots: DataFrame
    version: int  # the latest snapshot

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in (FROM, TO)]


def _stamped(h: History, rows: DataFrame, operation: str, at: dt.datetime) -> History:
    spark = h.rows.sparkSession
    one = spark.createDataFrame([(h.version + 1, at, operation)], SNAPSHOT_SCHEMA)
    return History(rows, h.snapshots.unionByName(one), h.version + 1)


def create(spark: SparkSession, schema: StructType, at: dt.datetime) -> History:
    """An empty history: snapshot 0."""
    rows = spark.createDataFrame([], schema).withColumns(
        {FROM: F.lit(None).cast("bigint"), TO: F.lit(None).cast("bigint")}
    )
    return History(rows, spark.createDataFrame([(0, at, "create")], SNAPSHOT_SCHEMA), 0)


def append(h: History, batch: DataFrame, at: dt.datetime) -> History:
    """The batch's rows live from the new snapshot on."""
    if extra := set(batch.columns) - set(h.columns):
        raise ValueError(f"columns {sorted(extra)} are not in the history")
    new = batch.withColumns({FROM: F.lit(h.version + 1).cast("bigint"), TO: F.lit(None).cast("bigint")})
    return _stamped(h, h.rows.unionByName(new, allowMissingColumns=True), "append", at)


def append_batches(h: History, rows: DataFrame, batch: Column, commits: Sequence[dt.datetime]) -> History:
    """Several appends from one pass over ``rows``: ``batch`` (0, 1, ...) says which of them brings a row."""
    new = rows.withColumns({FROM: (F.lit(h.version + 1) + batch).cast("bigint"), TO: F.lit(None).cast("bigint")})
    out = replace(h, rows=h.rows.unionByName(new, allowMissingColumns=True))
    for at in commits:
        out = _stamped(out, out.rows, "append", at)
    return out


def delete_where(h: History, predicate: Column, at: dt.datetime) -> History:
    """Rows that live now and for which the predicate is TRUE end with the new snapshot."""
    gone = F.col(TO).isNull() & (F.col(FROM) <= h.version) & F.coalesce(predicate, F.lit(False))
    rows = h.rows.withColumn(TO, F.when(gone, F.lit(h.version + 1).cast("bigint")).otherwise(F.col(TO)))
    return _stamped(h, rows, "delete", at)


def overwrite(h: History, batch: DataFrame, at: dt.datetime) -> History:
    """All rows end and the batch begins with the new snapshot."""
    ended = replace(h, rows=delete_where(h, F.lit(True), at).rows)
    out = append(ended, batch, at)
    named = F.when(F.col("snapshot_id") == out.version, "overwrite").otherwise(F.col("operation"))
    return replace(out, snapshots=out.snapshots.withColumn("operation", named))


def as_of(h: History, version: int | Column | None = None) -> DataFrame:
    """The rows that live in a snapshot (the latest unless given)."""
    v = F.lit(h.version) if version is None else F.lit(version) if isinstance(version, int) else version
    return h.rows.where((F.col(FROM) <= v) & (F.col(TO).isNull() | (F.col(TO) > v))).select(h.columns)


def as_of_time(h: History, at: dt.datetime) -> DataFrame:
    """The rows of the latest snapshot committed at or before ``at`` (none if there is no such snapshot)."""
    upto = h.snapshots.where(F.col("committed_at") <= F.lit(at).cast("timestamp_ntz"))
    return as_of(h, upto.select(F.max("snapshot_id")).scalar())


def snapshot_summary(h: History, partitions: int) -> DataFrame:
    """Each snapshot with the rows it added and removed and the rows that live after it.

    Two aggregates of the history, joined to the snapshots; the running total is
    computed over range partitions, like any ordered operator here.
    """
    added = h.rows.groupBy(F.col(FROM).alias("snapshot_id")).agg(F.count(F.lit(1)).alias("added"))
    removed = h.rows.where(F.col(TO).isNotNull()).groupBy(F.col(TO).alias("snapshot_id")).agg(F.count(F.lit(1)).alias("removed"))
    out = h.snapshots.join(added, "snapshot_id", "left").join(removed, "snapshot_id", "left").fillna(0, ["added", "removed"])
    change = F.col("added") - F.col("removed")
    out = ordered.with_positions(out, ["snapshot_id"], [], name="__n", running={"total": change}, partitions=partitions)
    return out.select("snapshot_id", "committed_at", "operation", "added", "removed", "total")


def expire(h: History, kept: Iterable[int]) -> History:
    """Only the retained snapshots stay, any set of them, and the rows that one of them can see.

    A row's life [valid_from, valid_to) must be stabbed by a retained snapshot: the first one at
    or after valid_from, found for each valid_from in a table with a row for each snapshot, comes before valid_to.
    """
    wanted = sorted(set(kept))
    if not wanted or wanted[0] < 0 or wanted[-1] > h.version:
        raise ValueError(f"snapshots to keep must be some of 0 to {h.version}")
    following, first = {}, None
    for v in reversed(range(h.version + 1)):
        first = v if v in set(wanted) else first
        following[v] = first
    table = h.rows.sparkSession.createDataFrame([(v, f) for v, f in following.items() if f is not None], "__start bigint, __seen bigint")
    # one row for each snapshot of the history
    rows = h.rows.join(F.broadcast(table), F.col(FROM) == F.col("__start"))
    rows = rows.where(F.col(TO).isNull() | (F.col("__seen") < F.col(TO))).drop("__start", "__seen")
    return replace(h, rows=rows, snapshots=h.snapshots.where(F.col("snapshot_id").isin(wanted)))


def add_column(h: History, name: str, kind: str | DataType, at: dt.datetime) -> History:
    """A new column: NULL in the rows there are."""
    if name in h.rows.columns:
        raise ValueError(f"column {name!r} exists")
    rows = h.rows.withColumn(name, F.lit(None).cast(kind)).select(*h.columns, name, FROM, TO)
    return _stamped(h, rows, "add column", at)


def rename_column(h: History, old: str, new: str, at: dt.datetime) -> History:
    """Old rows are read under the new name."""
    if old not in h.columns or new in h.rows.columns:
        raise ValueError(f"can't rename {old!r} to {new!r}")
    return _stamped(h, h.rows.withColumnRenamed(old, new), "rename column", at)


_WIDER = {"tinyint": ("smallint", "int", "bigint"), "smallint": ("int", "bigint"), "int": ("bigint",), "float": ("double",)}


def can_widen(old: str, new: str) -> bool:
    """Casts that lose nothing: longer integers, float to double, a decimal of more digits on both sides."""
    if new in _WIDER.get(old, ()):
        return True
    a, b = (re.fullmatch(r"decimal\((\d+),(\d+)\)", x) for x in (old, new))
    if not (a and b):
        return False
    (p, s), (q, r) = (tuple(map(int, m.groups())) for m in (a, b))
    return r >= s and q - r >= p - s and (p, s) != (q, r) and q <= DecimalType(38).precision


def widen_type(h: History, name: str, kind: str, at: dt.datetime) -> History:
    """A column of a wider type; anything else is refused."""
    old = dict(h.rows.dtypes)[name]
    if not can_widen(old, kind):
        raise ValueError(f"only widening is allowed, not {old} to {kind}")
    return _stamped(h, h.rows.withColumn(name, F.col(name).cast(kind)), "widen type", at)
