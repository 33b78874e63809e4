"""Join helpers that stay safe when one key holds a large share of the rows.

* A side is broadcast only after its bytes have been measured; otherwise joins
  carry no hint and adaptive execution decides by the bytes it sees, splitting
  hot partitions.
* Aggregate the many side per key before it meets the other side, so a hot
  key is collapsed by the map-side partial aggregate instead of landing whole
  in one join task.
* Joins of two many sides are led by a heavy-hitter summary of their keys
  (``skew_join``): only hot keys are cut into pieces, by their measured share.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from quarry.operators.hotkeys import KeyCounts, frequent_keys, key_item

#: A side of this many bytes (as JSON text) may be sent to every executor.
BROADCAST_BYTES = 8 * 1024 * 1024
#: Pieces of a hot key in a task's share of rows.
PIECES = 16


def text_bytes(df: DataFrame) -> int:
    """Bytes of all rows as JSON text: one aggregate pass, one number back."""
    return int(df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0)


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a measurement of the bytes; otherwise adaptive execution decides."""
    return F.broadcast(df) if text_bytes(df) <= max_bytes else df


def exists_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, negate: bool = False) -> DataFrame:
    """EXISTS / NOT EXISTS on one equality: left rows with (without) a match.

    The right side is reduced to its distinct keys first.  A NULL left key
    never matches, so NOT EXISTS keeps it.
    """
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    how = "left_anti" if negate else "left_semi"
    return left.join(keys, left[left_key] == keys["__k"], how)


def aggregate_then_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    aggs: Sequence[Column],
    how: str = "left",
) -> DataFrame:
    """Aggregate ``right`` per key, then join it to ``left``.

    Equal to joining first and grouping by the left row when the left key is
    unique, but the shuffle carries one row per key instead of every match.
    """
    per_key = right.groupBy(F.col(right_key).alias("__k")).agg(*aggs)
    return left.join(per_key, left[left_key] == per_key["__k"], how).drop("__k")


def _salts(left: KeyCounts, right: KeyCounts, partitions: int) -> list[tuple]:
    """(item, salts of the left rows, salts of the right rows, in left, in right) of the keys hot on either side.

    A piece of a hot key is about a sixteenth of a task's rows, so pieces fill tasks evenly wherever their
    hash puts them.  A key hot on both sides is cut into a grid of as many cells, square in rows a cell.
    """
    out = []
    for item in {**left.frequent, **right.frequent}:
        a, b = left.frequent.get(item, 0), right.frequent.get(item, 0)
        pieces_a = math.ceil(PIECES * partitions * a / max(left.rows, 1))
        pieces_b = math.ceil(PIECES * partitions * b / max(right.rows, 1))
        if a and b:
            cells = max(pieces_a, pieces_b)
            sa = min(cells, a, max(1, round(math.sqrt(cells * a / b))))
            pieces_a, pieces_b = sa, min(b, math.ceil(cells / sa))
        out.append((item, max(1, pieces_a), max(1, pieces_b), a > 0, b > 0))
    return out


def _dealt(side: DataFrame, item: Column, salts: DataFrame, by: Sequence[str], own: str, other: str, null_pieces: int) -> DataFrame:
    """Rows of one side with ``__sa``, ``__sb``: their own piece of a hot key, and each piece of the other side."""
    rows = side.withColumn("__i", item)
    # at most two rows for each partition and side
    rows = rows.join(F.broadcast(salts), F.col("__i").eqNullSafe(F.col("__item")) & F.col("__i").isNotNull(), "left")
    piece = F.xxhash64(*[F.col(c) for c in by], F.lit(29))
    mine = F.when(F.col("__i").isNull(), F.pmod(piece, F.lit(null_pieces)))
    mine = mine.otherwise(F.pmod(piece, F.coalesce(F.col(f"__n{own}").cast("bigint"), F.lit(1).cast("bigint"))))
    theirs = F.when(F.col(f"__n{other}") > 1, F.sequence(F.lit(0), F.col(f"__n{other}") - 1)).otherwise(F.array(F.lit(0)))
    return rows.withColumn(f"__s{own}", mine.cast("int")).withColumn(f"__s{other}", F.explode(theirs))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str,
    *,
    partitions: int,
    left_by: Sequence[str] | None = None,
    right_by: Sequence[str] | None = None,
    suffix: str = "_right",
) -> DataFrame:
    """INNER / LEFT / RIGHT / FULL join USING the columns ``on``, whatever share of either side one key holds.

    The key columns come once (from the side that has the row), then the other
    columns of the left and of the right side; a right column whose name the
    left side has as well gets ``suffix``.  NULL keys match nothing.

    1. A frequent-items sketch of both sides (one pass over the key columns each)
       names the keys that exceed half a task's share of their side.
    2. Rows of such a key are cut into pieces by a hash of ``left_by`` / ``right_by`` (all
       columns unless given; they must tell rows apart the same way on every
       read), and each row meets all pieces of the other side.  Other rows are neither salted nor copied.
    3. NULL keys are dropped from a side that is not preserved; on a preserved one they are dealt
       evenly, as they match nothing wherever they are.
    4. A hot key is there on its own side for certain (the sketch names no others), so a row of the
       other side that met an empty piece has its match elsewhere: such rows are taken out again.

    Keys of different types are compared, and returned, as their common type.
    Each side is read once after the sketch.  With no hot key and no NULL key this is the plain join.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"not a join: {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    taken = {*left.columns}
    names = {c: c + suffix if c in taken and c not in keys else c for c in right.columns}
    if clash := [n for c, n in names.items() if n != c and (n in taken or n in right.columns)]:
        raise ValueError(f"columns {clash} exist already; choose another suffix")
    order = [*keys, *[c for c in left.columns if c not in keys], *[names[c] for c in right.columns if c not in keys]]
    right = right.withColumnsRenamed(names)
    right_by = [names[c] for c in right_by] if right_by else right.columns
    left_by = list(left_by) if left_by else left.columns
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    keep_left, keep_right = how in ("left", "full"), how in ("right", "full")
    left = left if keep_left else left.where(known)
    right = right if keep_right else right.where(known)

    if [left.schema[k].dataType for k in keys] != [right.schema[k].dataType for k in keys]:
        # the common type of a union, so that both sides name a key alike
        both = left.select(keys).limit(0).unionByName(right.select(keys).limit(0)).schema
        left, right = (x.withColumns({k: F.col(k).cast(both[k].dataType) for k in keys}) for x in (left, right))
    item_l, item_r = key_item(left, keys), key_item(right, keys)
    a = frequent_keys(left, {"k": item_l}, partitions)["k"]
    b = frequent_keys(right, {"k": item_r}, partitions)["k"]
    hot = _salts(a, b, partitions)
    if not hot and not (keep_left and a.nulls) and not (keep_right and b.nulls):
        return left.join(right, keys, how).select(order)

    schema = StructType([
        StructField("__item", left.select(item_l.alias("i")).schema["i"].dataType), StructField("__na", IntegerType()), StructField("__nb", IntegerType()),
        StructField("__in_left", BooleanType()), StructField("__in_right", BooleanType()),
    ])
    salts = left.sparkSession.createDataFrame(hot, schema)
    null_pieces = PIECES * partitions
    x = _dealt(left, item_l, salts, left_by, "a", "b", null_pieces).withColumn("__l", F.lit(True))
    y = _dealt(right, item_r, salts, right_by, "b", "a", null_pieces).withColumn("__r", F.lit(True))
    x = x.withColumnsRenamed({"__in_right": "__hot_right"}).drop("__i", "__item", "__na", "__nb", "__in_left")
    y = y.withColumnsRenamed({"__in_left": "__hot_left"}).drop("__i", "__item", "__na", "__nb", "__in_right")
    joined = x.join(y, [*keys, "__sa", "__sb"], how)
    if keep_left:
        joined = joined.where(F.col("__r").isNotNull() | ~F.coalesce(F.col("__hot_right"), F.lit(False)))
    if keep_right:
        joined = joined.where(F.col("__l").isNotNull() | ~F.coalesce(F.col("__hot_left"), F.lit(False)))
    return joined.select(order)


def attach_aggregate(rows: DataFrame, per_group: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a per-group aggregate back onto the rows of its groups.

    NULL group keys match, as in the grouping.  The aggregate has one row a
    group, so a hot group is a hot partition of the rows only, which adaptive
    execution splits (or avoids, if the aggregate's bytes allow a broadcast).
    """
    side = per_group
    for k in keys:
        side = side.withColumnRenamed(k, f"__g_{k}")
    cond = None
    for k in keys:
        c = rows[k].eqNullSafe(side[f"__g_{k}"])
        cond = c if cond is None else cond & c
    return rows.join(side, cond, "inner").drop(*[f"__g_{k}" for k in keys])


def left_join_unique(left: DataFrame, right_unique: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT join to a side that has at most one row per key (e.g. distinct
    keys): no key is hot on the non-preserved side, and AQE may split hot
    partitions of the preserved left side, so the plain outer join is safe."""
    return left.join(right_unique, left[left_key] == right_unique[right_key], "left")
