"""Order-dependent operators that never put a whole group in one task, and store nothing.

``Window.partitionBy(g)`` sends every row of a group to one task, and a
window with no partition sends the whole table there.  Here the rows are
range-partitioned on (group, order, tie-break) instead, so a hot group is
spread over many partitions, and each partition numbers its rows locally.

1. Bounds.  A sample of the sort keys (SAMPLE rows for each partition, drawn in one job for all
   specifications) gives the bounds, which become literals of the plan.  The partition of a row is the
   number of bounds at or before it, found by binary search: a function of the row alone, the
   same in every pass and after a lost executor, so no numbered copy has to be written.
2. Totals.  In range order every group is one contiguous run, so only a group that holds a
   bound reaches over a border.  One aggregate for all specifications, with a map-side partial step, counts and sums
   the rows of each partition that belong to the group of its left and of its right border: a row for
   each partition reaches the driver, where a prefix scan gives what precedes each
   partition in its first group.
3. Rows.  One shuffle by partition number, then plain windows over (partition, group) --
   at most one range partition in a task -- plus the literals of step 2 for rows of a border's group.
   Several specifications follow one another, a shuffle each, joined by nothing.

Rows with equal group and order values (a tie) are a contiguous run as well: RANK of a tie that crosses a border
is the position in the group less the tie's rows before the border, DENSE_RANK the distinct ties before it.

The input is read three times (keys, keys and summed values, all columns): it must give the same rows
each time, as deterministic expressions over stored tables do.  ``order`` lists columns, or (column,
descending): NULLs come first ascending and last descending.  Rows that are equal in group, order and
tie-break are never split.  ``partitions``, the number of range partitions, is an argument of every operator: it
decides how much a task holds, and bounds everything that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cmp_to_key, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

#: Sampled rows for each range partition.
SAMPLE = 32

Order = Sequence[str | tuple[str, bool]]


@dataclass(frozen=True)
class Numbering:
    """What to compute over one window specification; a name that is None is not computed.

    ``running`` maps an output to a numeric column whose running SUM it is; ``ntile`` is
    (output, number of tiles); ``lead`` and ``lag`` are lists of (output, column, offset).
    """

    group: Sequence[str] = ()
    order: Order = ()
    tiebreak: Sequence[str] = ()
    position: str | None = None
    rank: str | None = None
    dense_rank: str | None = None
    running: dict[str, str] = field(default_factory=dict)
    ntile: tuple[str, int] | None = None
    lead: Sequence[tuple[str, str, int]] = ()
    lag: Sequence[tuple[str, str, int]] = ()

    @property
    def by(self) -> list[tuple[str, bool]]:
        return [(o, False) if isinstance(o, str) else o for o in self.order]

    @property
    def keys(self) -> list[tuple[str, bool]]:
        return [*((g, False) for g in self.group), *self.by, *((t, False) for t in self.tiebreak)]


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (like grouping does)."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


# -- step 1: bounds ---------------------------------------------------------


def _collected(c: str, kind: DataType) -> Column:
    """The key in a form that reaches Python without loss, whatever the session's time zone."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(F.col(c)).alias(c)
    return F.col(c).cast("string").alias(c) if isinstance(kind, TimestampNTZType) else F.col(c)


def _literal(value, kind: DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


def _before(a, b, down: bool) -> int:
    """-1, 0 or 1: the order of two key values as Spark sorts them."""
    if a is None or b is None:
        return 0 if a is b else (1 if down else -1) if a is None else (-1 if down else 1)
    if isinstance(a, str):
        a, b = a.encode(), b.encode()
    if isinstance(a, float) and (a != a or b != b):  # NaN is the largest and equals itself
        c = (a != a) - (b != b)
    else:
        c = (a > b) - (a < b)
    return -c if down else c


def _bounds(df: DataFrame, specs: Sequence[Numbering], partitions: int) -> tuple[list[list[tuple]], int]:
    """For each specification its bounds, sorted and distinct (fewer than ``partitions``); and the number of rows."""
    if partitions < 1:
        raise ValueError(f"partitions must be 1 or more, not {partitions}")
    names = list(dict.fromkeys(c for s in specs for c, _ in s.keys))
    n = df.count()
    if not names or partitions == 1 or not n:
        return [[] for _ in specs], n
    sample = df.select([_collected(c, df.schema[c].dataType) for c in names])
    share = SAMPLE * partitions / n
    rows = (sample.sample(share, seed=11) if share < 1 else sample).collect()
    out = []
    for s in specs:
        down = [d for _, d in s.keys]

        def compare(a, b, down=down):
            return next((c for x, y, d in zip(a, b, down) if (c := _before(x, y, d))), 0)

        sorted_keys = sorted((tuple(r[c] for c, _ in s.keys) for r in rows), key=cmp_to_key(compare))
        picked = [sorted_keys[len(sorted_keys) * k // partitions] for k in range(1, partitions)] if sorted_keys else []
        # a partition begins at its bound, so the first row makes no border
        out.append([b for a, b in zip([sorted_keys[0] if sorted_keys else None, *picked], picked) if compare(a, b)])
    return out, n


def _struct(bound: tuple, keys, schema) -> Column:
    return F.struct(*[_literal(v, schema[c].dataType).alias(f"k{i}") for i, (v, (c, _)) in enumerate(zip(bound, keys))])


def _row_before(bound: Column, keys) -> Column:
    """The row comes strictly before the bound (a struct k0, k1, ...)."""
    less = F.lit(False)
    for i, (c, down) in reversed(list(enumerate(keys))):
        row, b = F.col(c), bound[f"k{i}"]
        first = (row.isNotNull() & b.isNull()) | F.coalesce(row > b, F.lit(False)) if down else (
            (row.isNull() & b.isNotNull()) | F.coalesce(row < b, F.lit(False))
        )
        less = first | (row.eqNullSafe(b) & less)
    return less


def _partition(bounds: list[tuple], keys, schema) -> Column:
    """The number of bounds at or before the row, by binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[_struct(b, keys, schema) for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def step(at, width):
        reached = (at + width <= len(bounds)) & ~_row_before(F.try_element_at(array, at + width), keys)
        return F.when(reached, at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _at(values: list[Column], pid: Column) -> Column:
    """The value of a row's partition (one for each partition)."""
    return values[0] if len(values) == 1 else F.element_at(F.array(*values), pid + 1)


class _Borders:
    """Which rows belong to the group, or the tie, of the borders of their partition."""

    def __init__(self, spec: Numbering, bounds: list[tuple], schema):
        self.spec, self.n, g = spec, len(bounds) + 1, len(spec.group)
        self.pid = F.col("__pid")
        o = g + len(spec.by)
        structs = [_struct(b[:o], spec.keys[:o], schema) for b in bounds]
        none = F.lit(None).cast(self._type(spec.keys[:o], schema)) if o else None
        self.left = [none, *structs]
        self.right = [*structs, none]
        self.group_goes_on = [False, *[all(_before(x, y, False) == 0 for x, y in zip(a[:g], b[:g])) for a, b in zip(bounds, bounds[1:])]]
        self.tie_goes_on = [False, *[all(_before(x, y, False) == 0 for x, y in zip(a[:o], b[:o])) for a, b in zip(bounds, bounds[1:])]]
        self.columns = [c for c, _ in spec.keys[:o]]

    @staticmethod
    def _type(keys, schema) -> str:
        return "struct<" + ",".join(f"k{i}:{schema[c].dataType.simpleString()}" for i, (c, _) in enumerate(keys)) + ">"

    def _same(self, side: list, upto: int) -> Column:
        border = self.pid > 0 if side is self.left else self.pid < self.n - 1
        if not upto:
            return border
        bound = _at(side, self.pid)
        for i, c in enumerate(self.columns[:upto]):
            border = border & F.col(c).eqNullSafe(bound[f"k{i}"])
        return border

    @property
    def in_left(self) -> Column:
        """The row's group is that of the partition's left border, so it may go on from earlier partitions."""
        return self._same(self.left, len(self.spec.group))

    @property
    def in_right(self) -> Column:
        return self._same(self.right, len(self.spec.group))

    @property
    def tied_left(self) -> Column:
        return self._same(self.left, len(self.columns))

    @property
    def tied_right(self) -> Column:
        return self._same(self.right, len(self.columns))


# -- step 2: totals ---------------------------------------------------------


def _totals(df: DataFrame, plans: list[tuple[Numbering, _Borders, Column]]) -> list[dict[int, dict]]:
    """For each specification, by partition: rows, tied rows and sums of the right border's group, rows of the left one's."""
    parts = []
    width = max([len(s.running) for s, _, _ in plans])
    for k, (s, b, pid) in enumerate(plans):
        if b.n == 1:
            continue
        rows = df.select(*{c: None for c, _ in s.keys}, *[F.col(v).alias(f"__v{i}") for i, v in enumerate(s.running.values())], pid.alias("__pid"))
        rows = rows.select("*", b.in_left.alias("__inl"), b.in_right.alias("__inr"), b.tied_right.alias("__tr"))
        aggs = [F.count_if("__inl").alias("left"), F.count_if("__inr").alias("right"), F.count_if("__tr").alias("tied")]
        for i in range(width):
            total = F.sum(F.when(F.col("__inr"), F.col(f"__v{i}"))) if i < len(s.running) else F.lit(None)
            aggs.append(total.cast("string").alias(f"s{i}"))
        dense = F.lit(None).cast("bigint").alias("distinct")
        found = rows.where("__inl or __inr").groupBy("__pid").agg(*aggs, dense)
        if s.dense_rank:
            ties = rows.where("__inr").groupBy("__pid", *[c for c, _ in s.by]).agg(F.lit(1).alias("one"))
            empty = [F.lit(0).cast("bigint").alias(c) for c in ("left", "right", "tied")] + [F.lit(None).cast("string").alias(f"s{i}") for i in range(width)]
            found = found.unionByName(ties.groupBy("__pid").agg(F.count("one").alias("distinct")).select("__pid", *empty, "distinct"))
        parts.append(found.withColumn("spec", F.lit(k)))
    out: list[dict[int, dict]] = [{} for _ in plans]
    if parts:
        for r in reduce(DataFrame.unionByName, parts).collect():  # at most two rows for each partition and specification
            have = out[r["spec"]].setdefault(r["__pid"], {"left": 0, "right": 0, "tied": 0, "distinct": 0, **{f"s{i}": None for i in range(width)}})
            for c, v in r.asDict().items():
                if c in have and v is not None:
                    have[c] = v if c[0] == "s" else have[c] + v
    return out


def _scan(b: _Borders, totals: dict[int, dict], kinds: list[DataType]) -> dict[str, list]:
    """What precedes each partition in the group of its left border: rows, tied rows, distinct ties, sums."""
    from decimal import Decimal

    zero = {"left": 0, "right": 0, "tied": 0, "distinct": 0, **{f"s{i}": None for i in range(len(kinds))}}
    out = {"rows": [0], "tied": [0], "distinct": [0], "chain": [0], **{f"s{i}": [None] for i in range(len(kinds))}}
    number = [float if k.typeName() in ("double", "float") else Decimal if k.typeName() == "decimal" else int for k in kinds]
    for p in range(1, b.n):
        last, goes_on, tie = totals.get(p - 1, zero), b.group_goes_on[p - 1], b.tie_goes_on[p - 1]
        out["rows"].append(last["right"] + (out["rows"][-1] if goes_on else 0))
        out["distinct"].append(last["distinct"] + (out["distinct"][-1] - (out["tied"][-1] > 0) if goes_on else 0))
        out["tied"].append(last["tied"] + (out["tied"][-1] if tie else 0))
        out["chain"].append(out["chain"][-1] if goes_on else p)
        for i, to in enumerate(number):
            v, before = last[f"s{i}"], out[f"s{i}"][-1] if goes_on else None
            out[f"s{i}"].append(before if v is None else to(v) if before is None else to(v) + before)
    sizes: dict[int, int] = {}
    for p in range(1, b.n):  # the whole size of each border's group
        sizes[out["chain"][p]] = out["rows"][p] + totals.get(p, zero)["left"]
    out["size"] = [sizes.get(c, 0) for c in out["chain"]]
    out["right"] = [totals.get(p, zero)["right"] for p in range(b.n)]
    return out


# -- step 3: rows -----------------------------------------------------------


def _longs(values: list[int]) -> list[Column]:
    return [F.lit(v).cast("bigint") for v in values]


def _numbered(df: DataFrame, s: Numbering, b: _Borders, pid: Column, totals: dict[int, dict], partitions: int) -> DataFrame:
    kinds = [df.agg(F.sum(v)).schema[0].dataType for v in s.running.values()]
    scan = _scan(b, totals, kinds)
    rows = df.withColumn("__pid", pid).repartitionById(partitions, F.col("__pid"))
    columns = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first() for c, down in s.keys[len(s.group) :]] or [F.lit(1)]
    inside = Window.partitionBy("__pid", *s.group).orderBy(*columns)
    ties = Window.partitionBy("__pid", *s.group).orderBy(*columns[: len(s.by)] or [F.lit(1)])
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    added = {"__place": F.row_number().over(inside)}
    if s.rank:
        added["__rank"] = F.rank().over(ties)
    if s.dense_rank:
        added["__dense"] = F.dense_rank().over(ties)
    if s.ntile:
        added["__count"] = F.count(F.lit(1)).over(inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    for i, v in enumerate(s.running.values()):
        added[f"__sum{i}"] = F.sum(v).over(upto)
    for k, (_, c, by) in enumerate(s.lead):
        added[f"__lead{k}"] = F.lead(c, by).over(inside)
    for k, (_, c, by) in enumerate(s.lag):
        added[f"__lag{k}"] = F.lag(c, by).over(inside)
    rows = rows.withColumns(added)
    rows = rows.withColumns({"__inl": b.in_left, **({"__tl": b.tied_left} if s.rank or s.dense_rank else {})})
    at = lambda values: _at(values, F.col("__pid"))
    before = F.when(F.col("__inl"), at(_longs(scan["rows"]))).otherwise(F.lit(0).cast("bigint"))
    place = F.col("__place") + before
    done = {}
    if s.position:
        done[s.position] = place.cast("bigint")
    if s.rank:
        done[s.rank] = (F.col("__rank") + before - F.when(F.col("__tl"), at(_longs(scan["tied"]))).otherwise(F.lit(0))).cast("bigint")
    if s.dense_rank:
        # the tie of the left border is counted on both sides if it has rows on both
        distinct = [n - (t > 0) for n, t in zip(scan["distinct"], scan["tied"])]
        done[s.dense_rank] = (F.col("__dense") + F.when(F.col("__inl"), at(_longs(distinct))).otherwise(F.lit(0))).cast("bigint")
    for i, name in enumerate(s.running):
        typed = [F.lit(v).cast(kinds[i]) for v in scan[f"s{i}"]]
        here, earlier = F.col(f"__sum{i}"), F.when(F.col("__inl"), at(typed))
        # SUM ignores NULLs and is NULL only while every value so far is NULL.
        done[name] = F.coalesce(here + earlier, here, earlier).cast(kinds[i])
    if s.ntile:
        name, tiles = s.ntile
        chain_size = F.when(F.col("__inl"), at(_longs(scan["size"]))).when(b.in_right, at(_longs([*scan["size"][1:], 0])))
        size = F.coalesce(chain_size, F.col("__count"))
        q, r = F.floor(size / tiles), size % tiles
        big = r * (q + 1)
        tile = F.when(place <= big, F.floor((place - 1) / (q + 1)) + 1).otherwise(r + F.floor((place - big - 1) / F.greatest(q, F.lit(1))) + 1)
        done[name] = tile.cast("bigint")
    rows = rows.withColumns(done)
    if s.lead or s.lag:
        rows = _with_edges(rows, s, b, scan, place)
    extra = [c for c in rows.columns if c.startswith("__") and c not in df.columns and c not in done]
    return rows.drop(*extra, *([] if "__pid" in df.columns else ["__pid"]))


def _with_edges(rows: DataFrame, s: Numbering, b: _Borders, scan: dict[str, list], place: Column) -> DataFrame:
    """LEAD and LAG across borders.

    A neighbour in another partition is among the first or the last ``offset`` rows of
    a border's group there: at most 2 * offset rows a partition, looked up by (group, position).  Both sides
    of the lookup come from the same exchange; their values would agree without that as well.
    """
    at = lambda values: _at(_longs(values), F.col("__pid"))
    most = max(by for _, _, by in [*s.lead, *s.lag])
    rows = rows.withColumns({"__inr": b.in_right, "__all": place})
    rows = rows.withColumn("__chain", F.when(F.col("__inl"), at(scan["chain"])).when(F.col("__inr"), at([*scan["chain"][1:], 0])))
    at_start = F.col("__inl") & (F.col("__place") <= most)
    at_end = F.col("__inr") & (F.col("__place") > at(scan["right"]) - most)
    names = list(dict.fromkeys(c for _, c, _ in [*s.lead, *s.lag]))
    edges = rows.where(at_start | at_end).select(
        F.col("__chain").alias("__e_chain"), F.col("__all").alias("__e_at"), *[F.col(c).alias(f"__e_{c}") for c in names], F.lit(True).alias("__e")
    )
    for k, (name, c, by, local) in enumerate(
        [(n, c, by, f"__lead{k}") for k, (n, c, by) in enumerate(s.lead)] + [(n, c, -by, f"__lag{k}") for k, (n, c, by) in enumerate(s.lag)]
    ):
        off_end = F.col("__inr") & (F.col("__place") + by > at(scan["right"])) if by > 0 else F.col("__inl") & (F.col("__place") + by < 1)
        rows = rows.withColumn("__want", F.when(off_end, F.col("__all") + by))
        found = edges.select(F.col("__e_chain").alias("__f_chain"), F.col("__e_at").alias("__f_at"), F.col(f"__e_{c}").alias(f"__f{k}"))
        on = (F.col("__chain") == F.col("__f_chain")) & (F.col("__want") == F.col("__f_at"))
        # at most 2 * offset rows for each partition
        rows = rows.join(F.broadcast(found), on, "left").drop("__f_chain", "__f_at")
        rows = rows.withColumn(name, F.when(F.col("__want").isNotNull(), F.col(f"__f{k}")).otherwise(F.col(local)))
    return rows


def numbered(df: DataFrame, specs: Sequence[Numbering], *, partitions: int) -> DataFrame:
    """``df`` with the outputs of all specifications."""
    return numbered_and_count(df, specs, partitions=partitions)[0]


def numbered_and_count(df: DataFrame, specs: Sequence[Numbering], *, partitions: int) -> tuple[DataFrame, int]:
    """``numbered`` and the number of rows, which the sampling needs to know anyway."""
    bounds, n = _bounds(df, specs, partitions)
    plans = []
    for s, found in zip(specs, bounds, strict=True):
        plans.append((s, _Borders(s, found, df.schema), _partition(found, s.keys, df.schema)))
    out = df
    for (s, b, pid), totals in zip(plans, _totals(df, plans), strict=True):
        out = _numbered(out, s, b, pid, totals, partitions)
    return out, n


def with_positions(
    df: DataFrame,
    order: Order,
    tiebreak: Sequence[str],
    group: Sequence[str] = (),
    name: str = "pos",
    running: dict[str, Column] | None = None,
    *,
    partitions: int,
) -> DataFrame:
    """Add ``name`` = ROW_NUMBER() within ``group`` in ``order`` (ties broken by
    ``tiebreak``, which must make the order total), and for each
    ``running[out] = value`` a running SUM(value) over ROWS UNBOUNDED PRECEDING.
    """
    values = {f"__v_{out}": value for out, value in (running or {}).items()}
    spec = Numbering(group, order, tiebreak, position=name, running={out: f"__v_{out}" for out in running or {}})
    return numbered(df.withColumns(values) if values else df, [spec], partitions=partitions).drop(*values)


def with_positions_and_count(df: DataFrame, order: Order, tiebreak: Sequence[str], name: str = "pos", *, partitions: int) -> tuple[DataFrame, int]:
    """Global ROW_NUMBER (as ``with_positions`` with no group) and the row count."""
    return numbered_and_count(df, [Numbering((), order, tiebreak, position=name)], partitions=partitions)


def with_ntile(
    df: DataFrame, buckets: int, order: Order, tiebreak: Sequence[str], group: Sequence[str] = (), name: str = "ntile", *, partitions: int
) -> DataFrame:
    """NTILE(buckets): the first (size mod buckets) tiles get one extra row."""
    return numbered(df, [Numbering(group, order, tiebreak, ntile=(name, buckets))], partitions=partitions)


def with_lead_lag(
    df: DataFrame,
    value: str,
    order: Order,
    tiebreak: Sequence[str],
    group: Sequence[str] = (),
    offset: int = 1,
    lead_name: str = "lead",
    lag_name: str = "lag",
    *,
    partitions: int,
) -> DataFrame:
    """LEAD/LAG(value, offset): the value ``offset`` rows after/before, NULL past the ends."""
    spec = Numbering(group, order, tiebreak, lead=[(lead_name, value, offset)], lag=[(lag_name, value, offset)])
    return numbered(df, [spec], partitions=partitions)


def with_rank(
    df: DataFrame,
    order: Order,
    group: Sequence[str] = (),
    rank_name: str | None = "rank",
    dense_name: str | None = "dense_rank",
    tiebreak: Sequence[str] = (),
    *,
    partitions: int,
) -> DataFrame:
    """RANK and DENSE_RANK within ``group`` by any number of sort columns.

    ``tiebreak`` changes no rank: it lets a large tie be spread over partitions.
    """
    spec = Numbering(group, order, tiebreak, rank=rank_name, dense_rank=dense_name)
    return numbered(df, [spec], partitions=partitions)
