"""Partition transforms: every pair of transform and predicate prunes folders and returns the same rows as a plain filter."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.operators import transforms as T
from quarry.operators.transforms import Predicate, Transform
from quarry.session import scratch_path
from tests.plan_text import plan_text

SCHEMA = "id long, s string, i int, l long, d date, t timestamp, n timestamp_ntz, m decimal(12,2), b boolean"
EDGE = dt.datetime(2024, 1, 1)


def rows():
    out = [(-1, None, None, None, None, None, None, None, None), (-2, "", 0, 0, dt.date(1969, 12, 31), EDGE, EDGE, Decimal("0.00"), False)]
    for k in range(120):
        at = EDGE + dt.timedelta(hours=7 * k - 300, microseconds=k % 3 - 1)
        text = ["ab", "abc", "b c", "é/x=1", "01", "Zz"][k % 6] + str(k % 4)
        out.append((k, text, k - 60, (k - 60) * 10**15, (EDGE + dt.timedelta(days=9 * k - 400)).date(), at, at, Decimal(k * 37 - 1500) / 100, k % 3 == 0))
    return out


VALUES = {
    "s": ["ab1", "", "é/x=10", "b"], "i": [0, -60, 7], "l": [0, 10**15, -(10**15) - 1], "d": [dt.date(2024, 1, 1), dt.date(2023, 6, 30)],
    "t": [EDGE, EDGE + dt.timedelta(hours=5)], "n": [EDGE, EDGE + dt.timedelta(days=3, microseconds=1)], "m": [Decimal("0.00"), Decimal("-10.01")], "b": [True],
}
CASES = [
    Transform("identity", "s"), Transform("identity", "i"), Transform("identity", "d"), Transform("identity", "m"), Transform("identity", "b"),
    Transform("year", "d"), Transform("year", "t"), Transform("month", "d"), Transform("month", "n"), Transform("day", "t"), Transform("day", "n"),
    Transform("hour", "t"), Transform("hour", "n"), Transform("bucket", "s", 5), Transform("bucket", "l", 4), Transform("bucket", "d", 3),
    Transform("bucket", "m", 3), Transform("truncate", "s", 2), Transform("truncate", "i", 10), Transform("truncate", "l", 7), Transform("truncate", "m", 5),
]


def predicates(column):
    v = VALUES[column]
    yield from [Predicate(column, "is null"), Predicate(column, "is not null"), Predicate(column, "in", v), Predicate(column, "in", [])]
    for x in v:
        yield from [Predicate(column, op, x) for op in ("=", "<", "<=", ">", ">=")]
    yield Predicate(column, "between", (min(v), max(v)))
    yield Predicate(column, "between", (max(v), min(v)))


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(2).cache()


@pytest.mark.parametrize("transform", CASES, ids=lambda t: f"{t.kind}-{t.column}")
def test_every_predicate_prunes_and_returns_the_filter(spark, table, transform):
    layout = T.write_layout(table, scratch_path(spark, "layout"), [transform])
    assert sorted(r.id for r in T.scan(spark, [layout]).collect()) == sorted(r.id for r in table.collect())
    kind = table.schema[transform.column].dataType
    for p in predicates(transform.column):
        got = T.scan(spark, [layout], [p])
        assert got.columns == table.columns
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in table.where(p.on(kind)).collect()), p
        condition = T.projected(p, transform, kind)
        if transform.kind == "bucket" and p.op in ("<", "<=", ">", ">=", "between") or p.op == "is not null" and transform.column == "s" and transform.kind != "bucket":
            assert condition is None
        elif p.value != []:
            plan = plan_text(got)
            assert transform.name in plan.split("PartitionFilters: [")[1].split("]")[0], (p, plan)


def test_strict_bounds_leave_the_next_folder_out(spark, table):
    for transform, p, folders in [
        (Transform("year", "d"), Predicate("d", "<", dt.date(2024, 1, 1)), {1969, 2022, 2023}),
        (Transform("truncate", "i", 10), Predicate("i", "<", -40), {-60, -50}),
    ]:
        kind = table.schema[transform.column].dataType
        derived = table.select(transform.apply(F.col(transform.column), kind).alias(transform.name))
        got = derived.where(T.projected(p, transform, kind)).distinct().collect()
        assert {int(r[0]) for r in got} == folders


def test_one_predicate_for_several_layouts_and_missing_columns(spark, table):
    path = lambda: scratch_path(spark, "layout")
    layouts = [
        T.write_layout(table.where("id < 40"), path(), [Transform("month", "d")]),
        T.write_layout(table.where("id between 40 and 79"), path(), [Transform("truncate", "i", 10), Transform("identity", "s")]),
        T.write_layout(table.where("id >= 80").drop("i"), path(), [Transform("bucket", "s", 3)]),
    ]
    p = [Predicate("i", "<=", 5), Predicate("s", ">=", "ab")]
    got = sorted(r.id for r in T.scan(spark, layouts, p).collect())
    assert got == sorted(r.id for r in table.where("id < 80 and i <= 5 and s >= 'ab'").collect()) and got
    assert T.scan(spark, layouts, [Predicate("i", "is null")]).where("id >= 80").count() == 40


def test_times_are_stored_by_utc_whatever_the_session(spark, table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    layout = T.write_layout(table, scratch_path(spark, "layout"), [Transform("hour", "t")])
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        low = EDGE.replace(tzinfo=dt.timezone.utc)
        got = T.scan(spark, [layout], [Predicate("t", ">=", low)]).count()
        assert got == table.where(F.col("t") >= F.lit(low)).count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_refusals(spark, table):
    for bad in (Transform("hour", "d"), Transform("year", "s"), Transform("bucket", "s"), Transform("truncate", "b", 3), Transform("week", "d")):
        with pytest.raises(ValueError):
            T.write_layout(table, scratch_path(spark, "layout"), [bad])
    with pytest.raises(ValueError, match="operator"):
        Predicate("s", "like", "a%")
    with pytest.raises(ValueError, match="exist"):
        T.write_layout(table.withColumn("d_year", F.lit(1)), scratch_path(spark, "layout"), [Transform("year", "d")])
    with pytest.raises(ValueError, match="layout"):
        T.scan(spark, [])
