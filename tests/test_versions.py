"""Versioned data: replay property, delete semantics, time travel edges, schema changes, expiry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators import history as hist
from quarry.plans import versions
from quarry.plans.versions import at, base_history, new_history, sales
from tests.plan_text import plan_text


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_as_of_equals_replay(spark, sf_dir):
    h, rows, year = base_history(spark, sf_dir), sales(spark, sf_dir), F.year("o_orderdate")
    early = rows.where(year <= 1998)
    want = {
        0: rows.limit(0),
        1: rows.where(year <= 1995),
        3: rows.where(year <= 1997),
        4: early,
        5: early.where("o_orderstatus <> 'F'"),
        7: early.where("o_orderstatus <> 'F'").unionByName(rows.where((year > 1998) & (year <= 2000))),
        8: early.where("o_orderstatus <> 'F'").unionByName(rows.where(year > 1998)),
    }
    for version, state in want.items():
        assert _rows(hist.as_of(h, version)) == _rows(state), version
    assert _rows(hist.as_of(h)) == _rows(want[8])


@pytest.fixture
def small(spark):
    h = hist.create(spark, StructType.fromDDL("id long, status string, v int"), at(0))
    batch = spark.createDataFrame([(1, None, 1), (2, "F", 2), (3, "O", None)], "id long, status string, v int")
    return hist.append(h, batch, at(1))


def test_null_predicate_keeps_the_row(small):
    after = hist.delete_where(small, F.col("status") == "F", at(2))
    assert [r.id for r in hist.as_of(after).orderBy("id").collect()] == [1, 3]
    assert hist.as_of(after, 1).count() == 3


def test_time_on_a_commit_is_inclusive(small):
    assert hist.as_of_time(small, at(1)).count() == 3
    assert hist.as_of_time(small, at(1) - dt.timedelta(microseconds=1)).count() == 0
    assert hist.as_of_time(small, at(0) - dt.timedelta(days=1)).count() == 0


def test_snapshot_totals(spark, sf_dir):
    h = base_history(spark, sf_dir)
    for r in hist.snapshot_summary(h, 4).collect():
        assert r.total == hist.as_of(h, r.snapshot_id).count()


def test_overwrite_ends_all_rows(spark, small):
    batch = spark.createDataFrame([(9, "N")], "id long, status string")
    after = hist.overwrite(small, batch, at(2))
    assert [tuple(r) for r in hist.as_of(after).collect()] == [(9, "N", None)]
    assert hist.as_of(after, 1).count() == 3
    assert [r.operation for r in after.snapshots.orderBy("snapshot_id").collect()] == ["create", "append", "overwrite"]


def test_unknown_column_is_refused(spark, small):
    with pytest.raises(ValueError, match="not in the history"):
        hist.append(small, spark.createDataFrame([(1, 2)], "id long, other long"), at(2))
    with pytest.raises(ValueError, match="exists"):
        hist.add_column(small, "v", "int", at(2))
    with pytest.raises(ValueError, match="rename"):
        hist.rename_column(small, "v", "status", at(2))


def test_widening_only(small):
    assert hist.can_widen("int", "bigint") and hist.can_widen("float", "double")
    assert hist.can_widen("decimal(10,2)", "decimal(12,2)") and hist.can_widen("decimal(10,2)", "decimal(12,4)")
    for old, new in (("bigint", "int"), ("double", "float"), ("string", "int"), ("bigint", "double"), ("decimal(10,2)", "decimal(10,4)")):
        assert not hist.can_widen(old, new)
    with pytest.raises(ValueError, match="only widening"):
        hist.widen_type(small, "id", "int", at(2))


def test_two_appends_of_one_state_are_two_histories(spark, small):
    """Histories are values: a second append of the same state does not change the first."""
    one = hist.append(small, spark.createDataFrame([(4, "x", 1)], "id long, status string, v int"), at(2))
    two = hist.append(small, spark.createDataFrame([(5, "y", 1)], "id long, status string, v int"), at(2))
    assert {r.id for r in hist.as_of(one).collect()} == {1, 2, 3, 4}
    assert {r.id for r in hist.as_of(two).collect()} == {1, 2, 3, 5}


def test_expired_rows_are_gone_and_later_states_stay(spark, sf_dir):
    h = base_history(spark, sf_dir)
    kept = hist.expire(h, range(5, 9))
    assert _rows(hist.as_of(kept, 6)) == _rows(hist.as_of(h, 6))
    assert kept.rows.count() < h.rows.count()
    assert min(r.snapshot_id for r in kept.snapshots.collect()) == 5


def test_rows_of_all_years_and_null_dates_are_kept(spark, sf_dir):
    from quarry.plans.versions import batch_of

    odd = sales(spark, sf_dir).limit(1).withColumn("o_orderdate", F.lit(None).cast("date"))
    old = sales(spark, sf_dir).limit(1).withColumn("o_orderdate", F.lit("1901-05-05").cast("date"))
    h = hist.append_batches(new_history(spark, sf_dir), odd.unionByName(old), batch_of(1995, 1998), [at(1), at(2), at(3), at(4)])
    assert hist.as_of(h, 1).count() == 1 and hist.as_of(h).count() == 2


def test_date_condition_prunes_the_hidden_month(spark, sf_dir):
    from quarry.plans.registry import queries

    assert "PartitionFilters: [isnotnull(o_orderdate_month" in plan_text(queries()["ver_hidden_partition"](spark, sf_dir))


@pytest.mark.parametrize("name", ["ver_add_column", "ver_rename_column", "ver_widen_type"])
def test_orders_without_a_date_stay(spark, sf_dir, monkeypatch, name):
    rows = sales(spark, sf_dir).limit(5)
    undated = rows.limit(1).withColumns({"o_orderkey": F.lit(-1).cast("bigint"), "o_orderdate": F.lit(None).cast("date")})
    both = spark.createDataFrame(rows.unionByName(undated).collect(), rows.schema)
    monkeypatch.setattr(versions, "sales", lambda *_: both)
    got = getattr(versions, name)(spark, sf_dir).collect()
    assert len(got) == 6 and [r.o_orderdate for r in got if r.o_orderkey == -1] == [None]


@pytest.mark.parametrize("name", ["ver_overwrite", "ver_scan", "ver_delete_where", "ver_scan_columns", "ver_expire", "ver_compact", "ver_hidden_partition", "ver_partition_evolution"])
def test_orders_without_a_status_or_date_match_the_oracle(spark, sf_dir, monkeypatch, name):
    """The query and its SQL on a table with NULL statuses and dates."""
    import duckdb

    from quarry.plans import registry

    rows = versions.Tables(spark, sf_dir).orders.limit(60)
    none = lambda c, every, of: F.when(F.col("o_orderkey") % every != of, F.col(c)).alias(c)
    odd = rows.withColumns({"o_orderstatus": none("o_orderstatus", 3, 0), "o_orderdate": none("o_orderdate", 4, 1)})
    odd = spark.createDataFrame(odd.collect(), rows.schema)

    class Odd:
        def __init__(self, *_):
            self.orders = odd

    monkeypatch.setattr(versions, "Tables", Odd)
    got = registry.queries()[name](spark, sf_dir)
    con = duckdb.connect()
    con.register("orders", odd.toArrow())
    want = con.sql(registry.oracles()[name])
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    rows_of = lambda found, cols: sorted(([str(r[cols.index(c)]) for c in order] for r in found))
    assert rows_of([tuple(r) for r in got.collect()], got.columns) == rows_of(want.fetchall(), want.columns)


@pytest.mark.parametrize("kept", [{8}, {0}, {2, 6}, {1, 4, 5, 8}, set(range(9))])
def test_expiry_of_any_set_keeps_what_retained_snapshots_see(spark, sf_dir, kept):
    h = base_history(spark, sf_dir)
    after = hist.expire(h, kept)
    for version in kept:
        assert _rows(hist.as_of(after, version)) == _rows(hist.as_of(h, version)), version
    assert {r.snapshot_id for r in after.snapshots.collect()} == kept
    seen = [r for r in h.rows.collect() if any(r[hist.FROM] <= v and (r[hist.TO] is None or r[hist.TO] > v) for v in kept)]
    assert after.rows.count() == len(seen)


def test_expiry_refuses_unknown_snapshots(spark, sf_dir):
    for kept in (set(), {3, 99}, {-1}):
        with pytest.raises(ValueError, match="snapshots"):
            hist.expire(base_history(spark, sf_dir), kept)
