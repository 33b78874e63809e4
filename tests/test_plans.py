"""Plan assertions: pushdown, pruning, join strategies."""

import re

import pytest

from quarry.plans import registry
from tests.plan_text import plan_text


@pytest.fixture(scope="module")
def q():
    return registry.queries()


def test_parquet_filter_pushed(spark, sf_dir, q):
    p = plan_text(q["scan_pushed_filter"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in p


def test_only_selected_columns_read(spark, sf_dir, q):
    p = plan_text(q["scan_pruned_columns"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p


def test_partition_filters(spark, sf_dir, q):
    p = plan_text(q["scan_pruned_partitions"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(o_year" in p and "(o_month" in p


def test_catalog_partition_filters(spark, sf_dir, q):
    p = plan_text(q["scan_catalog_table"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(o_year" in p


def test_csv_filter_pushed(spark, sf_dir, q):
    p = plan_text(q["scan_csv_pushdown"](spark, sf_dir))
    assert "Format: CSV" in p.replace("Scan csv", "Format: CSV") and "GreaterThan(c_acctbal,5000.0)" in p


def test_broadcast_join_for_checked_dimension(spark, sf_dir, q):
    p = plan_text(q["join_broadcast"](spark, sf_dir))
    assert "BroadcastHashJoin" in p


def test_exists_is_semi_and_anti_join(spark, sf_dir, q):
    assert "LeftSemi" in plan_text(q["join_semi_exists"](spark, sf_dir))
    assert "LeftAnti" in plan_text(q["join_anti_not_exists"](spark, sf_dir))


def test_bucketed_join_has_no_exchange(spark, sf_dir, q):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:  # force the sort-merge join the bucketing is for
            spark.conf.set(k, "-1")
        p = plan_text(q["join_bucketed"](spark, sf_dir), executed=True)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in p and "Bucketed: true" in p
    assert "Exchange" not in p


def test_top_k_is_take_ordered(spark, sf_dir, q):
    assert "TakeOrderedAndProject" in plan_text(q["top_k"](spark, sf_dir))


def test_aggregate_has_partial_step(spark, sf_dir, q):
    p = plan_text(q["agg_group_basic"](spark, sf_dir))
    assert "partial_sum" in p and "partial_count" in p


def test_ordered_window_shuffles_once_and_joins_nothing(spark, sf_dir, q):
    # Two specifications: a shuffle by literal bounds each, no copy, no join, no single partition.
    p = plan_text(q["win_running_sum"](spark, sf_dir))
    assert p.count("REPARTITION_BY") == 2 and "Join" not in p and "SinglePartition" not in p
    assert "hashpartitioning" not in p and "rangepartitioning" not in p


def test_sorted_result_comes_in_order(spark, sf_dir, q):
    rows = q["sort_asc_desc"](spark, sf_dir).collect()
    assert [r.pos for r in rows] == list(range(1, len(rows) + 1))
    key = [(r.c_mktsegment, -r.c_acctbal, r.c_custkey) for r in rows]
    assert key == sorted(key) and len(key) > 100


def test_correlated_subquery_is_aggregate_and_join(spark, sf_dir, q):
    p = plan_text(q["subq_correlated"](spark, sf_dir))
    assert "HashAggregate" in p and "LeftSemi" in p
    # The SQL text form is decorrelated by Catalyst the same way: no per-row subquery.
    from quarry.tables import load

    load(spark, sf_dir, "customer").createOrReplaceTempView("customer_corr")
    sql = plan_text(spark.sql(
        "SELECT c1.c_custkey FROM customer_corr c1 WHERE c1.c_acctbal = "
        "(SELECT MAX(c2.c_acctbal) FROM customer_corr c2 WHERE c2.c_nationkey = c1.c_nationkey)"
    ))
    assert "HashAggregate" in sql and "Join" in sql and "Subquery" not in sql
