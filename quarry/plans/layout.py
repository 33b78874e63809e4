"""Data layout and reuse: repartition, coalesce, partition statistics,
layout advice, caching, and a shuffle-free bucketed join."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quarry.functions.numeric import money_sum
from quarry.operators import catalog as cat
from quarry.operators.layout import layout_advice, rows_per_partition
from quarry.plans.io import partitioned_orders
from quarry.plans.registry import query
from quarry.session import checkpoint_root
from quarry.sources import files
from quarry.tables import Tables


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def shuffle_partitions(spark) -> int:
    """The partition count that the queries ask for: a setting of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("layout_repartition_n", oracle="SELECT * FROM customer")
def layout_repartition_n(spark, sf_dir):
    """Full shuffle into n even partitions; every row is kept."""
    return _t(spark, sf_dir).customer.repartition(shuffle_partitions(spark))


@query(
    "layout_repartition_key",
    oracle="SELECT o_orderpriority, CAST(1 AS BIGINT) AS partitions, COUNT(*) AS rows FROM orders GROUP BY o_orderpriority",
)
def layout_repartition_key(spark, sf_dir):
    """Hash repartition on a key: every key lands in exactly one partition (that
    is what it is for; the library's own writes use REBALANCE, which splits a hot key)."""
    o = _t(spark, sf_dir).orders.repartition(shuffle_partitions(spark), "o_orderpriority")
    return o.withColumn("pid", F.spark_partition_id()).groupBy("o_orderpriority").agg(
        F.count_distinct("pid").alias("partitions"), F.count(F.lit(1)).alias("rows")
    )


@query("layout_coalesce", oracle="SELECT * FROM orders")
def layout_coalesce(spark, sf_dir):
    """Merge partitions without a shuffle (never raises the count): two into one."""
    n = shuffle_partitions(spark)
    return _t(spark, sf_dir).orders.repartition(n).coalesce(max(1, n // 2))


@query("layout_partition_sizes", oracle="SELECT COUNT(*) AS rows, TRUE AS as_requested FROM lineitem")
def layout_partition_sizes(spark, sf_dir):
    """Rows over all Spark partitions, and whether as many as requested hold rows (no Python worker involved)."""
    n = shuffle_partitions(spark)
    sizes = rows_per_partition(_t(spark, sf_dir).lineitem.repartition(n))
    return sizes.agg(F.sum("rows").alias("rows"), (F.count(F.lit(1)) == n).alias("as_requested"))


@query(
    "layout_partition_stats",
    oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, COUNT(*) AS rows,
       COUNT(DISTINCT month(o_orderdate)) AS months, COUNT(DISTINCT o_custkey) AS customers
FROM orders GROUP BY 1""",
)
def layout_partition_stats(spark, sf_dir):
    """Rows and distinct values per partition value of a partitioned data set."""
    df = files.read_partitioned(spark, partitioned_orders(spark, sf_dir))
    return df.groupBy("o_year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("o_month").alias("months"),
        F.count_distinct("o_custkey").alias("customers"),
    )


ADVICE_KEYS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


def _advice_oracle() -> str:
    # two keys, a price and a date of 8 bytes, and the texts
    bytes_ = "SUM(32 + octet_length(encode(o_orderstatus)) + octet_length(encode(o_orderpriority)))"
    parts = []
    for k in ADVICE_KEYS:
        parts.append(
            f"""SELECT '{k}' AS partition_key, COUNT(DISTINCT {k}) AS distinct_values, COUNT(*) AS rows,
       CAST({bytes_} AS DOUBLE) / COUNT(DISTINCT {k}) AS bytes_per_value,
       (SELECT CASE WHEN MAX(n) * 8 > SUM(n) THEN CAST(MAX(n) AS DOUBLE) / SUM(n) END
        FROM (SELECT COUNT(*) AS n FROM orders GROUP BY {k}) g) AS largest_share FROM orders"""
        )
    body = "\nUNION ALL\n".join(parts)
    return f"""
SELECT *, CASE WHEN distinct_values > 10000 THEN 'too many values'
               WHEN bytes_per_value < 134217728 THEN 'partitions too small'
               WHEN bytes_per_value > 1073741824 THEN 'partitions too large'
               WHEN largest_share * rows * bytes_per_value * distinct_values / rows > 1073741824 THEN 'skewed'
               ELSE 'good' END AS verdict
FROM ({body})"""


@query("layout_size_advice", oracle=_advice_oracle())
def layout_size_advice(spark, sf_dir):
    return layout_advice(_t(spark, sf_dir).orders, ADVICE_KEYS)


@query(
    "reuse_cache",
    oracle="""
SELECT 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM lineitem
UNION ALL
SELECT 'revenue', CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem""",
)
def reuse_cache(spark, sf_dir):
    """An input persisted (memory, spilling to disk), used twice and released: the
    two results (one row each) are fixed by a checkpoint before the blocks go."""
    checkpoint_root(spark)
    prices = _t(spark, sf_dir).lineitem.select("l_extendedprice").persist(StorageLevel.MEMORY_AND_DISK)
    a = prices.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("rows").alias("metric"), "value")
    b = prices.agg(money_sum("l_extendedprice").alias("value")).select(F.lit("revenue").alias("metric"), "value")
    try:
        return a.unionByName(b).checkpoint(eager=True)
    finally:
        prices.unpersist()


@query(
    "join_bucketed",
    oracle="""
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""",
)
def join_bucketed(spark, sf_dir):
    """Both sides bucketed by the customer key into the same number of
    buckets: the sort-merge join reads them with no Exchange."""
    t, n = _t(spark, sf_dir), shuffle_partitions(spark)
    c = cat.save_bucketed(t.customer.select("c_custkey", "c_name"), "cust_b", n, "c_custkey", sort_by=["c_custkey"])
    o = cat.save_bucketed(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "ord_b", n, "o_custkey", sort_by=["o_custkey"]
    )
    left, right = spark.table(c), spark.table(o)
    return left.join(right, left.c_custkey == right.o_custkey).select("c_custkey", "c_name", "o_orderkey", "o_totalprice")
