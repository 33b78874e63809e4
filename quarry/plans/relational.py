"""Relational queries: projections, predicates, joins, aggregates, windows,
sort/limit/distinct, set operations, views, subqueries and CTEs.

Employees of the study tables map to ``customer`` (key, name, segment,
balance, nation) and their sales to ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.dates import AS_OF, year_range
from quarry.functions.numeric import MONEY, money, money_avg, money_sum
from quarry.operators import joins, ordered
from quarry.operators.profile import summary_exact
from quarry.plans.registry import query, range_partitions
from quarry.tables import Tables



def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def orders_in_year(orders: DataFrame, year: int) -> DataFrame:
    """Orders of one calendar year; the range predicate reaches the parquet scan."""
    return orders.where(year_range("o_orderdate", year))


SQL_ORDERS_1996 = (
    "o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'"
)

# --------------------------------------------------------------------------
# flagship: two CTEs joined (segment statistics + customers active in 1996)
# --------------------------------------------------------------------------


def segment_activity(customer: DataFrame, orders: DataFrame, year: int = 1996) -> DataFrame:
    seg = customer.groupBy("c_mktsegment").agg(
        money_avg("c_acctbal").alias("avg_segment"), F.count(F.lit(1)).alias("n_segment")
    )
    active = orders_in_year(orders, year).select("o_custkey").distinct()
    with_seg = joins.attach_aggregate(customer, seg, ["c_mktsegment"])
    flagged = joins.left_join_unique(with_seg, active, "c_custkey", "o_custkey")
    return flagged.select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        "avg_segment",
        "n_segment",
        F.when(F.col("o_custkey").isNotNull(), "yes").otherwise("no").alias(f"active_{year}"),
    )


@query(
    "cte_multi",
    oracle=f"""
WITH seg AS (
  SELECT c_mktsegment,
         CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(c_acctbal) AS DOUBLE) AS avg_segment,
         COUNT(*) AS n_segment
  FROM customer GROUP BY c_mktsegment),
active AS (SELECT DISTINCT o_custkey FROM orders WHERE {SQL_ORDERS_1996})
SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, s.avg_segment, s.n_segment,
       CASE WHEN a.o_custkey IS NOT NULL THEN 'yes' ELSE 'no' END AS active_1996
FROM customer c JOIN seg s ON c.c_mktsegment = s.c_mktsegment
LEFT JOIN active a ON c.c_custkey = a.o_custkey
""",
)
def cte_multi(spark, sf_dir):
    t = _t(spark, sf_dir)
    return segment_activity(t.customer, t.orders)


# --------------------------------------------------------------------------
# 2.3 projections, predicates, conditionals
# --------------------------------------------------------------------------


@query("project_columns", oracle="SELECT c_custkey, c_name, c_acctbal FROM customer")
def project_columns(spark, sf_dir):
    return _t(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")


@query(
    "project_expr",
    oracle="""
SELECT c_custkey,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 1.1 AS DOUBLE) AS raised,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS DOUBLE) AS annual
FROM customer""",
)
def project_expr(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.select(
        "c_custkey",
        (money("c_acctbal") * F.lit(1.1).cast("decimal(2,1)")).cast("double").alias("raised"),
        (money("c_acctbal") * 12).cast("double").alias("annual"),
    )


@query(
    "derive_columns",
    oracle=f"""
SELECT *,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS DOUBLE) AS annual,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 0.1 AS DOUBLE) AS bonus,
       upper(c_name) AS name_upper,
       DATE '{AS_OF}' AS as_of
FROM customer""",
)
def derive_columns(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.withColumns(
        {
            "annual": (money("c_acctbal") * 12).cast("double"),
            "bonus": (money("c_acctbal") * F.lit(0.1).cast("decimal(1,1)")).cast("double"),
            "name_upper": F.upper("c_name"),
            "as_of": F.lit(AS_OF).cast("date"),
        }
    )


@query(
    "rename_column",
    oracle="SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def rename_column(spark, sf_dir):
    # Renaming a column that does not exist is a no-op.
    return _t(spark, sf_dir).customer.withColumnRenamed("c_custkey", "customer_id").withColumnRenamed(
        "no_such_column", "x"
    )


@query("drop_column", oracle="SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def drop_column(spark, sf_dir):
    return _t(spark, sf_dir).customer.drop("c_acctbal")


@query("filter_compare", oracle="SELECT * FROM customer WHERE c_acctbal > 5000")
def filter_compare(spark, sf_dir):
    return _t(spark, sf_dir).customer.where(F.col("c_acctbal") > 5000)


@query(
    "filter_conjunction",
    oracle="SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 7000",
)
def filter_conjunction(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") >= 7000))


@query(
    "filter_in_list",
    oracle="SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def filter_in_list(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_name", "c_mktsegment")


@query("filter_between", oracle="SELECT * FROM customer WHERE c_acctbal BETWEEN 5000 AND 7000")
def filter_between(spark, sf_dir):
    return _t(spark, sf_dir).customer.where(F.col("c_acctbal").between(5000, 7000))


@query(
    "filter_not_null",
    oracle=f"""
SELECT c.c_custkey, c.c_name, a.o_custkey AS matched
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE {SQL_ORDERS_1996}) a
  ON c.c_custkey = a.o_custkey
WHERE a.o_custkey IS NOT NULL""",
)
def filter_not_null(spark, sf_dir):
    t = _t(spark, sf_dir)
    active = orders_in_year(t.orders, 1996).select("o_custkey").distinct()
    joined = joins.left_join_unique(t.customer, active, "c_custkey", "o_custkey")
    return joined.where(F.col("o_custkey").isNotNull()).select("c_custkey", "c_name", F.col("o_custkey").alias("matched"))


@query(
    "filter_date_string",
    oracle="SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2000-01-01'",
)
def filter_date_string(spark, sf_dir):
    # An ISO string compared as a real date, not lexically.
    o = _t(spark, sf_dir).orders
    return o.where(F.col("o_orderdate") >= F.to_date(F.lit("2000-01-01"))).select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "case_searched",
    oracle="""
SELECT c_custkey, c_acctbal,
       CASE WHEN c_acctbal < 5000 THEN 'junior' WHEN c_acctbal < 7000 THEN 'mid' ELSE 'senior' END AS tier_chain,
       CASE WHEN c_acctbal < 5000 THEN 'junior' WHEN c_acctbal BETWEEN 5000 AND 7000 THEN 'mid' ELSE 'senior' END AS tier_between
FROM customer""",
)
def case_searched(spark, sf_dir):
    # The two forms differ only at exactly 7000.
    c = _t(spark, sf_dir).customer
    bal = F.col("c_acctbal")
    chain = F.when(bal < 5000, "junior").when(bal < 7000, "mid").otherwise("senior")
    between = F.when(bal < 5000, "junior").when(bal.between(5000, 7000), "mid").otherwise("senior")
    return c.select("c_custkey", "c_acctbal", chain.alias("tier_chain"), between.alias("tier_between"))


@query(
    "case_simple",
    oracle="""
SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'vehicles'
            ELSE c_mktsegment END AS segment_label
FROM customer""",
)
def case_simple(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    seg = F.col("c_mktsegment")
    label = F.when(seg == "BUILDING", "construction").when(seg == "AUTOMOBILE", "vehicles").otherwise(seg)
    return c.select("c_custkey", label.alias("segment_label"))


@query(
    "coalesce_default",
    oracle="""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'no segment') AS segment
FROM customer""",
)
def coalesce_default(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey", F.coalesce(seg, F.lit("no segment")).alias("segment"))


@query(
    "cast_types",
    oracle="""
SELECT o_orderkey,
       CAST(o_orderdate AS DATE) AS order_day,
       CAST(CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS DATE) AS day_from_text,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
       CAST(o_orderkey AS VARCHAR) AS key_text,
       TRY_CAST(o_orderpriority AS BIGINT) AS priority_number
FROM orders""",
)
def cast_types(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    day = F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey",
        day.alias("order_day"),
        day.cast("string").cast("date").alias("day_from_text"),
        money("o_totalprice").cast("string").alias("price_text"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        # dirty input: '1-URGENT' is not a number -> NULL instead of an error
        F.expr("try_cast(o_orderpriority AS BIGINT)").alias("priority_number"),
    )


# --------------------------------------------------------------------------
# 2.4 joins
# --------------------------------------------------------------------------


@query(
    "join_inner",
    oracle="""
SELECT c.c_custkey, c.c_name, c.c_acctbal, n.n_name, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def join_inner(spark, sf_dir):
    t = _t(spark, sf_dir)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    out = t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("c_custkey", "c_name", "c_acctbal", "n_name", "r_name")


def _user_events(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("custkey"), "event_id", "value")


def _customers(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")


@query(
    "join_left",
    oracle="""
SELECT custkey, c.c_name, e.event_id, e.value
FROM (SELECT c_custkey AS custkey, c_name FROM customer) c
LEFT JOIN (SELECT user_id AS custkey, event_id, value FROM events) e USING (custkey)""",
)
def join_left(spark, sf_dir):
    """All customers with their events; most have none."""
    t = _t(spark, sf_dir)
    return joins.skew_join(_customers(t), _user_events(t), "custkey", "left", partitions=range_partitions(spark), right_by=["event_id"])


@query(
    "join_right",
    oracle="""
SELECT custkey, e.event_id, e.value, c.c_name
FROM (SELECT user_id AS custkey, event_id, value FROM events) e
RIGHT JOIN (SELECT c_custkey AS custkey, c_name FROM customer) c USING (custkey)""",
)
def join_right(spark, sf_dir):
    """USING column: on a right join its value comes from the right side."""
    t = _t(spark, sf_dir)
    return joins.skew_join(_user_events(t), _customers(t), "custkey", "right", partitions=range_partitions(spark), left_by=["event_id"])


@query(
    "join_full",
    oracle="""
SELECT doc_id, d.lang, d.source, l.quality, l.toxic
FROM (SELECT doc_id, lang, source FROM documents) d FULL JOIN labels l USING (doc_id)""",
)
def join_full(spark, sf_dir):
    """Documents and labels: documents without a label come with NULLs, and the reverse."""
    t = _t(spark, sf_dir)
    return joins.skew_join(t.documents.select("doc_id", "lang", "source"), t.labels, "doc_id", "full", partitions=range_partitions(spark))


@query(
    "join_broadcast",
    oracle="""
SELECT c.c_custkey, c.c_name, n.n_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def join_broadcast(spark, sf_dir):
    t = _t(spark, sf_dir)
    nation = joins.broadcast_checked(t.nation.select("n_nationkey", "n_name"))
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query(
    "join_on_condition",
    oracle="""
SELECT c.*, o.o_orderkey, o.o_totalprice
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey""",
)
def join_on_condition(spark, sf_dir):
    """ON with two names: the same join after the key is renamed."""
    t = _t(spark, sf_dir)
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    out = joins.skew_join(t.customer, o, "c_custkey", "left", partitions=range_partitions(spark), right_by=["o_orderkey"])
    return out.select(*t.customer.columns, "o_orderkey", "o_totalprice")


@query(
    "join_left_aggregate",
    oracle="""
SELECT c.c_custkey, c.c_name,
       CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_sales,
       COUNT(o.o_orderkey) AS n_sales
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name""",
)
def join_left_aggregate(spark, sf_dir):
    t = _t(spark, sf_dir)
    per_customer = joins.aggregate_then_join(
        t.customer,
        t.orders,
        "c_custkey",
        "o_custkey",
        [F.sum(money("o_totalprice")).alias("__total"), F.count("o_orderkey").alias("__n")],
        how="left",
    )
    return per_customer.select(
        "c_custkey",
        "c_name",
        F.coalesce(F.col("__total"), F.lit(0).cast(MONEY)).cast("double").alias("total_sales"),
        F.coalesce(F.col("__n"), F.lit(0)).alias("n_sales"),
    ).orderBy(F.desc("total_sales"), "c_custkey")


@query(
    "join_inner_aggregate",
    oracle="""
SELECT c.c_custkey, c.c_name, CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name""",
)
def join_inner_aggregate(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = joins.aggregate_then_join(
        t.customer, t.orders, "c_custkey", "o_custkey", [F.sum(money("o_totalprice")).alias("__total")], how="inner"
    )
    return out.select("c_custkey", "c_name", F.col("__total").cast("double").alias("total_sales"))


@query(
    "join_semi_exists",
    oracle="""
SELECT c.c_custkey, c.c_name, c.c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""",
)
def join_semi_exists(spark, sf_dir):
    t = _t(spark, sf_dir)
    return joins.exists_join(t.customer, t.events, "c_custkey", "user_id").select("c_custkey", "c_name", "c_mktsegment")


@query(
    "join_anti_not_exists",
    oracle="""
SELECT c.c_custkey, c.c_name, c.c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""",
)
def join_anti_not_exists(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = joins.exists_join(t.customer, t.events, "c_custkey", "user_id", negate=True)
    return out.select("c_custkey", "c_name", "c_mktsegment")


# --------------------------------------------------------------------------
# 2.5 aggregations and profiling
# --------------------------------------------------------------------------

_SQL_MONEY_SUM = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"
_SQL_MONEY_AVG = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)"


@query(
    "agg_group_basic",
    oracle=f"""
SELECT c_mktsegment, COUNT(*) AS n, {_SQL_MONEY_SUM.format(c='c_acctbal')} AS total,
       {_SQL_MONEY_AVG.format(c='c_acctbal')} AS average, MIN(c_acctbal) AS lowest, MAX(c_acctbal) AS highest
FROM customer GROUP BY c_mktsegment""",
)
def agg_group_basic(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        money_sum("c_acctbal").alias("total"),
        money_avg("c_acctbal").alias("average"),
        F.min("c_acctbal").alias("lowest"),
        F.max("c_acctbal").alias("highest"),
    )


@query(
    "agg_having_stddev",
    oracle=f"""
SELECT c_nationkey, COUNT(*) AS n, {_SQL_MONEY_SUM.format(c='c_acctbal')} AS total,
       {_SQL_MONEY_AVG.format(c='c_acctbal')} AS average, MIN(c_acctbal) AS lowest, MAX(c_acctbal) AS highest,
       ROUND(STDDEV_SAMP(c_acctbal), 2) AS stddev
FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 1""",
)
def agg_having_stddev(spark, sf_dir):
    out = _t(spark, sf_dir).customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"),
        money_sum("c_acctbal").alias("total"),
        money_avg("c_acctbal").alias("average"),
        F.min("c_acctbal").alias("lowest"),
        F.max("c_acctbal").alias("highest"),
        F.round(F.stddev_samp("c_acctbal"), 2).alias("stddev"),
    )
    return out.where(F.col("n") > 1).orderBy(F.desc("average"))


@query(
    "agg_count_distinct",
    oracle="""
SELECT c_mktsegment, COUNT(DISTINCT c_nationkey) AS nations, COUNT(DISTINCT c_name) AS names
FROM customer GROUP BY c_mktsegment""",
)
def agg_count_distinct(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.groupBy("c_mktsegment").agg(
        F.count_distinct("c_nationkey").alias("nations"), F.count_distinct("c_name").alias("names")
    )


@query(
    "agg_ratio",
    oracle="""
SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS per_order
FROM orders GROUP BY o_orderpriority""",
)
def agg_ratio(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.groupBy("o_orderpriority").agg(
        (F.sum(money("o_totalprice")).cast("double") / F.count(F.lit(1)).cast("double")).alias("per_order")
    )


@query("agg_group_count", oracle='SELECT o_orderstatus, COUNT(*) AS "count" FROM orders GROUP BY o_orderstatus')
def agg_group_count(spark, sf_dir):
    return _t(spark, sf_dir).orders.groupBy("o_orderstatus").count()


def top_products(lineitem: DataFrame, part: DataFrame, year: int, k: int = 10) -> DataFrame:
    """Top-k product names by revenue in one ship year.

    Line items are summed per part key first (partial aggregation handles hot
    parts), joined to ``part`` for the name, summed again per name, and the
    k largest are kept with TakeOrderedAndProject.
    """
    lo = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    items = lineitem.where((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi))
    per_part = items.groupBy("l_partkey").agg(
        F.sum(money("l_extendedprice")).alias("revenue"), F.count(F.lit(1)).alias("lines")
    )
    named = per_part.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    per_name = named.groupBy("p_name").agg(
        F.sum("revenue").cast("double").alias("revenue"), F.sum("lines").alias("lines")
    )
    return per_name.orderBy(F.desc("revenue"), "p_name").limit(k)


@query(
    "agg_top_products",
    oracle="""
SELECT p.p_name, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, COUNT(*) AS lines
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_shipdate >= TIMESTAMP '1997-01-01' AND l.l_shipdate < TIMESTAMP '1998-01-01'
GROUP BY p.p_name ORDER BY revenue DESC, p.p_name LIMIT 10""",
)
def agg_top_products(spark, sf_dir):
    t = _t(spark, sf_dir)
    return top_products(t.lineitem, t.part, 1997)


@query(
    "agg_monthly_sales",
    oracle="""
SELECT CAST(year(l_shipdate) AS BIGINT) AS ship_year, CAST(month(l_shipdate) AS BIGINT) AS ship_month,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, COUNT(*) AS lines
FROM lineitem GROUP BY 1, 2""",
)
def agg_monthly_sales(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    return (
        li.groupBy(
            F.year("l_shipdate").cast("bigint").alias("ship_year"),
            F.month("l_shipdate").cast("bigint").alias("ship_month"),
        )
        .agg(money_sum("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("lines"))
        .orderBy("ship_year", "ship_month")
    )


@query(
    "agg_month_cumulative",
    oracle="""
WITH m AS (
  SELECT p.p_type, CAST(month(l.l_shipdate) AS BIGINT) AS ship_month,
         SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS revenue
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2)
SELECT p_type, ship_month, CAST(revenue AS DOUBLE) AS revenue,
       CAST(SUM(revenue) OVER (PARTITION BY p_type ORDER BY ship_month) AS DOUBLE) AS cumulative
FROM m""",
)
def agg_month_cumulative(spark, sf_dir):
    """SUM(SUM(v)) OVER (PARTITION BY type ORDER BY month): aggregate, then a
    running total over the (type, month) rows.

    The window runs on the aggregate, where a type holds at most 12 rows (one
    per month of the year), whatever the data size.  So a plain window
    partitioned by type is bounded per task and needs no hot-group handling.
    """
    t = _t(spark, sf_dir)
    per_part = t.lineitem.groupBy("l_partkey", F.month("l_shipdate").cast("bigint").alias("ship_month")).agg(
        F.sum(money("l_extendedprice")).alias("revenue")
    )
    typed = per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    monthly = typed.groupBy("p_type", "ship_month").agg(F.sum("revenue").alias("revenue"))
    # (type, month) is unique, so the running ROWS total equals the default RANGE frame.
    by_month = Window.partitionBy("p_type").orderBy("ship_month").rowsBetween(Window.unboundedPreceding, 0)
    out = monthly.withColumn("cumulative", F.sum("revenue").over(by_month))
    return out.select(
        "p_type", "ship_month", F.col("revenue").cast("double").alias("revenue"), F.col("cumulative").cast("double").alias("cumulative")
    )


@query(
    "agg_global_avg",
    oracle=f"SELECT {_SQL_MONEY_AVG.format(c='c_acctbal')} AS avg_balance FROM customer",
)
def agg_global_avg(spark, sf_dir):
    return _t(spark, sf_dir).customer.agg(money_avg("c_acctbal").alias("avg_balance"))


def describe_typed(df: DataFrame, *cols: str, stats: tuple[str, ...] = ("count", "mean", "stddev", "min", "max")) -> DataFrame:
    """``df.summary(stats)`` reshaped to one typed row per column.

    The string table of summary()/describe() has one row per statistic; it is
    unpivoted and pivoted on the statistic names (a handful of rows).
    """
    raw = df.select(*cols).summary(*stats)
    long = raw.unpivot("summary", list(cols), "column_name", "value")
    wide = long.groupBy("column_name").pivot("summary", list(stats)).agg(F.first("value"))
    typed = [F.col("column_name")]
    for s in stats:
        name = {"25%": "p25", "50%": "p50", "75%": "p75"}.get(s, s)
        raw_col = F.col(f"`{s}`")
        if s == "count":
            typed.append(raw_col.cast("bigint").alias(name))
        elif s in ("mean", "stddev"):
            typed.append(F.round(raw_col.cast("double"), 6).alias(name))
        else:
            typed.append(raw_col.cast("double").alias(name))
    out = wide.select(*typed)
    return out


@query(
    "profile_describe",
    oracle="""
SELECT 'c_acctbal' AS column_name, COUNT(c_acctbal) AS count, ROUND(AVG(c_acctbal), 6) AS mean,
       ROUND(STDDEV_SAMP(c_acctbal), 6) AS stddev, MIN(c_acctbal) AS min, MAX(c_acctbal) AS max FROM customer
UNION ALL
SELECT 'c_nationkey', COUNT(c_nationkey), ROUND(AVG(c_nationkey), 6), ROUND(STDDEV_SAMP(c_nationkey), 6),
       CAST(MIN(c_nationkey) AS DOUBLE), CAST(MAX(c_nationkey) AS DOUBLE) FROM customer""",
)
def profile_describe(spark, sf_dir):
    return describe_typed(_t(spark, sf_dir).customer, "c_acctbal", "c_nationkey")


def _summary_oracle() -> str:
    numeric = """SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min,
       CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75, CAST(MAX({c}) AS DOUBLE) AS max,
       NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM customer"""
    none = ", ".join(f"NULL::DOUBLE AS {c}" for c in ("mean", "stddev", "min", "p25", "p50", "p75", "max"))
    text = "SELECT '{c}' AS column_name, COUNT({c}) AS count, " + none + ", MIN({c}) AS min_text, MAX({c}) AS max_text FROM customer"
    parts = [numeric.format(c=c) for c in ("c_custkey", "c_nationkey", "c_acctbal")]
    parts += [text.format(c=c) for c in ("c_name", "c_mktsegment")]
    return "\nUNION ALL\n".join(parts)


@query("profile_summary", oracle=_summary_oracle())
def profile_summary(spark, sf_dir):
    """summary() of all columns: describe() plus the 25/50/75 % quantiles -- exact
    here, narrowed down by sketches and counts of all columns together (no sort)."""
    return summary_exact(_t(spark, sf_dir).customer)


@query("action_count", oracle="SELECT COUNT(*) AS n FROM lineitem")
def action_count(spark, sf_dir):
    return _t(spark, sf_dir).lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("action_take", oracle="SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def action_take(spark, sf_dir):
    # take(n) has no defined order without a sort; fix it.
    return _t(spark, sf_dir).orders.orderBy("o_orderkey").limit(5)


# --------------------------------------------------------------------------
# 2.6 window functions (hot-group safe forms from quarry.operators.ordered)
# --------------------------------------------------------------------------

@query(
    "win_rank",
    oracle="""
SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
       CAST(RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS BIGINT) AS rank
FROM customer""",
)
def win_rank(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return ordered.with_rank(
        c, [("c_acctbal", True)], ["c_mktsegment"], dense_name=None, tiebreak=["c_custkey"], partitions=range_partitions(spark)
    )


@query(
    "win_dense_rank",
    oracle="""
SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
       CAST(DENSE_RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS BIGINT) AS dense_rank
FROM customer""",
)
def win_dense_rank(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return ordered.with_rank(
        c, [("c_acctbal", True)], ["c_mktsegment"], rank_name=None, tiebreak=["c_custkey"], partitions=range_partitions(spark)
    )


@query(
    "win_row_number",
    oracle="""
SELECT c_custkey, c_mktsegment, c_acctbal,
       CAST(ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS row_number
FROM customer""",
)
def win_row_number(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return ordered.with_positions(c, [("c_acctbal", True)], ["c_custkey"], ["c_mktsegment"], name="row_number", partitions=range_partitions(spark))


@query(
    "win_lead_lag",
    oracle="""
SELECT c_custkey, c_acctbal,
       LEAD(c_acctbal, 1) OVER (ORDER BY c_acctbal, c_custkey) AS next_balance,
       LAG(c_acctbal, 1) OVER (ORDER BY c_acctbal, c_custkey) AS previous_balance
FROM customer""",
)
def win_lead_lag(spark, sf_dir):
    # A global order: neighbours across the borders of range partitions are looked up by position.
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    return ordered.with_lead_lag(
        c, "c_acctbal", ["c_acctbal"], ["c_custkey"], lead_name="next_balance", lag_name="previous_balance",
        partitions=range_partitions(spark),
    )


@query(
    "win_running_sum",
    oracle="""
SELECT o_orderkey, o_custkey, o_orderdate,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_customer
FROM orders""",
)
def win_running_sum(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    o = o.withColumn("__amount", money("o_totalprice"))
    specs = [
        ordered.Numbering((), ["o_orderdate"], ["o_orderkey"], running={"running_total": "__amount"}),
        ordered.Numbering(["o_custkey"], ["o_orderdate"], ["o_orderkey"], running={"running_customer": "__amount"}),
    ]
    per = ordered.numbered(o, specs, partitions=range_partitions(spark))
    return per.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.col("running_total").cast("double").alias("running_total"),
        F.col("running_customer").cast("double").alias("running_customer"),
    )


@query(
    "win_partition_aggregate",
    oracle=f"""
SELECT c_custkey, c_mktsegment, c_acctbal,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_mktsegment) AS DOUBLE) AS segment_total,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_mktsegment) AS DOUBLE)
         / CAST(COUNT(c_acctbal) OVER (PARTITION BY c_mktsegment) AS DOUBLE) AS segment_avg,
       c_acctbal - CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_mktsegment) AS DOUBLE)
         / CAST(COUNT(c_acctbal) OVER (PARTITION BY c_mktsegment) AS DOUBLE) AS deviation
FROM customer""",
)
def win_partition_aggregate(spark, sf_dir):
    """Aggregate over the whole partition = group aggregate joined back on the key."""
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    stats = c.groupBy("c_mktsegment").agg(
        money_sum("c_acctbal").alias("segment_total"), money_avg("c_acctbal").alias("segment_avg")
    )
    out = joins.attach_aggregate(c, stats, ["c_mktsegment"])
    return out.withColumn("deviation", F.col("c_acctbal") - F.col("segment_avg"))


def first_by_group(df: DataFrame, group: str, value: str, order: str, key: str, name: str) -> DataFrame:
    """(group, ``name``): the ``value`` of the row that is first by ``order`` descending (NULLs last), then ``key``."""
    rank = F.struct(F.col(order).isNull().alias("n"), (-F.col(order)).alias("b"), F.col(key).alias("k"))
    # packed, so that a NULL value of the first row is not passed over
    return df.groupBy(group).agg(F.min_by(F.struct(value), rank).alias("__f")).select(group, F.col("__f")[value].alias(name))


@query(
    "win_first_value",
    oracle="""
SELECT c_custkey, c_mktsegment,
       FIRST_VALUE(c_name) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS top_name
FROM customer""",
)
def win_first_value(spark, sf_dir):
    """FIRST_VALUE over a whole group = min_by aggregate joined back.

    ORDER BY ... DESC puts NULLs last, a struct compares them first: a flag in front makes up for it."""
    c = _t(spark, sf_dir).customer
    top = first_by_group(c, "c_mktsegment", "c_name", "c_acctbal", "c_custkey", "top_name")
    return joins.attach_aggregate(c.select("c_custkey", "c_mktsegment"), top, ["c_mktsegment"])


@query(
    "win_ntile",
    oracle="""
SELECT c_custkey, c_acctbal, CAST(NTILE(4) OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS quartile
FROM customer""",
)
def win_ntile(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    return ordered.with_ntile(c, 4, ["c_acctbal"], ["c_custkey"], name="quartile", partitions=range_partitions(spark))


@query(
    "win_rank_over_aggregate",
    oracle=f"""
SELECT c_mktsegment, {_SQL_MONEY_AVG.format(c='c_acctbal')} AS avg_balance,
       CAST(RANK() OVER (ORDER BY {_SQL_MONEY_AVG.format(c='c_acctbal')} DESC) AS BIGINT) AS rank
FROM customer GROUP BY c_mktsegment""",
)
def win_rank_over_aggregate(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    avg = c.groupBy("c_mktsegment").agg(money_avg("c_acctbal").alias("avg_balance"))
    return ordered.with_rank(avg, [("avg_balance", True)], dense_name=None, partitions=range_partitions(spark))


# --------------------------------------------------------------------------
# 2.7 sort, limit, distinct
# --------------------------------------------------------------------------


@query(
    "sort_asc_desc",
    oracle="""
SELECT c_custkey, c_mktsegment, c_acctbal,
       CAST(ROW_NUMBER() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS BIGINT) AS pos
FROM customer""",
)
def sort_asc_desc(spark, sf_dir):
    """Sort on two keys of mixed direction; the rows come in that order, ``pos`` is each row's place in it."""
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    order = ["c_mktsegment", ("c_acctbal", True)]
    return ordered.with_positions(c, order, ["c_custkey"], name="pos", partitions=range_partitions(spark)).orderBy("pos")


@query("limit_rows", oracle="SELECT * FROM customer ORDER BY c_custkey LIMIT 100")
def limit_rows(spark, sf_dir):
    return _t(spark, sf_dir).customer.orderBy("c_custkey").limit(100)


@query(
    "top_k",
    oracle="SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
)
def top_k(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)


@query("distinct_rows", oracle="SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_rows(spark, sf_dir):
    return _t(spark, sf_dir).customer.select("c_mktsegment", "c_nationkey").distinct()


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the largest ``order`` (then the other
    columns).  A max over a struct is an aggregate with a map-side partial
    step, so a hot key never reaches one task whole."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("__m")
    return df.groupBy(*keys).agg(F.max(packed).alias("__m")).select(*keys, "__m.*")


@query(
    "dedup_by_key",
    oracle="""
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""",
)
def dedup_by_key(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# --------------------------------------------------------------------------
# 2.8 set operations
# --------------------------------------------------------------------------


@query(
    "set_union_all",
    oracle="""
SELECT c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT c_name, c_mktsegment FROM customer WHERE c_acctbal > 6000""",
)
def set_union_all(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    a = c.where(F.col("c_mktsegment") == "BUILDING").select("c_name", "c_mktsegment")
    b = c.where(F.col("c_acctbal") > 6000).select("c_name", "c_mktsegment")
    return a.union(b)


@query(
    "set_union_by_name",
    oracle="""
SELECT c_custkey AS key, c_name AS name, NULL::VARCHAR AS status FROM customer
UNION ALL
SELECT o_orderkey AS key, NULL::VARCHAR AS name, o_orderstatus AS status FROM orders""",
)
def set_union_by_name(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"))
    b = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"))
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "set_intersect",
    oracle="""
SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'
INTERSECT
SELECT c_nationkey FROM customer WHERE c_acctbal > 9900""",
)
def set_intersect(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    a = c.where(F.col("c_mktsegment") == "BUILDING").select("c_nationkey")
    b = c.where(F.col("c_acctbal") > 9900).select("c_nationkey")
    return a.intersect(b)


@query(
    "set_except",
    oracle="""
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
EXCEPT
SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def set_except(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    a = o.where(F.col("o_orderstatus") == "F").select("o_custkey")
    b = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return a.subtract(b)


# --------------------------------------------------------------------------
# 2.10 views, subqueries, CTEs
# --------------------------------------------------------------------------


@query(
    "view_temp",
    oracle="SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY c_mktsegment",
)
def view_temp(spark, sf_dir):
    _t(spark, sf_dir).customer.createOrReplaceTempView("q_customer")
    return spark.sql("SELECT c_mktsegment, COUNT(*) AS n FROM q_customer GROUP BY c_mktsegment")


@query("view_global", oracle="SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def view_global(spark, sf_dir):
    # A global temp view is visible from another session of the same application.
    _t(spark, sf_dir).orders.createOrReplaceGlobalTempView("q_orders")
    other = spark.newSession()
    return other.sql("SELECT o_orderstatus, COUNT(*) AS n FROM global_temp.q_orders GROUP BY o_orderstatus")


@query(
    "subq_scalar",
    oracle=f"""
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_acctbal > (SELECT {_SQL_MONEY_AVG.format(c='c_acctbal')} FROM customer)""",
)
def subq_scalar(spark, sf_dir):
    """Uncorrelated scalar subquery: evaluated once, then a plain filter."""
    c = _t(spark, sf_dir).customer
    avg = c.select(money_avg("c_acctbal"))
    return c.where(F.col("c_acctbal") > avg.scalar()).select("c_custkey", "c_name", "c_acctbal")


@query(
    "subq_from",
    oracle=f"""
SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, s.avg_segment
FROM customer c JOIN (
  SELECT c_mktsegment, {_SQL_MONEY_AVG.format(c='c_acctbal')} AS avg_segment FROM customer GROUP BY c_mktsegment
) s ON c.c_mktsegment = s.c_mktsegment
WHERE c.c_acctbal > s.avg_segment""",
)
def subq_from(spark, sf_dir):
    _t(spark, sf_dir).customer.createOrReplaceTempView("q_customer")
    return spark.sql(
        """
        SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, s.avg_segment
        FROM q_customer c JOIN (
          SELECT c_mktsegment,
                 CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(c_acctbal) AS DOUBLE) AS avg_segment
          FROM q_customer GROUP BY c_mktsegment
        ) s ON c.c_mktsegment = s.c_mktsegment
        WHERE c.c_acctbal > s.avg_segment
        """
    )


@query(
    "subq_correlated",
    oracle="""
SELECT c1.c_custkey, c1.c_name, c1.c_nationkey, c1.c_acctbal FROM customer c1
WHERE c1.c_acctbal = (SELECT MAX(c2.c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c1.c_nationkey)""",
)
def subq_correlated(spark, sf_dir):
    """Rows equal to their group's maximum (ties all kept).

    Joined on (group, value) rather than on the group alone, so a large
    group does not make a hot join key."""
    c = _t(spark, sf_dir).customer
    top = c.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("c_acctbal"))
    return c.join(top, ["c_nationkey", "c_acctbal"], "left_semi").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
