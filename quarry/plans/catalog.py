"""Catalog queries: databases, managed and external partitioned tables,
partition discovery and registration, CTAS and INSERT."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import catalog as cat
from quarry.plans.io import SQL_ORDERS_YM, partitioned_orders
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.tables import Tables

ORDERS_YM_COLUMNS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_year INT, o_month INT"
)


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def external_orders(spark, sf_dir, repair: bool = True) -> str:
    """External table over the ``o_year=/o_month=`` tree of orders."""
    name = cat.qualified(spark, "orders_ext")
    cat.create_table(
        spark, name, ORDERS_YM_COLUMNS, ["o_year", "o_month"], location=partitioned_orders(spark, sf_dir),
        properties={"compression": "snappy"},
    )
    if repair:
        cat.repair_partitions(spark, name)
    return name


@query(
    "scan_catalog_table",
    oracle=f"SELECT {SQL_ORDERS_YM} FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 1",
)
def scan_catalog_table(spark, sf_dir):
    name = external_orders(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {name} WHERE o_year = 1996 AND o_month = 1")


@query(
    "ddl_database",
    oracle="""
SELECT 'customer' AS table_name, TRUE AS listed, COUNT(*) AS rows FROM customer
UNION ALL SELECT 'orders', TRUE, COUNT(*) FROM orders""",
)
def ddl_database(spark, sf_dir):
    """CREATE DATABASE, SHOW DATABASES, USE it, save two tables, list them (SHOW TABLES) with their rows."""
    t = _t(spark, sf_dir)
    db = cat.unique("quarry_db")
    cat.create_database(spark, db, scratch_path(spark, db))
    if cat.list_databases(spark, db).count() != 1:
        raise ValueError(f"{db} is not listed")
    saved = {"customer": cat.save_table(t.customer, "customer", database=db), "orders": cat.save_table(t.orders, "orders", database=db)}
    before = cat.use_database(spark, db)
    try:
        shown = {r["tableName"] for r in cat.list_tables(spark, spark.catalog.currentDatabase()).collect()}
    finally:
        cat.use_database(spark, before)
    parts = []
    for name, full in saved.items():
        listed = F.lit(full.split(".")[1] in shown).alias("listed")
        parts.append(spark.table(full).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), listed, "rows"))
    return parts[0].unionByName(parts[1])


@query("ddl_create_table", oracle="SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def ddl_create_table(spark, sf_dir):
    name = cat.qualified(spark, "customer_by_segment")
    cat.create_table(
        spark, name, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING", ["c_mktsegment"]
    )
    cat.insert_select(spark, name, _t(spark, sf_dir).customer)
    return spark.table(name)


@query("ddl_external_table", oracle=f"SELECT {SQL_ORDERS_YM} FROM orders")
def ddl_external_table(spark, sf_dir):
    return spark.table(external_orders(spark, sf_dir))


@query(
    "ddl_partition_repair",
    oracle="SELECT 'before' AS phase, CAST(0 AS BIGINT) AS rows UNION ALL SELECT 'after', COUNT(*) FROM orders",
)
def ddl_partition_repair(spark, sf_dir):
    """An external table sees no partition until MSCK REPAIR registers them."""
    name = external_orders(spark, sf_dir, repair=False)
    before = spark.table(name).count()
    cat.repair_partitions(spark, name)
    after = spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("after").alias("phase"), "rows")
    return after.unionByName(after.select(F.lit("before").alias("phase"), F.lit(before).cast("bigint").alias("rows")))


@query(
    "ddl_partition_add",
    oracle=f"SELECT {SQL_ORDERS_YM} FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3",
)
def ddl_partition_add(spark, sf_dir):
    """ALTER TABLE ADD PARTITION ... LOCATION: only that partition is visible."""
    name = external_orders(spark, sf_dir, repair=False)
    root = partitioned_orders(spark, sf_dir)
    cat.add_partition(spark, name, {"o_year": 1997, "o_month": 3}, f"{root}/o_year=1997/o_month=3")
    return spark.table(name)


@query(
    "dml_ctas",
    oracle="SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
)
def dml_ctas(spark, sf_dir):
    from quarry.plans.relational import orders_in_year

    name = cat.create_table_as(spark, cat.qualified(spark, "orders_1997"), orders_in_year(_t(spark, sf_dir).orders, 1997))
    return spark.table(name)


@query(
    "dml_insert_select",
    oracle="""
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST(month(l_shipdate) AS INTEGER) AS ship_month
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""",
)
def dml_insert_select(spark, sf_dir):
    """INSERT INTO a partitioned table from a SELECT with a derived total."""
    name = cat.qualified(spark, "revenue_1997")
    cat.create_table(spark, name, "l_orderkey BIGINT, l_linenumber INT, revenue DOUBLE, ship_month INT", ["ship_month"])
    li = _t(spark, sf_dir).lineitem
    lo = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    rows = li.where((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi)).select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(18,2)")))
        .cast("double")
        .alias("revenue"),
        F.month("l_shipdate").alias("ship_month"),
    )
    cat.insert_select(spark, name, rows)
    return spark.table(name)


@query(
    "dml_insert_values",
    oracle="""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), 'N', 10.5), (CAST(-2 AS BIGINT), 'N', 20.25)) v(o_orderkey, o_orderstatus, o_totalprice)""",
)
def dml_insert_values(spark, sf_dir):
    """INSERT INTO ... VALUES appends literal rows to a table built from orders."""
    o = _t(spark, sf_dir).orders
    name = cat.save_table(o.select("o_orderkey", "o_orderstatus", "o_totalprice"), "order_totals")
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'N', 10.5), (-2, 'N', 20.25)")
    return spark.table(name)
