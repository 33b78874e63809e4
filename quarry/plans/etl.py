"""ETL queries: mapping, null-field drop, the whole ETL job, schema
discovery with drift, and the incremental (bookmarked) load."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import etl, nested
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import files
from quarry.streaming.incremental import run_incremental
from quarry.tables import Tables

ORDER_MAPPING = [
    ("o_orderkey", "bigint", "order_id", "bigint"),
    ("o_custkey", "bigint", "customer_id", "bigint"),
    ("o_totalprice", "double", "total", "decimal(18,2)"),
    ("o_orderdate", "timestamp_ntz", "order_day", "date"),
    ("o_orderpriority", "string", "priority", "string"),
]

SQL_MAPPED = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
       CAST(o_orderdate AS DATE) AS order_day, o_orderpriority AS priority FROM orders"""


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


@query("etl_apply_mapping", oracle=SQL_MAPPED)
def etl_apply_mapping(spark, sf_dir):
    return etl.apply_mapping(_t(spark, sf_dir).orders, ORDER_MAPPING)


@query(
    "etl_drop_null_fields",
    oracle="SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
)
def etl_drop_null_fields(spark, sf_dir):
    """``refund`` and ``note`` are NULL in every row and are dropped."""
    o = _t(spark, sf_dir).orders.select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_totalprice") < 0, -F.col("o_totalprice")).alias("refund"),
        "o_orderstatus",
        F.nullif(F.col("o_orderstatus"), F.col("o_orderstatus")).alias("note"),
    )
    return etl.drop_null_fields(o)


def etl_job(spark, lines, target: str):
    """Read -> keep positive prices -> total (price x quantity), year, month ->
    mapping -> drop all-NULL fields -> partitioned snappy parquet."""
    price, quantity = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_quantity").cast("decimal(12,2)")
    staged = (
        lines.where(F.col("l_extendedprice") > 0)
        .withColumn("total", (price * quantity).cast("decimal(30,4)"))
        .withColumn("year", F.year("l_shipdate"))
        .withColumn("month", F.month("l_shipdate"))
        .withColumn("refund", F.when(F.col("l_extendedprice") < 0, F.lit(0.0)))
    )
    mapped = etl.apply_mapping(
        staged,
        [
            ("l_orderkey", "bigint", "order_id", "bigint"),
            ("l_linenumber", dict(staged.dtypes)["l_linenumber"], "line", "bigint"),
            ("total", "decimal(30,4)", "total", "double"),
            ("refund", "double", "refund", "double"),
            ("year", "int", "year", "int"),
            ("month", "int", "month", "int"),
        ],
    )
    cleaned = etl.drop_null_fields(mapped)
    files.write_clustered(cleaned, target, ["year", "month"], compression="snappy")
    return files.read_partitioned(spark, target)


@query(
    "etl_job",
    oracle="""
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS total,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem WHERE l_extendedprice > 0""",
)
def etl_job_query(spark, sf_dir):
    return etl_job(spark, _t(spark, sf_dir).lineitem, scratch_path(spark, "etl-job"))


PREVIOUS_EVENT_SCHEMA = [("k", "string"), ("session", "string")]


@query(
    "etl_schema_discovery",
    oracle="""
WITH pairs AS (
  SELECT key AS field, json_extract_string(props, '$."' || key || '"') AS value
  FROM (SELECT props, unnest(json_keys(props)) AS key FROM events)),
votes AS (
  SELECT field, COUNT(*) AS values,
         COUNT(TRY_CAST(value AS BIGINT)) AS n_bigint, COUNT(TRY_CAST(value AS DOUBLE)) AS n_double,
         COUNT(TRY_CAST(value AS BOOLEAN)) AS n_boolean
  FROM pairs WHERE value IS NOT NULL GROUP BY field),
found AS (
  SELECT field, CASE WHEN n_bigint = values THEN 'bigint' WHEN n_double = values THEN 'double'
                     WHEN n_boolean = values THEN 'boolean' ELSE 'string' END AS inferred_type, values
  FROM votes),
prev AS (SELECT * FROM (VALUES ('k', 'string'), ('session', 'string')) p(p_field, previous_type))
SELECT coalesce(field, p_field) AS field, inferred_type, previous_type,
       CASE WHEN p_field IS NULL THEN 'added' WHEN field IS NULL THEN 'removed'
            WHEN inferred_type <> previous_type THEN 'changed' ELSE 'unchanged' END AS change, values
FROM found FULL JOIN prev ON found.field = prev.p_field""",
)
def etl_schema_discovery(spark, sf_dir):
    """Infer the fields of ``events.props`` and compare with the last known
    schema: ``k`` became a bigint, ``session`` is gone."""
    found = etl.infer_json_fields(_t(spark, sf_dir).events, "props")
    return etl.schema_drift(found, etl.previous_schema(spark, PREVIOUS_EVENT_SCHEMA))


PREVIOUS_NESTED_SCHEMA = [("k", "string"), ("who", "struct"), ("who.id", "bigint"), ("marks", "array"), ("marks[]", "bigint"), ("gone", "string")]


@query(
    "etl_schema_discovery_nested",
    oracle="""
WITH n AS (SELECT COUNT(*) AS n, COUNT(json_extract(props, '$.k')) AS k, COUNT(user_id) AS users, COUNT(event_type) AS types,
                  COUNT(value) AS vals, COUNT(*) FILTER (event_id % 2 = 0) AS even FROM events),
found AS (
  SELECT 'k' AS field, 'bigint' AS inferred_type, 'string' AS previous_type, k AS values FROM n
  UNION ALL SELECT 'who', 'struct', 'struct', n FROM n
  UNION ALL SELECT 'who.id', 'bigint', 'bigint', users FROM n
  UNION ALL SELECT 'who.kind', 'string', NULL, types FROM n
  UNION ALL SELECT 'marks', 'array', 'array', n FROM n
  UNION ALL SELECT 'marks[]', 'struct', 'bigint', 2 * n FROM n
  UNION ALL SELECT 'marks[].at', 'bigint', NULL, 2 * n FROM n
  UNION ALL SELECT 'marks[].big', 'boolean', NULL, vals FROM n
  UNION ALL SELECT 'even', 'bigint', NULL, even FROM n
  UNION ALL SELECT 'mixed', 'string', NULL, n FROM n
  UNION ALL SELECT 'gone', NULL, 'string', NULL FROM n)
SELECT field, inferred_type, previous_type, values,
       CASE WHEN inferred_type IS NULL THEN 'removed' WHEN previous_type IS NULL THEN 'added'
            WHEN inferred_type <> previous_type THEN 'changed' ELSE 'unchanged' END AS change
FROM found""",
)
def etl_schema_discovery_nested(spark, sf_dir):
    """Discovery by path over objects in objects and arrays, built from all events: a field that
    half of them have, and one that is a number here and an object there."""
    ev = _t(spark, sf_dir).events
    even = F.col("event_id") % 2 == 0
    k = F.get_json_object("props", "$.k").cast("bigint")
    at = F.col("event_id").cast("bigint")
    marks = F.array(F.struct(at.alias("at"), (F.col("value") > 50).alias("big")), F.struct((at + 1).alias("at"), F.lit(None).cast("boolean").alias("big")))
    known = F.to_json(F.struct(
        k.alias("k"), F.struct(F.col("user_id").cast("bigint").alias("id"), F.col("event_type").alias("kind")).alias("who"),
        marks.alias("marks"), F.when(even, at).alias("even"),
    ))
    mixed = F.when(even, F.concat(F.lit(',"mixed":'), at.cast("string"))).otherwise(F.lit(',"mixed":{"a":1}'))
    text = F.concat(F.regexp_replace(known, "}$", ""), mixed, F.lit("}"))
    found = nested.discover_json(ev.select(text.alias("j")), "j")
    return etl.schema_drift(found, etl.previous_schema(spark, PREVIOUS_NESTED_SCHEMA))


PREVIOUS_CUSTOMER_SCHEMA = [("c_custkey", "int"), ("c_name", "string"), ("c_phone", "string")]


@query(
    "etl_schema_discovery_files",
    oracle="""
SELECT 'c_custkey' AS field, 'bigint' AS inferred_type, 'int' AS previous_type, 'changed' AS change, COUNT(c_custkey) AS values FROM customer
UNION ALL SELECT 'c_name', 'string', 'string', 'unchanged', COUNT(c_name) FROM customer
UNION ALL SELECT 'c_acctbal', 'double', NULL, 'added', COUNT(c_acctbal) FROM customer WHERE NOT coalesce(c_acctbal > 0, false)
UNION ALL SELECT 'c_phone', NULL, 'string', 'removed', NULL""",
)
def etl_schema_discovery_files(spark, sf_dir):
    """Files of two shapes and leftovers of another kind in one folder: the leftovers
    are skipped, the shapes merged and compared with the last known schema."""
    c = _t(spark, sf_dir).customer
    path = scratch_path(spark, "landing")
    files.write(c.where("c_acctbal > 0").select("c_custkey", "c_name"), path)
    files.write(c.where("NOT coalesce(c_acctbal > 0, false)").select("c_custkey", "c_name", "c_acctbal"), path, mode="append")
    files.write(c.select("c_name"), path, "text", mode="append")  # *.txt, not data
    return etl.discover_files(spark, path, PREVIOUS_CUSTOMER_SCHEMA)


@query("etl_incremental", oracle="SELECT * FROM events")
def etl_incremental(spark, sf_dir):
    """Two runs of a bookmarked load: events of days 1-15 land, run; days
    16-31 land, run again -- the second run reads only the new files."""
    ev = _t(spark, sf_dir).events
    root = scratch_path(spark, "incremental")
    landing, sink, ckpt = f"{root}/landing", f"{root}/sink", f"{root}/checkpoint"
    early = F.coalesce(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), F.lit(False))
    first, second = ev.where(early), ev.where(~early)  # events without a time come with the second load
    files.write(first, landing, mode="append")
    run_incremental(spark, landing, sink, ckpt, ev.schema)
    files.write(second, landing, mode="append")
    run_incremental(spark, landing, sink, ckpt, ev.schema)
    return files.read(spark, sink)
