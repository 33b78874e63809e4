"""Scalar function families: strings, arrays/structs, dates, math.

Every function is a Spark built-in, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.dates import AS_OF, as_of_date
from quarry.functions.numeric import money
from quarry.plans.registry import query
from quarry.tables import Tables


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def _seg_or_null():
    return F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))

# ---------------------------------------------------------------- strings


@query(
    "str_case",
    # Spark upper-cases with the full Unicode mapping (sharp s -> "SS"); DuckDB
    # maps it to the capital sharp s, so the oracle spells the full mapping out.
    oracle="SELECT doc_id, replace(upper(text), 'ẞ', 'SS') AS text_upper, lower(text) AS text_lower FROM documents",
)
def str_case(spark, sf_dir):
    d = _t(spark, sf_dir).documents
    return d.select("doc_id", F.upper("text").alias("text_upper"), F.lower("text").alias("text_lower"))


@query(
    "str_length",
    oracle="SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars_text, n_chars FROM documents",
)
def str_length(spark, sf_dir):
    d = _t(spark, sf_dir).documents
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars_text"), "n_chars")


@query(
    "str_concat",
    oracle="""
SELECT c_custkey, c_name || ' - ' || nullif(c_mktsegment, 'BUILDING') AS name_segment FROM customer""",
)
def str_concat(spark, sf_dir):
    # CONCAT is NULL as soon as one input is NULL.
    c = _t(spark, sf_dir).customer
    return c.select("c_custkey", F.concat("c_name", F.lit(" - "), _seg_or_null()).alias("name_segment"))


@query(
    "str_concat_ws",
    oracle="""
SELECT c_custkey,
       concat_ws(' | ', c_name, nullif(c_mktsegment, 'BUILDING'), CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)) AS joined
FROM customer""",
)
def str_concat_ws(spark, sf_dir):
    # CONCAT_WS skips NULL inputs.
    c = _t(spark, sf_dir).customer
    return c.select(
        "c_custkey",
        F.concat_ws(" | ", F.col("c_name"), _seg_or_null(), money("c_acctbal").cast("string")).alias("joined"),
    )


@query(
    "str_substring",
    oracle="""
SELECT doc_id, substring(text, 1, 3) AS head3, substring(source, 4, 10) AS source_tail FROM documents""",
)
def str_substring(spark, sf_dir):
    # 1-based positions.
    d = _t(spark, sf_dir).documents
    return d.select(
        "doc_id", F.substring("text", 1, 3).alias("head3"), F.substring("source", 4, 10).alias("source_tail")
    )


@query(
    "str_replace",
    oracle="SELECT doc_id, replace(text, 'the', 'THE') AS replaced FROM documents",
)
def str_replace(spark, sf_dir):
    # Literal replacement of every occurrence.
    d = _t(spark, sf_dir).documents
    return d.select("doc_id", F.replace(F.col("text"), F.lit("the"), F.lit("THE")).alias("replaced"))


@query(
    "str_trim",
    oracle="SELECT c_custkey, trim('  ' || c_name || '  ') AS trimmed FROM customer",
)
def str_trim(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.select("c_custkey", F.trim(F.concat(F.lit("  "), "c_name", F.lit("  "))).alias("trimmed"))


@query(
    "str_lpad",
    oracle="""
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS key6, lpad(CAST(c_custkey AS VARCHAR), 3, '0') AS key3
FROM customer""",
)
def str_lpad(spark, sf_dir):
    # LPAD pads, and cuts longer input to the width.
    c = _t(spark, sf_dir).customer
    k = F.col("c_custkey").cast("string")
    return c.select("c_custkey", F.lpad(k, 6, "0").alias("key6"), F.lpad(k, 3, "0").alias("key3"))


# ---------------------------------------------------------------- arrays / structs


@query(
    "arr_split_explode",
    oracle="""
SELECT lang, word, COUNT(*) AS n
FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY lang, word""",
)
def arr_split_explode(spark, sf_dir):
    """Split whole texts on spaces, one row per token, counted per language."""
    d = _t(spark, sf_dir).documents
    words = d.select("lang", F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "arr_array_struct",
    oracle="""
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, CAST(c_nationkey AS BIGINT) AS nation,
       CAST(2 AS BIGINT) AS n_items
FROM customer""",
)
def arr_array_struct(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    packed = c.select(
        F.struct("c_name", "c_acctbal").alias("s"),
        F.array("c_custkey", F.col("c_nationkey").cast("bigint")).alias("a"),
    )
    return packed.select(
        F.col("a")[0].alias("key"),
        F.col("s.c_name").alias("name"),
        F.col("s.c_acctbal").alias("balance"),
        F.element_at("a", 2).alias("nation"),
        F.size("a").cast("bigint").alias("n_items"),
    )


# ---------------------------------------------------------------- dates


@query(
    "date_parts",
    oracle="""
SELECT o_orderkey,
       CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
       CAST(day(o_orderdate) AS BIGINT) AS d, CAST(quarter(o_orderdate) AS BIGINT) AS q,
       CAST(year(CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE)) AS BIGINT) AS y_from_text
FROM orders""",
)
def date_parts(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")  # parts also read ISO strings
    return o.select(
        "o_orderkey",
        F.year("o_orderdate").cast("bigint").alias("y"),
        F.month("o_orderdate").cast("bigint").alias("m"),
        F.dayofmonth("o_orderdate").cast("bigint").alias("d"),
        F.quarter("o_orderdate").cast("bigint").alias("q"),
        F.year(F.to_date(iso)).cast("bigint").alias("y_from_text"),
    )


@query(
    "date_format",
    oracle="SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day_text FROM orders",
)
def date_format(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day_text"))


@query(
    "date_diff",
    oracle=f"""
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS BIGINT) AS age_days
FROM orders""",
)
def date_diff(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", F.datediff(as_of_date(), F.col("o_orderdate").cast("date")).cast("bigint").alias("age_days"))


@query(
    "date_months_between",
    oracle=f"""
SELECT o_orderkey,
  round(CASE WHEN day(DATE '{AS_OF}') = day(o_orderdate)
              OR (DATE '{AS_OF}' = last_day(DATE '{AS_OF}') AND CAST(o_orderdate AS DATE) = last_day(o_orderdate))
        THEN (12 * (year(DATE '{AS_OF}') - year(o_orderdate)) + month(DATE '{AS_OF}') - month(o_orderdate)) * 1.0
        ELSE (12 * (year(DATE '{AS_OF}') - year(o_orderdate)) + month(DATE '{AS_OF}') - month(o_orderdate))
             + (day(DATE '{AS_OF}') - day(o_orderdate)) / 31.0 END, 8) AS age_months
FROM orders""",
)
def date_months_between(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select(
        "o_orderkey", F.months_between(as_of_date(), F.col("o_orderdate").cast("date")).alias("age_months")
    )


@query(
    "date_add_months",
    oracle="SELECT o_orderkey, CAST(o_orderdate + INTERVAL 12 MONTH AS DATE) AS plus_year, "
    "CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS plus_month FROM orders",
)
def date_add_months(spark, sf_dir):
    # ADD_MONTHS clamps to the last day of a shorter month.
    o = _t(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", F.add_months(d, 12).alias("plus_year"), F.add_months(d, 1).alias("plus_month"))


@query(
    "date_add_days",
    oracle="SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS plus_30, CAST(o_orderdate AS DATE) - 7 AS minus_7 FROM orders",
)
def date_add_days(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", F.date_add(d, 30).alias("plus_30"), F.date_sub(d, 7).alias("minus_7"))


@query("date_last_day", oracle="SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders")
def date_last_day(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", F.last_day(F.col("o_orderdate").cast("date")).alias("month_end"))


@query(
    "date_current",
    oracle=f"""
SELECT c_custkey, DATE '{AS_OF}' AS today, CAST(year(DATE '{AS_OF}') AS BIGINT) AS this_year FROM customer""",
)
def date_current(spark, sf_dir):
    # CURRENT_DATE() made repeatable: the query date is a parameter.
    c = _t(spark, sf_dir).customer
    return c.select("c_custkey", as_of_date().alias("today"), F.year(as_of_date()).cast("bigint").alias("this_year"))


# ---------------------------------------------------------------- math


@query(
    "math_round_arith",
    oracle="""
SELECT c_custkey,
       CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) * 1.1, 1) AS DOUBLE) AS raised_1,
       CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) * 0.15, 2) AS DOUBLE) AS fee_2,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 100 AS DOUBLE) AS plus,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) - 100 AS DOUBLE) AS minus,
       c_acctbal / 4 AS quarter_share
FROM customer""",
)
def math_round_arith(spark, sf_dir):
    # ROUND is HALF_UP on decimals (away from zero for ties).
    c = _t(spark, sf_dir).customer
    m = money("c_acctbal")
    return c.select(
        "c_custkey",
        F.round(m * F.lit(1.1).cast("decimal(2,1)"), 1).cast("double").alias("raised_1"),
        F.round(m * F.lit(0.15).cast("decimal(3,2)"), 2).cast("double").alias("fee_2"),
        (m + 100).cast("double").alias("plus"),
        (m - 100).cast("double").alias("minus"),
        (F.col("c_acctbal") / 4).alias("quarter_share"),
    )
