"""Versioned-data queries over a history of all ``orders``.

Snapshots (number k at 2024-01-01 + k days):
  0 create   1..4 append the orders up to 1995, of 1996, 1997, 1998
  5 delete o_orderstatus = 'F'   6..8 append 1999, 2000, and all later orders
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import history as hist
from quarry.operators.compaction import compact, read_compacted
from quarry.operators.transforms import Layout, Predicate, Transform, scan, write_layout
from quarry.plans.registry import query, range_partitions
from quarry.session import scratch_path
from quarry.sources import files
from quarry.tables import Tables

SQL_SALES = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, CAST(quarter(o_orderdate) AS INTEGER) AS o_quarter FROM orders) s"""


def at(k: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=k)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
        F.quarter("o_orderdate").alias("o_quarter"),
    )


def batch_of(first: int, last: int) -> Column:
    """Number of the batch: one for each year, the first and the last open-ended."""
    year = F.coalesce(F.year("o_orderdate"), F.lit(last))
    return F.greatest(F.least(year, F.lit(last)), F.lit(first)) - first


def new_history(spark, sf_dir) -> hist.History:
    return hist.create(spark, sales(spark, sf_dir).schema, at(0))


def base_history(spark: SparkSession, sf_dir: str) -> hist.History:
    """The history of the module's docstring: two passes over orders, in plain DataFrames."""
    rows = sales(spark, sf_dir)
    early = F.coalesce(F.year("o_orderdate") <= 1998, F.lit(False))
    h = hist.append_batches(new_history(spark, sf_dir), rows.where(early), batch_of(1995, 1998), [at(k) for k in range(1, 5)])
    h = hist.delete_where(h, F.col("o_orderstatus") == "F", at(5))
    return hist.append_batches(h, rows.where(~early), batch_of(1999, 2001), [at(k) for k in range(6, 9)])


SQL_EARLY = "coalesce(year(o_orderdate) <= 1998, false)"
SQL_CURRENT = f"SELECT * FROM {SQL_SALES} WHERE NOT ({SQL_EARLY} AND o_orderstatus IS NOT DISTINCT FROM 'F')"


@query("ver_append", oracle=f"SELECT * FROM {SQL_SALES} WHERE {SQL_EARLY}")
def ver_append(spark, sf_dir):
    """After four appends (snapshot 4) every appended row is visible."""
    return hist.as_of(base_history(spark, sf_dir), 4)


@query("ver_delete_where", oracle=f"SELECT * FROM {SQL_SALES} WHERE {SQL_EARLY} AND o_orderstatus IS DISTINCT FROM 'F'")
def ver_delete_where(spark, sf_dir):
    return hist.as_of(base_history(spark, sf_dir), 5)


@query("ver_scan", oracle=SQL_CURRENT)
def ver_scan(spark, sf_dir):
    return hist.as_of(base_history(spark, sf_dir))


@query("ver_scan_columns", oracle=f"SELECT o_orderkey, o_orderdate, o_totalprice FROM ({SQL_CURRENT})")
def ver_scan_columns(spark, sf_dir):
    return hist.as_of(base_history(spark, sf_dir)).select("o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "ver_scan_filter",
    oracle=f"SELECT * FROM ({SQL_CURRENT}) WHERE o_totalprice > 200000 AND o_orderpriority = '1-URGENT'",
)
def ver_scan_filter(spark, sf_dir):
    return hist.as_of(base_history(spark, sf_dir)).where("o_totalprice > 200000 AND o_orderpriority = '1-URGENT'")


@query("ver_as_of_version", oracle=f"SELECT * FROM {SQL_SALES} WHERE year(o_orderdate) <= 1996")
def ver_as_of_version(spark, sf_dir):
    return hist.as_of(base_history(spark, sf_dir), 2)


@query(
    "ver_as_of_timestamp",
    oracle=f"SELECT * FROM ({SQL_CURRENT}) WHERE year(o_orderdate) <= 1999",
)
def ver_as_of_timestamp(spark, sf_dir):
    """Latest snapshot committed at or before the time: snapshot 6."""
    return hist.as_of_time(base_history(spark, sf_dir), at(6) + dt.timedelta(hours=12))


def _snapshots_oracle() -> str:
    conditions = {1: "year(o_orderdate) <= 1995", 2: "year(o_orderdate) = 1996", 3: "year(o_orderdate) = 1997",
                  4: "year(o_orderdate) = 1998", 6: "year(o_orderdate) = 1999", 7: "year(o_orderdate) = 2000",
                  8: "coalesce(year(o_orderdate) >= 2001, true)"}
    adds = [
        f"SELECT {k} AS snapshot_id, 'append' AS operation, COUNT(*) AS added, CAST(0 AS BIGINT) AS removed FROM {SQL_SALES} WHERE {c}"
        for k, c in conditions.items()
    ]
    adds.append("SELECT 0, 'create', CAST(0 AS BIGINT), CAST(0 AS BIGINT)")
    adds.append(f"SELECT 5, 'delete', CAST(0 AS BIGINT), COUNT(*) FROM {SQL_SALES} WHERE {SQL_EARLY} AND o_orderstatus = 'F'")
    body = "\nUNION ALL\n".join(adds)
    return f"""
SELECT CAST(snapshot_id AS BIGINT) AS snapshot_id, committed_at, operation, added, removed,
       CAST(SUM(added - removed) OVER (ORDER BY snapshot_id) AS BIGINT) AS total
FROM (SELECT u.*, TIMESTAMP '2024-01-01' + INTERVAL (snapshot_id) DAY AS committed_at FROM ({body}) u)"""


@query("ver_snapshots", oracle=_snapshots_oracle())
def ver_snapshots(spark, sf_dir):
    return hist.snapshot_summary(base_history(spark, sf_dir), range_partitions(spark))


@query("ver_overwrite", oracle=f"SELECT * FROM {SQL_SALES} WHERE o_orderstatus IS DISTINCT FROM 'F'")
def ver_overwrite(spark, sf_dir):
    rows = sales(spark, sf_dir)
    h = hist.append(new_history(spark, sf_dir), rows.where("o_orderstatus <=> 'F'"), at(1))
    return hist.as_of(hist.overwrite(h, rows.where("not o_orderstatus <=> 'F'"), at(2)))


@query(
    "ver_add_column",
    oracle=f"""
SELECT *, CASE WHEN year(o_orderdate) > 1998
               THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01 AS DOUBLE) END AS o_discount
FROM {SQL_SALES}""",
)
def ver_add_column(spark, sf_dir):
    """Rows added before the column existed read it as NULL."""
    rows, early = sales(spark, sf_dir), F.coalesce(F.year("o_orderdate") <= 1998, F.lit(False))
    h = hist.append(new_history(spark, sf_dir), rows.where(early), at(1))
    h = hist.add_column(h, "o_discount", "double", at(2))
    discount = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.01).cast("decimal(2,2)")).cast("double")
    return hist.as_of(hist.append(h, rows.where(~early).withColumn("o_discount", discount), at(3)))


@query(
    "ver_rename_column",
    oracle=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority AS priority, o_quarter,
       CASE WHEN year(o_orderdate) > 1998 THEN o_orderstatus END AS o_orderpriority
FROM {SQL_SALES}""",
)
def ver_rename_column(spark, sf_dir):
    """Old rows are read under the new name; a column added under the old name is another one."""
    rows, early = sales(spark, sf_dir), F.coalesce(F.year("o_orderdate") <= 1998, F.lit(False))
    h = hist.append(new_history(spark, sf_dir), rows.where(early), at(1))
    h = hist.rename_column(h, "o_orderpriority", "priority", at(2))
    h = hist.add_column(h, "o_orderpriority", "string", at(3))
    late = rows.where(~early).withColumnRenamed("o_orderpriority", "priority").withColumn("o_orderpriority", F.col("o_orderstatus"))
    return hist.as_of(hist.append(h, late, at(4)))


@query(
    "ver_widen_type",
    oracle=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(o_quarter AS BIGINT) AS o_quarter
FROM {SQL_SALES}""",
)
def ver_widen_type(spark, sf_dir):
    """int -> bigint: rows added as int are read as bigint."""
    rows, early = sales(spark, sf_dir), F.coalesce(F.year("o_orderdate") <= 1998, F.lit(False))
    h = hist.append(new_history(spark, sf_dir), rows.where(early), at(1))
    h = hist.widen_type(h, "o_quarter", "bigint", at(2))
    return hist.as_of(hist.append(h, rows.where(~early), at(3)))


def _expire_oracle() -> str:
    states = {1: "year(o_orderdate) <= 1995", 4: SQL_EARLY, 6: f"coalesce(year(o_orderdate) <= 1999, false) AND NOT ({SQL_EARLY} AND o_orderstatus IS NOT DISTINCT FROM 'F')"}
    return "\nUNION ALL\n".join(f"SELECT CAST({v} AS BIGINT) AS version, s.* FROM {SQL_SALES} WHERE {c}" for v, c in states.items())


@query("ver_expire", oracle=_expire_oracle())
def ver_expire(spark, sf_dir):
    """Snapshots 1, 4 and 6 are retained: each reads as before, and rows that none of them sees are gone."""
    h = hist.expire(base_history(spark, sf_dir), {1, 4, 6})
    states = [hist.as_of(h, v).select(F.lit(v).cast("bigint").alias("version"), "*") for v in (1, 4, 6)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query(
    "ver_hidden_partition",
    oracle=f"SELECT * FROM {SQL_SALES} WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-06-01'",
)
def ver_hidden_partition(spark, sf_dir):
    """Orders by the month of their date; readers filter on the date, and three folders are read."""
    layout = write_layout(sales(spark, sf_dir), scratch_path(spark, "by-month"), [Transform("month", "o_orderdate")])
    return scan(spark, [layout], [Predicate("o_orderdate", ">=", dt.date(1996, 3, 1)), Predicate("o_orderdate", "<", dt.date(1996, 6, 1))])


#: A layout of orders or events by each transform, and a predicate on its source column.
TRANSFORMS = {
    "identity": (Transform("identity", "o_orderstatus"), Predicate("o_orderstatus", "in", ["F", "P"]), "o_orderstatus IN ('F', 'P')"),
    "year": (Transform("year", "o_orderdate"), Predicate("o_orderdate", "<", dt.date(1994, 1, 1)), "o_orderdate < DATE '1994-01-01'"),
    "month": (
        Transform("month", "o_orderdate"), Predicate("o_orderdate", "between", (dt.date(1995, 1, 31), dt.date(1995, 3, 1))),
        "o_orderdate BETWEEN DATE '1995-01-31' AND DATE '1995-03-01'",
    ),
    "bucket": (Transform("bucket", "o_custkey", 16), Predicate("o_custkey", "in", [7, 10, 40, 61]), "o_custkey IN (7, 10, 40, 61)"),
    "truncate_number": (Transform("truncate", "o_custkey", 100), Predicate("o_custkey", ">", 120), "o_custkey > 120"),
    "truncate_text": (Transform("truncate", "o_orderpriority", 1), Predicate("o_orderpriority", "<=", "2-HIGH"), "o_orderpriority <= '2-HIGH'"),
    "day": (
        Transform("day", "ts"), Predicate("ts", ">=", dt.datetime(2024, 1, 30, 12)), "ts >= TIMESTAMP '2024-01-30 12:00:00'",
    ),
    "hour": (
        Transform("hour", "ts"), Predicate("ts", "<", dt.datetime(2024, 1, 2, 3)), "ts < TIMESTAMP '2024-01-02 03:00:00'",
    ),
}


def _transforms_oracle() -> str:
    parts = []
    for name, (t, _, where) in TRANSFORMS.items():
        key, source = ("event_id", "events") if t.column == "ts" else ("o_orderkey", SQL_SALES)
        parts.append(f"SELECT '{name}' AS transform, CAST({key} AS BIGINT) AS id FROM {source} WHERE {where}")
    return "\nUNION ALL\n".join(parts)


@query("ver_partition_transforms", oracle=_transforms_oracle())
def ver_partition_transforms(spark, sf_dir):
    """Each transform once: all rows stored by it, read with a predicate on the source column."""
    orders, events = sales(spark, sf_dir), Tables(spark, sf_dir).events.select("event_id", "ts")
    out = None
    for name, (transform, predicate, _) in TRANSFORMS.items():
        rows, key = (events, "event_id") if transform.column == "ts" else (orders, "o_orderkey")
        layout = write_layout(rows, scratch_path(spark, f"by-{name}"), [transform])
        found = scan(spark, [layout], [predicate]).select(F.lit(name).alias("transform"), F.col(key).cast("bigint").alias("id"))
        out = found if out is None else out.unionByName(found)
    return out


def evolved(spark, sf_dir) -> list[Layout]:
    """Early orders by month, later ones by status and buckets of customers."""
    rows, early = sales(spark, sf_dir), F.coalesce(F.year("o_orderdate") <= 1998, F.lit(False))
    by_status = [Transform("identity", "o_orderstatus"), Transform("bucket", "o_custkey", 4)]
    return [
        write_layout(rows.where(early), scratch_path(spark, "spec-month"), [Transform("month", "o_orderdate")]),
        write_layout(rows.where(~early), scratch_path(spark, "spec-status"), by_status),
    ]


@query("ver_partition_evolution", oracle=f"SELECT * FROM {SQL_SALES}")
def ver_partition_evolution(spark, sf_dir):
    """One scan reads both layouts."""
    return scan(spark, evolved(spark, sf_dir))


@query(
    "ver_partition_evolution_filter",
    oracle=f"SELECT * FROM {SQL_SALES} WHERE o_orderdate >= DATE '1998-11-15' AND o_orderstatus = 'O' AND o_custkey IN (1, 4, 7, 10, 13, 40)",
)
def ver_partition_evolution_filter(spark, sf_dir):
    """One set of predicates, projected onto each layout: by month in one, by status and bucket in the other."""
    predicates = [
        Predicate("o_orderdate", ">=", dt.date(1998, 11, 15)), Predicate("o_orderstatus", "=", "O"),
        Predicate("o_custkey", "in", [1, 4, 7, 10, 13, 40]),
    ]
    return scan(spark, evolved(spark, sf_dir), predicates)


@query("ver_compact", oracle=f"SELECT * FROM {SQL_SALES}")
def ver_compact(spark, sf_dir):
    """One file for each status and year and batch; the small ones are packed within their status and year."""
    small, rows = scratch_path(spark, "many-small"), sales(spark, sf_dir).withColumn("y", F.year("o_orderdate"))
    for part in range(2):
        batch = rows.where(F.pmod(F.col("o_orderkey"), F.lit(2)) == part)
        files.write_clustered(batch, small, ["o_orderstatus", "y"], mode="append")
    table = compact(spark, small, scratch_path(spark, "compacted"), partition_by=["o_orderstatus", "y"], partitions=range_partitions(spark))
    return read_compacted(spark, table).drop("y")
