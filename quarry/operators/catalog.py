"""Catalog operators: databases, tables, partitions, CTAS and INSERT.

Tables are created with an explicit location below the shared checkpoint
folder, so their files live on shared storage whatever the warehouse
setting is; names get a unique suffix because catalog state outlives a
query.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quarry.session import scratch_path
from quarry.sources.files import clustered

_WORK_DB: dict[str, str] = {}


def unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:10]}"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    return name


def work_database(spark: SparkSession) -> str:
    """One scratch database per application."""
    app = spark.sparkContext.applicationId
    if app not in _WORK_DB:
        name = unique("quarry_work")
        _WORK_DB[app] = create_database(spark, name, scratch_path(spark, name))
    return _WORK_DB[app]


def drop_work_database(spark: SparkSession) -> None:
    """Drop this application's scratch database with its managed tables (and
    their files), e.g. once a job's results are written.  The next use
    creates a fresh one."""
    name = _WORK_DB.pop(spark.sparkContext.applicationId, None)
    if name:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def qualified(spark: SparkSession, name: str, database: str | None = None) -> str:
    return f"{database or work_database(spark)}.{unique(name)}"


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
    compression: str | None = None,
    database: str | None = None,
) -> str:
    """``saveAsTable`` with a location in shared storage; returns the full name.

    A partitioned table's rows are clustered first, so that each partition value
    is written by one task (more if it is large) and not by all."""
    spark = df.sparkSession
    full = qualified(spark, name, database)
    if partition_by:
        df = clustered(df, partition_by)
    w = df.write.mode(mode).format(fmt).option("path", scratch_path(spark, full.replace(".", "-")))
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(full)
    return full


def save_bucketed(
    df: DataFrame,
    name: str,
    buckets: int,
    key: str | Sequence[str],
    sort_by: Sequence[str] = (),
    database: str | None = None,
    managed: bool = False,
    dealt: bool = False,
) -> str:
    """Bucketed (and sorted) table: a later join or aggregate on ``key``
    between tables with the same bucket count needs no shuffle.  Rows are dealt
    by bucket first, so that one task writes a bucket and not all of them do.

    ``managed`` tables live in the database's folder (shared storage for the
    work database), so dropping the table or database removes their files.
    ``dealt``: the rows of a bucket are in one partition already.
    """
    spark = df.sparkSession
    full = qualified(spark, name, database)
    keys = [key] if isinstance(key, str) else list(key)
    w = (df if dealt else df.repartition(buckets, *keys)).write.mode("overwrite").format("parquet")
    if not managed:
        w = w.option("path", scratch_path(spark, full.replace(".", "-")))
    w = w.bucketBy(buckets, *keys)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(full)
    return full


def create_table(
    spark: SparkSession,
    full_name: str,
    columns: str,
    partitioned_by: Sequence[str] = (),
    location: str | None = None,
    fmt: str = "PARQUET",
    properties: dict[str, str] | None = None,
) -> str:
    """``CREATE TABLE ... USING fmt [PARTITIONED BY] [LOCATION] [OPTIONS]``."""
    parts = [f"CREATE TABLE {full_name} ({columns}) USING {fmt}"]
    if partitioned_by:
        parts.append(f"PARTITIONED BY ({', '.join(partitioned_by)})")
    if properties:
        opts = ", ".join(f"'{k}' '{v}'" for k, v in properties.items())
        parts.append(f"OPTIONS ({opts})")
    parts.append(f"LOCATION '{location or scratch_path(spark, full_name.replace('.', '-'))}'")
    spark.sql(" ".join(parts))
    return full_name


def repair_partitions(spark: SparkSession, full_name: str) -> None:
    """Register every ``k=v`` folder found under the table location."""
    spark.sql(f"MSCK REPAIR TABLE {full_name}")


def add_partition(spark: SparkSession, full_name: str, spec: dict[str, object], location: str) -> None:
    values = ", ".join(f"{k}={v!r}" if isinstance(v, str) else f"{k}={v}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {full_name} ADD IF NOT EXISTS PARTITION ({values}) LOCATION '{location}'")


def create_table_as(spark: SparkSession, full_name: str, df: DataFrame, fmt: str = "PARQUET", compression: str = "snappy") -> str:
    """CREATE TABLE ... AS SELECT, with the codec as a table option."""
    view = unique("ctas_src")
    df.createOrReplaceTempView(view)
    location = scratch_path(spark, full_name.replace(".", "-"))
    spark.sql(
        f"CREATE TABLE {full_name} USING {fmt} OPTIONS ('compression' '{compression}') "
        f"LOCATION '{location}' AS SELECT * FROM {view}"
    )
    spark.catalog.dropTempView(view)
    return full_name


def insert_select(spark: SparkSession, full_name: str, df: DataFrame) -> None:
    """INSERT INTO ... SELECT, matching columns by name (not position); rows of a
    partitioned table are clustered by its partition columns first."""
    target = spark.table(full_name).columns
    parts = [c.name for c in spark.catalog.listColumns(full_name) if c.isPartition]
    rows = df.select(*target)
    (clustered(rows, parts) if parts else rows).write.insertInto(full_name)


def use_database(spark: SparkSession, name: str) -> str:
    """USE: names without a database mean this one from now on; returns the one before."""
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {name}")
    return before


def list_databases(spark: SparkSession, like: str = "*") -> DataFrame:
    return spark.sql(f"SHOW DATABASES LIKE '{like}'")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")
