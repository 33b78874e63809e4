"""File readers and writers.

Thin, explicit wrappers over ``DataFrameReader`` / ``DataFrameWriter`` that
fix the options a repeatable job needs: per-write codec and overwrite mode
(never changed on the session), an explicit schema where inference would
cost a second pass, and clustered partitioned writes that stay balanced when
one partition value is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import scratch_path

PARQUET_CODECS = ("none", "snappy", "gzip", "lz4", "lz4_raw", "zstd")
ORC_CODECS = ("none", "zlib", "snappy", "lzo", "lz4", "zstd")
TEXT_CODECS = ("none", "gzip", "bzip2", "deflate", "lz4", "snappy", "zstd")
SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def read(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths if len(paths) > 1 else paths[0])


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    infer_schema: bool = True,
    delimiter: str = ",",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    opts = {"header": str(header).lower(), "delimiter": delimiter}
    if schema is None:
        opts["inferSchema"] = str(infer_schema).lower()
    opts.update(options or {})
    return read(spark, path, "csv", schema, opts)


def read_partitioned(
    spark: SparkSession,
    paths: str | Sequence[str],
    base_path: str | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
    path_glob_filter: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Hive-style ``k=v`` folders become columns.

    Reading a glob or a list of sub-folders keeps those columns only when
    ``base_path`` names the root.
    """
    opts: dict[str, str] = {}
    if base_path:
        opts["basePath"] = base_path
    if merge_schema:
        opts["mergeSchema"] = "true"
    if path_glob_filter:
        opts["pathGlobFilter"] = path_glob_filter
    return read(spark, paths, fmt, schema, opts)


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "error",
    compression: str | None = None,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
    max_records_per_file: int | None = None,
    dynamic_overwrite: bool = False,
) -> str:
    """Write ``df``; codec and overwrite mode are set on this write only."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    w = df.write.format(fmt).mode(mode)
    if compression is not None:
        w = w.option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cluster rows by the partition keys before a partitioned write.

    ``REBALANCE`` hashes on the keys like ``repartition(keys)`` -- so a
    partition value is written by one task into one file -- but lets AQE
    split a value that is larger than the advisory partition size, so a hot
    value is written by several tasks instead of one.
    """
    return df.hint("rebalance", *keys)


def advisory_bytes(spark: SparkSession) -> int:
    """The session's advisory partition size in bytes."""
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m").lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str], **kw) -> str:
    return write(clustered(df, partition_by), path, partition_by=partition_by, **kw)


def with_file_info(df: DataFrame) -> DataFrame:
    """Columns ``file_path`` and ``file_size`` of the file each row came from."""
    return df.withColumn("file_path", F.col("_metadata.file_path")).withColumn(
        "file_size", F.col("_metadata.file_size")
    )


def file_stats(df: DataFrame) -> DataFrame:
    """One row per data file: path, bytes and rows (a distributed aggregate)."""
    return (
        with_file_info(df)
        .groupBy("file_path")
        .agg(F.first("file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )


def format_available(spark: SparkSession, fmt: str) -> bool:
    """Whether a data source is on the class path (avro, for one, is external)."""
    try:
        spark.range(0).write.format(fmt).mode("overwrite").save(scratch_path(spark, f"probe-{fmt}"))
        return True
    except Exception:  # noqa: BLE001 - any failure means "not usable"
        return False
