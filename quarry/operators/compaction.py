"""Compaction by bin-packing: small files are put together, large ones are left alone.

File sizes come from the rows' ``_metadata``, so the listing is a distributed
aggregate.  Within each partition value the files below the target are laid end
to end by running sums of their bytes (the window layer, no group in one task); the file's bin is the
number of whole targets before it.  So a bin holds files that begin in one stretch of target bytes: less
than twice the target in all.  Bins of one file stay as they are.  The rows of each other
bin are written by one task into one file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators import ordered
from quarry.session import scratch_path
from quarry.sources import files


@dataclass(frozen=True)
class Compacted:
    """A compacted table: files of ``source`` that stay, and the folder of the packed ones (None if nothing was packed)."""

    source: str
    untouched: list[str]
    packed: str | None
    fmt: str
    schema: StructType


def data_files(spark: SparkSession, source: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """(file, bytes, partition columns) of the non-empty files below ``source``; no data column is read."""
    rows = files.read(spark, source, fmt)
    meta = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *partition_by)
    return meta.groupBy("file").agg(F.first("bytes").alias("bytes"), *[F.first(c).alias(c) for c in partition_by])


def bins(listing: DataFrame, target_bytes: int, partition_by: Sequence[str] = (), *, partitions: int) -> DataFrame:
    """(file, bytes, partition columns, bin) of the files to pack: bins 0, 1, ... of two files or more."""
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    small = listing.where(F.col("bytes") < target_bytes)
    laid = ordered.with_positions(small, [], ["file"], list(partition_by), name="__n", running={"upto": F.col("bytes")}, partitions=partitions)
    laid = laid.withColumn("slot", F.floor((F.col("upto") - F.col("bytes")) / F.lit(target_bytes)))
    key = [*partition_by, "slot"]
    many = laid.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("first")).where("n > 1")
    numbered = ordered.with_positions(many, [], ["first"], name="bin", partitions=partitions)
    numbered = numbered.select(*key, (F.col("bin") - 1).cast("int").alias("bin"))
    return ordered.join_null_safe(laid, numbered, key).select("file", "bytes", *partition_by, "bin")


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    *,
    partitions: int,
) -> Compacted:
    """Pack the small files of ``source`` into files of about ``target_bytes`` (the advisory size unless given) below ``target``.

    ``source`` is not changed: a reader takes the untouched files and the packed ones
    (``read_compacted``), and whoever owns the table may drop the rest.  The list of untouched
    files passes the driver, like the file index of any scan of them.
    """
    listing = data_files(spark, source, partition_by, fmt)
    found = bins(listing, target_bytes or files.advisory_bytes(spark), partition_by, partitions=partitions)
    path = scratch_path(spark, "bins")
    files.write(found, path)  # fixed: the rows and the list of what stays must agree
    found = files.read(spark, path, schema=found.schema)
    last = found.agg(F.max("bin")).first()[0]
    rows = files.read(spark, source, fmt)
    if last is None:
        return Compacted(source, sorted(r.file for r in listing.select("file").collect()), None, fmt, rows.schema)
    kept = listing.join(found.select("file"), "file", "left_anti")
    tagged = rows.withColumn("__file", F.col("_metadata.file_path"))
    packing = tagged.join(found.select(F.col("file").alias("__file"), "bin"), "__file")
    packing = packing.repartitionById(last + 1, F.col("bin")).drop("__file", "bin")
    files.write(packing, target, fmt, partition_by=list(partition_by))
    return Compacted(source, sorted(r.file for r in kept.select("file").collect()), target, fmt, rows.schema)


def read_compacted(spark: SparkSession, table: Compacted) -> DataFrame:
    """All rows of a compacted table."""
    parts = []
    if table.untouched:
        paths = [unquote(f) for f in table.untouched]  # _metadata names files as URIs
        parts.append(files.read(spark, paths, table.fmt, table.schema, {"basePath": table.source}))
    if table.packed:
        parts.append(files.read(spark, table.packed, table.fmt, table.schema))
    if not parts:
        return spark.createDataFrame([], table.schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
