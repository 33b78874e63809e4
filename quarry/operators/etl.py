"""ETL operators: column mapping, dropping all-NULL fields, schema discovery
and drift against a previous schema."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Mapping = Sequence[tuple[str, str, str, str]]  # (source, source type, target, target type)


def apply_mapping(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Rename and cast per the mapping; columns not listed are dropped.

    A source column of another type than the mapping declares is an error."""
    found = dict(df.dtypes)
    wrong = {src: (found.get(src), kind) for src, kind, _, _ in mapping if found.get(src) != kind}
    if wrong:
        raise ValueError("source types differ from the mapping (found, declared): " + str(wrong))
    return df.select(*[F.col(src).cast(dst_type).alias(dst) for src, _, dst, dst_type in mapping])


def null_counts(df: DataFrame) -> dict[str, int]:
    """Non-NULL values per column in one aggregate pass (one small row back)."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return row.asDict()


def drop_null_fields(df: DataFrame) -> DataFrame:
    """Remove the columns that are NULL in every row."""
    counts = null_counts(df)
    return df.select(*[c for c in df.columns if counts[c] > 0])


# Order in which a value's type is tried: the first that parses wins for the key
# only when every value of the key parses as it.
TYPE_ORDER = ("bigint", "double", "boolean", "timestamp", "string")


def infer_json_fields(df: DataFrame, json_col: str) -> DataFrame:
    """Schema discovery over a JSON-object column.

    Every object is exploded into (key, value) pairs; each value votes for
    the types it parses as; per key the narrowest type all values accept
    wins.  Returns (field, inferred_type, values).
    """
    pairs = df.select(F.explode(F.from_json(F.col(json_col), "map<string,string>")).alias("field", "value"))
    pairs = pairs.where(F.col("value").isNotNull())
    votes = pairs.groupBy("field").agg(
        F.count(F.lit(1)).alias("values"),
        *[
            F.count(F.expr(f"try_cast(value AS {t})")).alias(f"n_{t}")
            for t in TYPE_ORDER
            if t != "string"
        ],
    )
    inferred = F.lit("string")
    for t in reversed([t for t in TYPE_ORDER if t != "string"]):
        inferred = F.when(F.col(f"n_{t}") == F.col("values"), F.lit(t)).otherwise(inferred)
    return votes.select("field", inferred.alias("inferred_type"), "values")


def schema_drift(found: DataFrame, previous: DataFrame) -> DataFrame:
    """Compare a discovered (field, inferred_type) set with a previous
    (field, type) schema: added, removed, changed or unchanged."""
    prev = previous.select(F.col("field").alias("p_field"), F.col("type").alias("previous_type"))
    joined = found.join(prev, found.field == prev.p_field, "full")
    status = (
        F.when(F.col("p_field").isNull(), "added")
        .when(F.col("field").isNull(), "removed")
        .when(F.col("inferred_type") != F.col("previous_type"), "changed")
        .otherwise("unchanged")
    )
    return joined.select(
        F.coalesce("field", "p_field").alias("field"), "inferred_type", "previous_type", status.alias("change"),
        "values",
    )


def previous_schema(spark: SparkSession, fields: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(fields), "field string, type string")


def read_data_files(
    spark: SparkSession, path: str, fmt: str = "parquet", include: str = "*.parquet", merge_schema: bool = False
) -> DataFrame:
    """Read only data files: ``pathGlobFilter`` keeps names matching
    ``include``, so ``*.tmp`` leftovers and ``_SUCCESS`` markers are skipped."""
    reader = spark.read.format(fmt).option("pathGlobFilter", include)
    return reader.option("mergeSchema", str(merge_schema).lower()).load(path)


def discover_files(
    spark: SparkSession, path: str, previous: Sequence[tuple[str, str]], fmt: str = "parquet", include: str = "*.parquet"
) -> DataFrame:
    """Schema discovery over files, compared with the last known schema.

    Files that don't match ``include`` are skipped; the others' schemas are merged.
    Returns (field, inferred_type, previous_type, change, values): the values are
    counted in the files; a field that is gone is logged and stays as ``removed``.
    """
    rows = read_data_files(spark, path, fmt, include, merge_schema=True)
    pairs = ", ".join(f"'{c}', '{t}', n_{i}" for i, (c, t) in enumerate(rows.dtypes))
    counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(f"n_{i}") for i, c in enumerate(rows.columns)])
    found = counts.selectExpr(f"stack({len(rows.columns)}, {pairs}) AS (field, inferred_type, values)")
    for name in sorted({f for f, _ in previous} - set(rows.columns)):
        log.warning("field %s of the previous schema is gone from %s", name, path)
    return schema_drift(found, previous_schema(spark, previous))
