"""Layout operators: partition statistics and layout advice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.hotkeys import frequent_keys, key_item

MIN_PARTITION_BYTES = 128 * 1024 * 1024  # advice: 128 MB .. 1 GB per partition value
MAX_PARTITION_BYTES = 1024 * 1024 * 1024
MAX_VALUES = 10_000  # more partition values than this is a high-cardinality key


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows held by each Spark partition, computed on the executors."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


#: Bytes that a value of each type takes; text takes its own length.
WIDTHS = {"tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "boolean": 1}
WIDTH = 8


def value_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: the width of its types, and the length of its texts."""
    total = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(name), F.lit(0))
        else:
            total = total + F.lit(WIDTHS.get(kind, WIDTH))
    return total


#: Distinct values of a key up to which the counts are exact; beyond it the relative error is about 1 / sqrt of it.
EXACT_VALUES_LOG2 = 16
#: A value with at least one in so many rows is named with its share.
SHARE = 8


def _sketched(df: DataFrame, name: str) -> Column:
    """The column in a form that the distinct-count sketch takes; different values stay different."""
    kind = dict(df.dtypes)[name]
    return F.col(name) if kind in ("int", "bigint", "float", "double", "string", "binary") else F.col(name).cast("string")


def layout_advice(
    df: DataFrame,
    keys: Sequence[str],
    min_bytes: int = MIN_PARTITION_BYTES,
    max_bytes: int = MAX_PARTITION_BYTES,
    max_values: int = MAX_VALUES,
) -> DataFrame:
    """For each candidate partition key: distinct values, rows, measured bytes per value (``value_bytes`` of all
    rows / values), the share of the most frequent value if it reaches 1 / SHARE, and a verdict.

    Two passes, for any number of keys: mergeable distinct-count sketches of all of them, and a
    frequent-items sketch of all of them.  A key is skewed if its largest value alone is too large for a partition
    while the average is not.
    """
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(value_bytes(df)).alias("bytes")]
    for i, k in enumerate(keys):
        sketch = F.theta_sketch_agg(_sketched(df, k), EXACT_VALUES_LOG2)
        aggs.append(F.theta_sketch_estimate(sketch).alias(f"d_{i}"))
    frequent = frequent_keys(df, {k: key_item(df, [k]) for k in keys}, SHARE, parts=1)
    shares = {k: max(found.frequent.values(), default=0) / max(found.rows, 1) for k, found in frequent.items()}
    stats = df.agg(*aggs)
    fields = []
    for i, k in enumerate(keys):
        fields += [F.lit(k), F.col(f"d_{i}"), F.lit(shares[k] or None).cast("double")]
    long = stats.select(F.stack(F.lit(len(keys)), *fields).alias("partition_key", "distinct_values", "largest_share"), "rows", "bytes")
    long = long.withColumn("bytes_per_value", F.col("bytes").cast("double") / F.col("distinct_values"))
    largest = F.col("bytes").cast("double") * F.coalesce("largest_share", F.lit(0.0))
    verdict = (
        F.when(F.col("distinct_values") > max_values, "too many values")
        .when(F.col("bytes_per_value") < min_bytes, "partitions too small")
        .when(F.col("bytes_per_value") > max_bytes, "partitions too large")
        .when(largest > max_bytes, "skewed")
        .otherwise("good")
    )
    return long.select("partition_key", "distinct_values", "rows", "bytes_per_value", "largest_share", verdict.alias("verdict"))
