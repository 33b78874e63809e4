"""Column profiles: count, mean, stddev, min, max and exact quantiles.

``DataFrame.summary()`` gives approximate percentiles.  Here quantiles are
exact and still distributed (``selection.exact_quantiles``): the q-quantile is the value at position
ceil(q * n) -- the discrete quantile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from quarry.operators.selection import exact_quantiles


def _label(p: float) -> str:
    return f"p{round(p * 100):d}"


def summary_exact(df: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: count, mean, stddev (rounded to 6 places), min, the
    exact quantiles and max of numeric columns; count, min_text and max_text
    of text columns.  Columns of other types are left out.

    The moments of every column come from one aggregate pass, reshaped to a
    row per column with ``stack``; the quantiles of all numeric columns share
    their passes.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    cols = [f.name for f in df.schema.fields if f.name in numeric or isinstance(f.dataType, StringType)]
    none = F.lit(None)
    aggs = []
    for i, c in enumerate(cols):
        n = c in numeric
        aggs += [
            F.count(c).alias(f"n{i}"),
            (F.round(F.avg(c), 6) if n else none).cast("double").alias(f"m{i}"),
            (F.round(F.stddev_samp(c), 6) if n else none).cast("double").alias(f"s{i}"),
            (F.min(c) if n else none).cast("double").alias(f"lo{i}"),
            (F.max(c) if n else none).cast("double").alias(f"hi{i}"),
            (none if n else F.min(c)).cast("string").alias(f"lt{i}"),
            (none if n else F.max(c)).cast("string").alias(f"ht{i}"),
        ]
    stats = df.agg(*aggs)
    quantiles = exact_quantiles(df, {c: probs for c in numeric})
    fields = []
    for i, c in enumerate(cols):
        qs = quantiles.get(c, dict.fromkeys(probs))
        fields += [F.lit(c), F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"s{i}"), F.col(f"lo{i}")]
        fields += [F.lit(qs[p]).cast("double") for p in probs]
        fields += [F.col(f"hi{i}"), F.col(f"lt{i}"), F.col(f"ht{i}")]
    names = ["column_name", "count", "mean", "stddev", "min", *[_label(p) for p in probs], "max", "min_text", "max_text"]
    return stats.select(F.stack(F.lit(len(cols)), *fields)).toDF(*names)
