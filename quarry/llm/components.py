"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import kept_table


def _largest_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    low = low.select("n", F.least("n", "m").alias("m"))
    return both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _smallest_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them (edges come as a > b)."""
    low = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return moved.unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node reachable.

    Each round writes its edges below the checkpoint folder; the rounds end
    when the edges stay the same, which is then one edge from each node to its
    component.  Loops and repeated edges do no harm; an empty table gives an empty one.
    """
    kind = edges.schema["a"].dataType
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = kept_table(edges, "edges")
    was = _state(edges)
    while was[0]:
        edges = kept_table(_smallest_star(_largest_star(edges).distinct()).distinct(), "edges")
        now = _state(edges)
        if now == was:
            break
        was = now
    roots = edges.select("b").distinct()
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.unionByName(roots.select(F.col("b").alias("node"), F.col("b").cast(kind).alias("component")))
