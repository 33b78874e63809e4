"""Randomized check of the ordered operators against Spark's Window functions:
small tables with NULL groups and values, many or few range partitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import ordered

rows_st = st.lists(
    st.tuples(st.sampled_from([None, "a", "b", "c"]), st.one_of(st.none(), st.integers(-5, 5))),
    min_size=1,
    max_size=60,
)


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, partitions=st.integers(1, 12), offset=st.integers(1, 3), buckets=st.integers(1, 5))
def test_ordered_operators_match_window(spark, rows, partitions, offset, buckets):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, grp string, v long")
    order = ["v"]
    w = Window.partitionBy("grp").orderBy(F.col("v").asc_nulls_first(), "id")
    want = (
        df.withColumn("rn", F.row_number().over(w))
        .withColumn("run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("lead", F.lead("v", offset).over(w))
        .withColumn("lag", F.lag("v", offset).over(w))
        .withColumn("t", F.ntile(buckets).over(w))
    )
    pos = ordered.with_positions(df, order, ["id"], ["grp"], name="rn", running={"run": F.col("v")}, partitions=partitions)
    assert _rows(pos, ["id", "rn", "run"]) == _rows(want, ["id", "rn", "run"])
    ll = ordered.with_lead_lag(df, "v", order, ["id"], ["grp"], offset=offset, partitions=partitions)
    assert _rows(ll, ["id", "lead", "lag"]) == _rows(want, ["id", "lead", "lag"])
    nt = ordered.with_ntile(df, buckets, order, ["id"], ["grp"], name="t", partitions=partitions)
    assert _rows(nt, ["id", "t"]) == _rows(want, ["id", "t"])
    wr = Window.partitionBy("grp").orderBy(F.col("v").asc_nulls_first())
    rk = ordered.with_rank(df, [("v", False)], ["grp"], partitions=partitions)
    want_rk = df.withColumn("rank", F.rank().over(wr)).withColumn("dense_rank", F.dense_rank().over(wr))
    assert _rows(rk, ["id", "rank", "dense_rank"]) == _rows(want_rk, ["id", "rank", "dense_rank"])
