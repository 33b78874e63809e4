"""Join helpers against Spark's plain joins on a fixture with a hot key and
NULL keys."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import joins


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(400).select(
        F.col("id").alias("lid"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 40).alias("lk"),
    )
    # key 7 holds a third of the right side
    right = spark.range(900).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id") % 60).alias("rk"),
    )
    return left.cache(), right.cache()


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("partitions", [1, 8, 100])
@pytest.mark.parametrize("swapped", [False, True])  # the hot key on either side
def test_skew_join_using(sides, how, partitions, swapped):
    left, right = (s.withColumnRenamed(k, "k") for s, k in zip(sides, ("lk", "rk")))
    if swapped:
        left, right = right, left
    got = joins.skew_join(left, right, "k", how, partitions=partitions)
    want = left.join(right, "k", how)
    assert got.columns[0] == "k" and sorted(got.columns) == sorted(want.columns)
    assert _rows(got, ["k", "lid", "rid"]) == _rows(want, ["k", "lid", "rid"])


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_skew_join_of_random_hot_keys(spark, seed, how):
    """Keys hot on one side and absent, rare or hot on the other; NULLs; two key columns; repeated rows."""
    import random

    rnd = random.Random(seed)

    def side(n):
        hot = [(rnd.randrange(6), rnd.choice(["a", None, "b"])) for _ in range(3)]
        keys = [rnd.choice(hot) if rnd.random() < 0.6 else (rnd.randrange(60), rnd.choice("ab")) for _ in range(n)]
        return [(i, s, rnd.randrange(10)) for i, s in keys]

    a, b = side(rnd.choice([5, 60, 200])), side(rnd.choice([40, 150]))
    left = spark.createDataFrame(a, "i int, s string, x int")
    right = spark.createDataFrame(b, "i int, s string, y int")
    for keys in (["i"], ["i", "s"], ["s"]):
        r = right.withColumnRenamed("s", "s2") if keys == ["i"] else right.withColumnRenamed("i", "i2") if keys == ["s"] else right
        got = joins.skew_join(left, r, keys, how, partitions=rnd.choice([2, 9, 40]))
        want = left.join(r, keys, how).select(got.columns)
        assert _rows(got, got.columns) == _rows(want, got.columns)


def _tasks(spark, df, partitions):
    """Rows that each join task returns, empty ones too."""
    sizes = {r[0]: r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()}
    return sorted(sizes.get(k, 0) for k in range(partitions))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_no_task_holds_a_hot_key_or_null(spark, how, hot):
    """A third of the rows on one key and a third on NULL: every join task stays below twice the median."""
    n = 32
    many = 3000 if hot == "both" else 60_000
    skewed = lambda name: spark.range(many).select(
        F.col("id").alias(name),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when((F.col("id") % 3 == 1) & F.lit(hot != "both"), F.lit(None).cast("bigint")).otherwise(F.col("id") % 20_000).alias("k"),
    )
    flat = lambda name: spark.range(20_000).select(F.col("id").alias(name), F.col("id").alias("k"))
    left = skewed("x") if hot != "right" else flat("x")
    right = skewed("y") if hot != "left" else flat("y")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = joins.skew_join(left, right, "k", how, partitions=n, left_by=["x"], right_by=["y"])
        sizes = _tasks(spark, got, n)
        assert sizes[-1] <= 2 * sizes[n // 2]
        assert sum(sizes) == left.join(right, "k", how).count()
        if how in ("left", "full") and hot == "left":  # the plain join fails the same test
            plain = _tasks(spark, left.join(right, "k", how), n)
            assert plain[-1] > 2 * plain[n // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_skew_join_reads_each_side_once(spark, tmp_path):
    spark.range(3000).selectExpr("id as x", "if(id % 3 = 0, 7, id) as k").write.parquet(f"{tmp_path}/l")
    spark.range(100).selectExpr("id as y", "id as k").write.parquet(f"{tmp_path}/r")
    left, right = (spark.read.parquet(f"{tmp_path}/{s}") for s in "lr")
    got = joins.skew_join(left, right, "k", "full", partitions=8)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and got.count() == left.join(right, "k", "full").count()


def test_skew_join_of_keys_of_two_types(spark):
    left = spark.createDataFrame([(1, 0.0)] * 30 + [(2, -0.0)] * 30 + [(3, float("nan"))], "i int, d double")
    right = spark.createDataFrame([(1, 0.0), (2, 0.0), (2, 0.0), (3, float("nan"))], "i bigint, d float")
    want = left.join(right, ["i", "d"]).count()
    assert joins.skew_join(left, right, ["i", "d"], "inner", partitions=4).count() == want == 91
    assert joins.skew_join(left, right.drop("i"), "d", "full", partitions=4).count() == left.join(right.drop("i"), "d", "full").count()


def test_skew_join_of_sides_that_share_column_names(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (2, None, "b"), (3, 3, None)], "k long, j long, v string")
    right = spark.createDataFrame([(1, 1, "x"), (2, None, "y"), (4, 4, "z"), (None, 1, "n")], "k long, j long, v string")
    want = {"left": 4, "right": 5, "full": 7}
    for how, n in want.items():
        got = joins.skew_join(left, right, ["k", "j"], how, partitions=4)
        assert got.columns == ["k", "j", "v", "v_right"] and got.count() == n
    assert sorted(r.v_right for r in joins.skew_join(left, right, ["k", "j"], "left", partitions=4).where("k = 1").collect()) == ["x", "x"]
    with pytest.raises(ValueError, match="suffix"):
        joins.skew_join(left.withColumn("v_right", left.v), right, ["k", "j"], how, partitions=4)
    with pytest.raises(ValueError, match="join"):
        joins.skew_join(left, right, "k", "cross", partitions=4)


def test_skew_join_of_empty_sides(spark):
    some, none = spark.range(3), spark.range(0)
    assert joins.skew_join(some, none, "id", "left", partitions=4).count() == 3
    assert joins.skew_join(none, some, "id", "left", partitions=4).count() == 0
    assert joins.skew_join(none, some, "id", "full", partitions=4).count() == 3


def test_frequent_keys_of_several_columns(spark):
    from quarry.operators.hotkeys import frequent_keys

    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 7, id) as a", "if(id % 2 = 0, 'x', null) as b", "id as c")
    got = frequent_keys(df, {c: F.col(c) for c in df.columns}, 10)
    assert got["a"].frequent.keys() == {7} and abs(got["a"].frequent[7] - 3334) <= got["a"].error
    assert got["b"].frequent == {"x": 5000} and got["b"].nulls == 5000 and got["c"].frequent == {} and got["c"].rows == 10_000


@pytest.mark.parametrize("negate", [False, True])
def test_exists_join(sides, negate):
    left, right = sides
    got = joins.exists_join(left, right, "lk", "rk", negate=negate)
    want = left.join(right, left.lk == right.rk, "left_anti" if negate else "left_semi")
    assert _rows(got, ["lid"]) == _rows(want, ["lid"])


def test_aggregate_then_join(sides):
    left, right = sides
    got = joins.aggregate_then_join(left, right, "lk", "rk", [F.count(F.lit(1)).alias("n")], how="left")
    want = left.join(right, left.lk == right.rk, "left").groupBy("lid").agg(F.count("rid").alias("n"))
    g = {r.lid: (r.n or 0) for r in got.collect()}
    assert g == {r.lid: r.n for r in want.collect()}


def test_broadcast_is_checked_by_bytes(spark):
    small = spark.createDataFrame([(1, "x" * 1000)], "id long, t string")
    assert joins.text_bytes(small) > 1000 and joins.text_bytes(small.limit(0)) == 0
    hint = lambda df: "Broadcast" in df._jdf.queryExecution().logical().toString() or "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hint(joins.broadcast_checked(small)) and not hint(joins.broadcast_checked(small, max_bytes=100))


def test_attach_aggregate_keeps_null_group(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, None, 4.0)], "id long, g string, v double")
    per = rows.groupBy("g").agg(F.sum("v").alias("s"))
    got = {r.id: r.s for r in joins.attach_aggregate(rows, per, ["g"]).collect()}
    assert got == {1: 1.0, 2: 6.0, 3: 6.0}


def test_layout_advice_sees_skew_and_counts_within_the_error(spark):
    from quarry.operators.layout import layout_advice

    df = spark.range(200_000).selectExpr("id", "if(id % 3 < 2, 'hot', string(id % 5)) as skewed", "id % 4 as even", "date_add(date'2020-01-01', cast(id % 1000 as int)) as d")
    got = {r.partition_key: r for r in layout_advice(df, ["id", "skewed", "even", "d"], 10, 2_000_000, 10_000).collect()}
    assert got["id"].verdict == "too many values" and abs(got["id"].distinct_values / 200_000 - 1) < 0.02
    assert (got["skewed"].verdict, got["skewed"].distinct_values) == ("skewed", 6) and abs(got["skewed"].largest_share - 2 / 3) < 0.001
    assert got["even"].verdict == "good" and got["even"].largest_share == 0.25 and got["d"].distinct_values == 1000 and got["d"].largest_share is None
    plan = layout_advice(df, ["id", "skewed"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
