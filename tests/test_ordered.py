"""Hot-group-safe window operators against Spark's Window functions (brute
force) on a fixture where one group holds a third of the rows and values tie."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("grp"),
        (F.col("id") % 97).cast("double").alias("v"),
    )
    return df.cache()


def _same(a, b, cols):
    ra = sorted(tuple(r[c] for c in cols) for r in a.collect())
    rb = sorted(tuple(r[c] for c in cols) for r in b.collect())
    assert ra == rb


def _layout(df, spec, n):
    """Each row's range partition, from the literals alone."""
    bounds, _ = ordered._bounds(df, [spec], n)
    return df.withColumn("pid", ordered._partition(bounds[0], spec.keys, df.schema)), len(bounds[0]) + 1


def test_hot_group_spans_partitions(skewed):
    rows, n = _layout(skewed, ordered.Numbering(["grp"], [("v", True)], ["id"]), 8)
    assert n == 8 and rows.where("grp = 'hot'").select("pid").distinct().count() > 1


@pytest.mark.parametrize("group", [[], ["grp"]])
def test_row_number_and_running_sum(skewed, group):
    got = ordered.with_positions(skewed, [("v", True)], ["id"], group, name="rn", running={"run": F.col("v")}, partitions=8)
    w = Window.partitionBy(*group).orderBy(F.col("v").desc(), "id")
    want = skewed.withColumn("rn", F.row_number().over(w)).withColumn(
        "run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    _same(got, want, ["id", "rn", "run"])


@pytest.mark.parametrize("group", [[], ["grp"]])
def test_rank_dense_rank(skewed, group):
    got = ordered.with_rank(skewed, [("v", True)], group, partitions=8)
    w = Window.partitionBy(*group).orderBy(F.col("v").desc())
    want = skewed.withColumn("rank", F.rank().over(w)).withColumn("dense_rank", F.dense_rank().over(w))
    _same(got, want, ["id", "rank", "dense_rank"])


@pytest.mark.parametrize("group", [[], ["grp"]])
def test_ntile_lead_lag(skewed, group):
    w = Window.partitionBy(*group).orderBy("v", "id")
    nt = ordered.with_ntile(skewed, 7, ["v"], ["id"], group, name="t", partitions=8)
    _same(nt, skewed.withColumn("t", F.ntile(7).over(w)), ["id", "t"])
    ll = ordered.with_lead_lag(skewed, "v", ["v"], ["id"], group, offset=2, partitions=8)
    want = skewed.withColumn("lead", F.lead("v", 2).over(w)).withColumn("lag", F.lag("v", 2).over(w))
    _same(ll, want, ["id", "lead", "lag"])


def test_null_group_and_values(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, "a", 2.0), (4, "a", None)], "id long, grp string, v double")
    got = ordered.with_positions(df, ["v"], ["id"], ["grp"], name="rn", partitions=3)
    w = Window.partitionBy("grp").orderBy(F.col("v").asc_nulls_first(), "id")
    _same(got, df.withColumn("rn", F.row_number().over(w)), ["id", "rn"])


@pytest.mark.parametrize("group", [[], ["grp"]])
def test_running_sum_with_nulls_across_partitions(spark, group):
    # The hot group starts with a long run of NULL values, so partitions whose
    # rows are all NULL sit between partitions that carry a total.
    df = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("grp"),
        F.when(F.col("id") < 900, F.lit(None)).otherwise((F.col("id") % 13).cast("decimal(18,2)")).alias("v"),
    )
    got = ordered.with_positions(df, ["id"], [], group, name="rn", running={"run": F.col("v")}, partitions=16)
    w = Window.partitionBy(*group).orderBy("id")
    want = df.withColumn("rn", F.row_number().over(w)).withColumn("run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    _same(got, want, ["id", "rn", "run"])
    assert got.schema["run"].dataType == want.schema["run"].dataType


@pytest.mark.parametrize("group", [[], ["grp"]])
def test_tiny_partitions_nulls(spark, group):
    # 64 range partitions over 300 rows: some hold fewer rows than the offset,
    # so neighbours and group sizes span several partitions; NULL groups and values.
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 2 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("grp"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 11).cast("double")).alias("v"),
    )
    w = Window.partitionBy(*group).orderBy(F.col("v").asc_nulls_first(), "id")
    order = ["v"]
    ll = ordered.with_lead_lag(df, "v", order, ["id"], group, offset=3, partitions=64)
    _same(ll, df.withColumn("lead", F.lead("v", 3).over(w)).withColumn("lag", F.lag("v", 3).over(w)), ["id", "lead", "lag"])
    nt = ordered.with_ntile(df, 4, order, ["id"], group, name="t", partitions=64)
    _same(nt, df.withColumn("t", F.ntile(4).over(w)), ["id", "t"])
    rk = ordered.with_rank(df, [("v", False)], group, partitions=64)
    wr = Window.partitionBy(*group).orderBy(F.col("v").asc_nulls_first())
    _same(rk, df.withColumn("rank", F.rank().over(wr)).withColumn("dense_rank", F.dense_rank().over(wr)), ["id", "rank", "dense_rank"])


def test_summary_exact_several_columns(spark):
    import math
    import statistics

    from quarry.operators.profile import summary_exact

    df = spark.range(1001).select(
        (F.col("id") % 17).cast("int").alias("a"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") * 0.5).alias("b"),
    )
    got = {r.column_name: r for r in summary_exact(df).collect()}
    rows = df.collect()
    for c in ("a", "b"):
        vals = sorted(float(r[c]) for r in rows if r[c] is not None)
        g = got[c]
        assert g["count"] == len(vals)
        assert g["min"] == vals[0] and g["max"] == vals[-1]
        assert abs(g["mean"] - round(statistics.fmean(vals), 6)) < 1e-9
        assert abs(g["stddev"] - round(statistics.stdev(vals), 6)) < 1e-9
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert g[name] == vals[max(1, math.ceil(p * len(vals))) - 1]


def test_partitions_must_be_positive(spark):
    with pytest.raises(ValueError, match="partitions"):
        ordered.with_positions(spark.range(5), ["id"], [], partitions=0)


@pytest.mark.parametrize("n", [1, 7, 64])
def test_range_partitions_are_even_ordered_and_one_a_task(spark, n):
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("grp"))
    rows, found = _layout(df, ordered.Numbering(["grp"], [("id", True)]), n)
    assert found == n
    sizes = sorted(r["count"] for r in rows.groupBy("pid").count().collect())
    assert sizes[-1] <= 2 * sizes[n // 2]
    ends = {r.pid: r for r in rows.groupBy("pid").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).collect()}
    assert all(ends[k].b <= ends[k + 1].a for k in range(n - 1))
    got = ordered.with_positions(df, [("id", True)], [], ["grp"], partitions=n)
    tasks = got.groupBy(F.spark_partition_id().alias("t")).count().collect()
    sizes = sorted(r["count"] for r in tasks)
    assert len(sizes) == n and sizes[-1] <= 2 * sizes[n // 2]


def test_nothing_is_written_and_one_shuffle_for_each_specification(spark, monkeypatch):
    from quarry.operators import catalog

    monkeypatch.setattr(catalog, "save_bucketed", None)
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("grp"), (F.col("id") % 13).alias("v"))
    specs = [ordered.Numbering((), ["v"], ["id"], position="a", running={"s": "v"}), ordered.Numbering(["grp"], [("v", True)], ["id"], rank="r", dense_rank="d")]
    got = ordered.numbered(df, specs, partitions=5)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("RepartitionById") + plan.count("Exchange") == 2 and "Join" not in plan
    w, g = Window.orderBy("v", "id"), Window.partitionBy("grp").orderBy(F.col("v").desc())
    want = df.withColumns({
        "a": F.row_number().over(w), "s": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), "r": F.rank().over(g), "d": F.dense_rank().over(g)
    })
    _same(got, want, ["id", "a", "s", "r", "d"])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,3)", "double", "string", "boolean", "binary"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_bounds_of_every_type_are_exact(spark, kind, zone):
    """Positions over keys of a type, descending and ascending, with NULLs; times around a clock change."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        second = F.lit(1604206800) + F.col("id") * 61
        made = {
            "timestamp": F.timestamp_seconds(second), "timestamp_ntz": F.timestamp_seconds(second).cast("timestamp_ntz"),
            "date": F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")), "decimal(20,3)": (F.col("id") / 7).cast("decimal(20,3)"),
            "double": F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 3 - 20), "string": F.concat(F.lit("é"), F.hex(F.col("id") * 77 % 101)),
            "boolean": F.col("id") % 2 == 0, "binary": F.unhex(F.lpad(F.hex(F.col("id") * 77 % 101), 2, "0")),
        }[kind]
        df = spark.range(300).select("id", F.when(F.col("id") % 17 != 0, made).alias("k"))
        assert df.schema["k"].dataType.simpleString() == kind
        for down in (False, True):
            got = ordered.with_positions(df, [("k", down)], ["id"], name="rn", partitions=9)
            key = F.col("k").desc_nulls_last() if down else F.col("k").asc_nulls_first()
            _same(got, df.withColumn("rn", F.row_number().over(Window.orderBy(key, "id"))), ["id", "rn"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("group", [[], ["grp"]])
@pytest.mark.parametrize("n", [1, 5, 40])
def test_rank_by_several_columns(spark, group, n):
    """Mixed directions, NULLs, ties that span partitions."""
    df = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.lit("b")).alias("grp"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.when(F.col("id") < 400, F.lit(1)).otherwise(F.col("id") % 3)).alias("a"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 2).cast("double")).alias("b"),
    )
    got = ordered.with_rank(df, [("a", True), ("b", False)], group, partitions=n)
    w = Window.partitionBy(*group).orderBy(F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first())
    want = df.withColumn("rank", F.rank().over(w)).withColumn("dense_rank", F.dense_rank().over(w))
    _same(got, want, ["id", "rank", "dense_rank"])


def test_first_value_puts_null_last(spark):
    from quarry.plans.relational import first_by_group

    df = spark.createDataFrame(
        [("g", "a", None, 1), ("g", "b", 2.0, 3), ("g", "c", 2.0, 2), ("h", "d", None, 5), ("h", "e", None, 4), (None, None, 1.0, 6), (None, "z", 0.5, 7)],
        "grp string, name string, bal double, k long",
    )
    got = {r.grp: r.top for r in first_by_group(df, "grp", "name", "bal", "k", "top").collect()}
    w = Window.partitionBy("grp").orderBy(F.col("bal").desc_nulls_last(), "k")
    want = {r.grp: r.top for r in df.withColumn("top", F.first_value("name").over(w)).collect()}
    assert got == want == {"g": "c", "h": "e", None: None}


def test_latest_per_key_with_nulls_and_ties(spark):
    from quarry.plans.relational import latest_per_key

    df = spark.createDataFrame([(1, None, 5), (1, 3, 1), (1, 3, 2), (None, 1, 1), (None, None, 9), (2, None, None)], "k long, t long, i long")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["t", "i"]).collect()), key=repr)
    assert got == sorted([(1, 3, 2), (None, 1, 1), (2, None, None)], key=repr)


def test_ntile_with_groups_smaller_than_bucket_count(spark):
    df = spark.range(40).select("id", F.when(F.col("id") < 3, F.lit("tiny")).otherwise(F.lit("big")).alias("grp"))
    got = ordered.with_ntile(df, 7, ["id"], [], ["grp"], name="t", partitions=6)
    w = Window.partitionBy("grp").orderBy("id")
    _same(got, df.withColumn("t", F.ntile(7).over(w)), ["id", "t"])


def test_void_column_passes_through(spark):
    df = spark.range(50).select("id", (F.col("id") % 4).alias("grp"), F.lit(None).alias("nothing"))
    got = ordered.with_positions(df, ["id"], [], ["grp"], name="rn", partitions=4)
    assert got.schema["nothing"].dataType == df.schema["nothing"].dataType
    w = Window.partitionBy("grp").orderBy("id")
    _same(got, df.withColumn("rn", F.row_number().over(w)), ["id", "rn", "nothing"])
