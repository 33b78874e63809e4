"""Exact quantiles by narrowing against sorted values: repeats, NULLs, types, brackets of several rounds."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.operators import selection as S

PROBS = [0.0, 0.25, 0.999]


def want(values, probs=PROBS):
    values = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return {p: values[max(1, math.ceil(p * len(values))) - 1] if values else None for p in probs}


def check(df, probs=PROBS):
    got = S.exact_quantiles(df, {c: probs for c in df.columns})
    rows = df.collect()
    for c in df.columns:
        assert repr(got[c]) == repr(want([r[c] for r in rows], probs)), c


@pytest.mark.parametrize("left,accuracy", [(20_000, 10_000), (50, 10_000)])
def test_columns_of_all_kinds_together(spark, monkeypatch, left, accuracy):
    monkeypatch.setattr(S, "LEFT", left)
    monkeypatch.setattr(S, "ACCURACY", accuracy)
    big = 2**60
    df = spark.range(3001).select(
        F.when(F.col("id") % 3 == 0, 50.0).otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("third"),
        F.when(F.col("id") % 5 != 0, (F.col("id") * 7919 % 3001 - 1500).cast("int")).alias("i"),
        (F.lit(big) + F.col("id") * 7919 % 3001).alias("beyond_double"),
        (F.col("id") * 31 % 97 / 7).cast("decimal(20,10)").alias("m"),
        F.when(F.col("id") % 11 == 0, float("nan")).otherwise(F.col("id") / 3).alias("nan"),
        F.lit(7).alias("same"),
        F.lit(None).cast("double").alias("none"),
        (F.col("id") % 2).cast("tinyint").alias("bit"),
    )
    check(df)


@pytest.mark.parametrize("seed", range(2))
def test_random_values(spark, monkeypatch, seed):
    """A coarse sketch and few values counted one by one: several rounds."""
    monkeypatch.setattr(S, "LEFT", 8)
    monkeypatch.setattr(S, "ACCURACY", 50)
    rnd = random.Random(seed)
    heavy = [rnd.randrange(50) for _ in range(4)]
    rows = [(rnd.choice([*heavy, None, rnd.randrange(1000)]), Decimal(rnd.choice([*heavy, rnd.randrange(10**6)])) / 100) for _ in range(600)]
    check(spark.createDataFrame(rows, "a long, m decimal(12,2)"), [rnd.random() for _ in range(2)])


def test_passes_do_not_grow_with_the_columns(spark, monkeypatch):
    """One size pass, one sketch, one count of proposals, one of what is left, whatever the number of columns."""
    monkeypatch.setattr(S, "LEFT", 100)
    calls = []
    for name in ("_proposals", "_rank", "_count"):
        monkeypatch.setattr(S, name, lambda *a, f=getattr(S, name), n=name: calls.append(n) or f(*a))
    df = spark.range(20_000).select(*[(F.col("id") * (7919 + k) % 20_011).alias(f"c{k}") for k in range(8)])
    got = S.exact_quantiles(df, {c: [0.25, 0.5] for c in df.columns})
    assert calls == ["_proposals", "_rank", "_count"]
    rows = df.collect()
    assert all(got[c] == want([r[c] for r in rows], [0.25, 0.5]) for c in df.columns)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "a int, b double")
    assert S.exact_quantiles(none, {"a": [0.5], "b": []}) == {"a": {0.5: None}, "b": {}}
    assert S.exact_quantiles(none, {}) == {}
