"""Nearest examples against all cosines; held-out accuracy; odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import queries, toxicity
from quarry.llm.common import learn_fold, table
from tests.llm.data import nothing, odd_documents, prose


def plain_cosines(index, idf, counted, terms, counts):
    def dense(t, c):
        v = np.zeros(len(idf))
        v[t] = (1 + np.log(c)) * idf[t]
        return v / max(1e-12, np.sqrt((v * v).sum()))

    q = dense(terms, counts)
    return np.array([dense(*counted[i]) @ q for i in index.order])


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_are_exact(seed, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", 1)
    rnd = np.random.default_rng(seed)
    idf = rnd.random(30) + 0.5

    def some():
        t = np.sort(rnd.choice(30, rnd.integers(0, 8), replace=False))
        return t, rnd.integers(1, 6, len(t))

    counted = [some() for _ in range(90)]
    counted += counted[:10]  # ties
    index = toxicity.Index(idf, counted, np.zeros(len(counted)))
    for k in (1, 5, 200):
        for _ in range(20):
            terms, counts = some()
            near, cosines = index.nearest(*index.vector(terms, counts), k)
            want = np.round(plain_cosines(index, idf, counted, terms, counts), 12)
            best = [i for i in np.lexsort((np.arange(len(want)), -want)) if want[i] > 0][:k]
            assert near.tolist() == best and np.allclose(cosines, want[best])
    near, _ = index.nearest(*index.vector(*counted[index.order[7]]), 5, without=7)
    assert 7 not in near


def toxic_table(spark, n=400):
    """Every fifth text holds one of a few words or an inflected form of one."""
    bad = ["grumblefoo", "snarkling", "snarklement", "snarklive"]
    rows = []
    for k in range(n):
        words = prose(k, 40).split()
        if k % 5 == 0:
            words[k % 30] = bad[k // 5 % 4]
        rows.append((k, " ".join(words), int(k % 5 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, 1, y) for k, _, y in rows], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = toxic_table(spark)
    got = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and all(r.predicted == r.toxic for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    calm = [r.score for r in got if not r.toxic]
    assert max(calm) < 0.2  # and so is the calibration
    ids = {r.doc_id for r in got if not r.held_out}
    assert all(set(r.neighbours) <= ids for r in got)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = toxic_table(spark, 200)
    fold = learn_fold("doc_id", 5, 0)
    other = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.classify(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_levels_and_prefixes():
    terms = toxicity.Terms({b"snar*": 0, b"snar*#3": 1, b"calm": 2})
    assert [x.tolist() for x in terms.count(b"Snark snarl SNARE calm")] == [[0, 1, 2], [3, 1, 1]]
    assert [x.tolist() for x in terms.count(b"snark")] == [[0], [1]]
    assert [x.tolist() for x in toxicity.Terms({}).count(b"snark")] == [[], []]


def test_query_and_odd_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = queries.QUERIES["op3_toxicity_knn"](spark, sf_dir)
    assert got.count() == docs.count() and got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    learned, labels = toxic_table(spark, 100)
    odd = odd_documents(spark)
    model = toxicity.fit_toxicity(odd.select("doc_id", "text").unionByName(learned), labels.unionByName(labels.limit(5)), F.lit(False))
    out = toxicity.score_toxicity(odd, model, ["doc_id"]).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.classify(odd, none).collect()} == {0.5}
    assert {r.score for r in toxicity.classify(odd, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.classify(nothing(spark), labels).count() == 0
    assert toxicity.classify(odd, labels.withColumn("toxic", F.lit(None).cast("int"))).count() == odd.count()
