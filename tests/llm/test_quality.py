"""The two quality operators: attention MIL (held-out accuracy, gradients) and robust outliers (brute force)."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import quality_mcd as mcd
from quarry.llm import quality_mil as mil
from quarry.llm import queries
from quarry.llm.common import learn_fold, table
from tests.llm.data import documents, nothing, odd_documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def judged(df):
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()


def test_counts_on_the_table(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = queries.QUERIES["op2_mcd_quality_rules"](spark, sf_dir)
    for r in judged(got):
        want = counts(texts[r.doc_id])
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    assert not got.where("base_failed and kept").count()


@pytest.mark.parametrize("text", ["", "a b c d e", "a b c d e a b c d e", "x " * 30, "a b c d e f a b c d e f a b c d e",
                                  "l\nl\n l\nl \n\n\nl\x1fl l", "ünï #*$%&|<> \U0001f600"])
def test_counts(text):
    assert mcd.statistics(text.encode())[:5] == counts(text)


def test_outliers_are_found_in_every_group(spark):
    """Symbol soup and shouting among prose; each language and source has its own normal."""
    rows, bad = [], set()
    for k in range(600):
        text = prose(k, 30 + k * 7 % 200)
        if k % 4 == 1:  # the normal of this group: shorter words, some symbols
            text = re.sub(r"(\w{3})\w*", r"\1", text).replace(" ", " # ", 6)
        if k % 40 == 7:
            text = " ".join(w + "%$#" for w in text.split())
            bad.add(k)
        if k % 40 == 22:
            text = text.upper()
            bad.add(k)
        rows.append((k, text, "en" if k % 4 else None, "hot" if k % 3 else f"s{k % 2}", len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in mcd.judge(docs).collect()}
    assert {k for k, r in got.items() if not r.kept and not r.base_failed} == bad


def plain_mcd(x, half):
    """Exact centre of the half with the smallest determinant, by concentration from many random starts."""
    rnd, n, best = np.random.default_rng(0), len(x), (np.inf, None)
    h = math.ceil(half * n)
    for _ in range(60):
        pick = rnd.choice(n, x.shape[1] + 1, replace=False)
        for _ in range(30):
            c, s = x[pick].mean(axis=0), np.cov(x[pick].T, bias=True) + np.diag((mcd.FLOOR * mcd.UNIT) ** 2)
            y = x - c
            pick = np.argsort(np.einsum("ij,jk,ik->i", y, np.linalg.inv(s), y), kind="stable")[:h]
        s = np.cov(x[pick].T, bias=True) + np.diag((mcd.FLOOR * mcd.UNIT) ** 2)
        best = min(best, (np.linalg.slogdet(s)[1], x[pick].mean(axis=0)), key=lambda b: b[0])
    return best


def test_estimate_resists_a_quarter_of_outliers(spark):
    rnd = np.random.default_rng(3)
    mix = rnd.normal(size=(6, 6))
    clean = rnd.normal(size=(480, 6)) @ mix * 1500
    dirty = rnd.normal(size=(120, 6)) * 300 + 9000
    x = np.rint(np.r_[clean, dirty]).astype(int)
    vectors = spark.createDataFrame([("g", v.tolist()) for v in x], "g string, x array<int>").repartition(4)
    model = np.array(mcd.covariance_models(vectors).first().model)
    centre, inverse = model[:6], model[6:].reshape(6, 6)
    _, want = plain_mcd(x.astype(float), mcd.HALF)
    spread = x[:480].std(axis=0)
    assert (np.abs(centre - want) < 0.25 * spread).all()
    far = np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre)
    assert (far[480:] > mcd.CUTOFF).mean() > 0.95 and (far[:480] > mcd.CUTOFF).mean() < 0.01


def test_chi_square():
    assert abs(mcd._chi2_quantile(0.95, 6) - 12.5916) < 1e-3 and abs(mcd._chi2(7.344, 8) - 0.5) < 1e-3


def test_odd_rows_of_the_rules(spark):
    docs = odd_documents(spark)
    got = mcd.judge(docs).collect()
    assert sorted(str(tuple(r)[1:6]) for r in got) == sorted(str(counts(r.text or "")) for r in docs.collect())
    assert all(r.distance is None for r in got)  # groups too small: the base limits alone
    assert all(r.kept == (not r.base_failed) for r in got)
    assert mcd.judge(nothing(spark)).count() == 0


# ---- attention model


def quality_table(spark, n=240):
    """Junk is one passage of symbols or of a repeated word somewhere in a long text."""
    rows = []
    for k in range(n):
        words = prose(k, 200).split()
        if k % 3 == 0:
            at = k % 150
            words[at : at + 50] = ["spam!!"] * 60 if k % 2 else [f"{w}%$" for w in words[at : at + 50]]
        rows.append((k, " ".join(words), int(k % 3 != 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, y, 0) for k, _, y in rows], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_attention(spark):
    docs, labels = quality_table(spark)
    got = mil.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and all(r.predicted == r.quality for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_gradients():
    rnd = np.random.default_rng(0)
    model = mil.AttentionModel(1)
    x = rnd.random((9, mil.FEATURES))
    firsts, y, weight = np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0]), np.array([0.5, 2.0, 1.0])

    def loss():
        o = model.forward(x, firsts)["o"]
        return (weight * (np.log1p(np.exp(-o)) * y + np.log1p(np.exp(o)) * (1 - y))).mean()

    g = model.gradients(model.forward(x, firsts), firsts, y, weight)
    for name, v in model.p.items():
        flat = v.reshape(-1)
        for k in rnd.choice(len(flat), min(4, len(flat)), replace=False):
            was, e = flat[k], 1e-5
            flat[k] = was + e
            up = loss()
            flat[k] = was - e
            down = loss()
            flat[k] = was
            assert abs((up - down) / (2 * e) - g[name].reshape(-1)[k]) < 1e-6, name


def test_passages_cover_the_whole_text():
    assert len(mil.passages(b"")) == 1 and len(mil.passages(b"a" * 513)) == 2
    long = prose(1, 60000).encode()
    assert len(mil.passages(long)) == -(-mil.BLOCK // mil.SPAN) * (len(long) // mil.BLOCK) + -(-(len(long) % mil.BLOCK) // mil.SPAN)
    assert not np.array_equal(mil.passages(long)[-1], mil.passages(long[:-1] + b"%")[-1])


def test_held_out_labels_do_not_matter(spark):
    docs, labels = quality_table(spark, 90)
    other = labels.withColumn("quality", F.when(learn_fold("doc_id", 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in mil.classify(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_query_and_odd_rows_of_the_model(spark, sf_dir):
    got = queries.QUERIES["op7_quality_mil"](spark, sf_dir)
    assert got.count() == table(spark, sf_dir, "documents").count()
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    learned, labels = quality_table(spark, 60)
    odd = odd_documents(spark)
    model = mil.fit_quality(odd.select("doc_id", "text").unionByName(learned), labels.unionByName(labels.limit(3)), F.lit(False))
    out = mil.score_quality(odd, model, ["doc_id"]).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    kept = mil.keep_good(odd, labels)
    assert kept.columns == odd.columns
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in mil.classify(odd, none).collect()} == {0.5}
    assert mil.classify(nothing(spark), labels).count() == 0
    assert mil.classify(documents(spark, [None, ""]), labels).count() == 2


@pytest.mark.parametrize("unit", ["a", "ha ", "=-", "xyz\n"])
def test_texts_that_are_all_repetition(unit):
    data = (unit * 2000).encode()
    got = mil.passages(data)
    assert got[0, -4] > 0.95 and (got[1:, -4:-2] == 1).all()


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = (prose(3, 900) + prose(4, 900) + "ha " * 700 + prose(3, 400)).encode()
    whole = mil.passages(text)
    for block in (512, 1024, 2560):
        monkeypatch.setattr(mil, "BLOCK", block)
        assert np.array_equal(mil.passages(text), whole)
    grams = [text[k : k + 8] for k in range(len(text) - 7)]
    first = {g: k for k, g in reversed(list(enumerate(grams)))}
    for p, row in enumerate(whole):
        own = range(512 * p, min(512 * p + 512, len(grams)))
        n = max(1, len(own))
        assert row[-4] == np.float32(sum(first[grams[k]] < k for k in own) / n)
        assert row[-3] == np.float32(sum(first[grams[k]] < 512 * p for k in own) / n)
