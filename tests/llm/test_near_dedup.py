"""Near duplicates against all pairs; sketches; components."""

import random
import re

import numpy as np
import pytest

from quarry.llm import components as C
from quarry.llm import near_dedup as N
from quarry.llm import queries
from tests.llm.data import documents, lower_ascii, nothing, odd_documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size):
    w = WORD.findall(lower_ascii(text))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size=4, percent=80):
    """(doc_id, n_shingles, component_id) of every row; rows of one id are one node."""
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), i if i is None or not s else root(i)) for i, s in sets), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def family(seed, n, copies):
    """A text and copies that differ in a few words, some of them of copies."""
    rnd, texts = random.Random(seed), [prose(seed, n).split()]
    for _ in range(copies):
        w = list(rnd.choice(texts))
        for _ in range(rnd.randint(0, n // 12)):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(1000)}"
        texts.append(w)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("blocks", [(512, 1024), (3, 4)])
def test_families_of_near_copies(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "BLOCK_DOCS", blocks[0])
    monkeypatch.setattr(N, "BAND_BLOCK", blocks[1])
    texts = family(1, 60, 40) + family(2, 120, 30) + family(3, 12, 15) + [prose(k, 50) for k in range(10, 30)]
    random.Random(5).shuffle(texts)
    got = N.near_duplicates(documents(spark, texts), 4)
    assert found(got) == brute(list(enumerate(texts, 1)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_thresholds_are_exact(spark):
    """Sets of 10 and 8 shingles with 8 in common: exactly 80 of 100."""
    w = [f"w{k}" for k in range(13)]
    texts = [" ".join(w), " ".join(w[:11]), " ".join(w[:10]), "A b C d", "a B c D", "a b", "a  b", "A\tb", "a c"]
    assert found(N.near_duplicates(documents(spark, texts), 4)) == brute(list(enumerate(texts, 1)))


def test_chain_of_links(spark):
    """Neighbours are linked, ends are not: one component all the same."""
    w = [f"w{k}" for k in range(200)]
    texts = [" ".join(w[3 * k : 3 * k + 60]) for k in range(40)]
    rows = list(zip(random.Random(3).sample(range(1000), 40), texts, strict=True))
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    got = found(N.near_duplicates(docs, 4))
    assert got == brute(rows) and len({c for _, _, c in got}) == 1


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(N.near_duplicates(docs, 4)) == brute(rows)
    kept = N.drop_near_duplicates(docs, 4)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {i for i, n, c in brute(rows) if i is not None and i == c}
    assert sorted(i for i in ids if i is not None) == sorted(want)  # one row of each, repeated rows too
    assert ids.count(None) == 2
    assert N.near_duplicates(nothing(spark)).count() == 0 and N.drop_near_duplicates(nothing(spark)).count() == 0


def test_query_on_the_table(spark, sf_dir):
    from quarry.llm.common import table

    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = queries.QUERIES["op9_minhash_near_dedup"](spark, sf_dir)
    assert found(got) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 7, 40, 300, 3000])
def test_sketch_fills_and_estimates(n):
    rnd = np.random.default_rng(n)
    errors = []
    for _ in range(30):
        both = rnd.integers(0, 1 << 63, n).astype(np.uint64)
        a, b = (np.unique(np.r_[both, rnd.integers(0, 1 << 63, n // 8).astype(np.uint64)]) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append((N.sketch(a) == N.sketch(b)).mean() - true)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    assert (N.sketch(a) == N.sketch(a[::-1].copy())).all()


def test_shingles_of_long_texts_in_chunks(monkeypatch):
    from quarry.llm import common

    text = (prose(1, 5000) + " \t " + prose(2, 100)).encode()
    whole = N.shingles(text, 5)
    monkeypatch.setattr(N, "byte_chunks", lambda data: common.byte_chunks(data, 64))
    assert (N.shingles(text, 5) == whole).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)] + [(5, 5)]
    up = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = C.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, root(x)) for x in up)
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
