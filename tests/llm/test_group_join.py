"""Jaccard join against all pairs: families, thresholds, groups of one prefix, blocks, odd rows."""

import random

import numpy as np
import pytest

from quarry.llm import group_join as G
from quarry.llm import queries
from quarry.llm.common import table
from tests.llm.data import documents, nothing, odd_documents, prose
from tests.llm.test_near_dedup import brute, family, found, shingle_set


def pairs_of(rows, size=3, percent=90):
    """{(set, set): (shared, united)} of similar different sets."""
    sets = list({frozenset(shingle_set(t, size)) for _, t in rows} - {frozenset()})
    out = {}
    for k, a in enumerate(sets):
        for b in sets[:k]:
            if 100 * len(a & b) >= percent * len(a | b):
                out[frozenset((a, b))] = (len(a & b), len(a | b))
    return out


def check(spark, texts, size=3, percent=90):
    docs, rows = documents(spark, texts), list(enumerate(texts, 1))
    assert found(G.jaccard_components(docs, size, percent)) == brute(rows, size, percent)
    pairs, members = G.jaccard_pairs(docs, size, percent)
    name = {r.cid: frozenset(shingle_set(texts[r.doc_id - 1], size)) for r in members.collect()}
    got = [(frozenset((name[r.a], name[r.b])), (r.shared, r.united)) for r in pairs.collect()]
    assert len(got) == len({x for x, _ in got}) and dict(got) == pairs_of(rows, size, percent)
    assert {r.doc_id for r in members.collect()} == {i for i, t in rows if shingle_set(t, size)}


@pytest.mark.parametrize("blocks", [(1024, 256), (4, 3)])
def test_families_of_near_copies(spark, monkeypatch, blocks):
    monkeypatch.setattr(G, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(G, "BLOCK_DOCS", blocks[0])
    monkeypatch.setattr(G, "SLICE_PAIRS", blocks[1])
    texts = family(1, 120, 50) + family(2, 240, 30) + family(3, 22, 15) + [prose(k, 50) for k in range(10, 30)]
    random.Random(5).shuffle(texts)
    check(spark, texts)


def test_thresholds_are_exact(spark):
    """10 shingles and 9 of them: exactly 90 of 100; 20 and 17 of them: less."""
    w = [f"w{k}" for k in range(40)]
    v = [f"v{k}" for k in range(40)]
    texts = [" ".join(w[:12]), " ".join(w[:11]), " ".join(v[:22]), " ".join(v[:19]), "a b", "A  b", "a", "a\tB ", "x y z"]
    check(spark, texts)
    assert brute(list(enumerate(texts, 1)), 3, 90)[1][2] == 1


def test_one_prefix_and_different_sets(spark, monkeypatch):
    """With one frequency class for all shingles many sets of a size share their prefix: groups of several classes, linked and not."""
    monkeypatch.setattr(G, "frequency_classes", lambda docs, size: np.zeros(G.CELLS, np.uint8))
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(60):
        w = list(base)
        for _ in range(k % 9):
            w[rnd.randrange(60)] = rnd.choice(base)
        texts.append(" ".join(w))
    check(spark, texts)
    check(spark, texts, percent=50)
    check(spark, texts, 1, 80)


def test_chain_of_links(spark):
    w = [f"w{k}" for k in range(300)]
    check(spark, [" ".join(w[3 * k : 3 * k + 90]) for k in random.Random(3).sample(range(50), 50)])


def test_random_sets(spark):
    rnd = random.Random(11)
    texts = [" ".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(3, 14))) for _ in range(150)]
    check(spark, texts, 1, 70)
    check(spark, texts, 2, 60)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(G.jaccard_components(docs)) == brute(rows, 3, 90)
    assert G.jaccard_components(nothing(spark)).count() == 0
    pairs, members = G.jaccard_pairs(nothing(spark))
    assert pairs.count() == 0 and members.count() == 0


def test_a_doc_id_with_many_texts(spark):
    """All rows of an id are one node; a repeated row counts once."""
    w = [f"w{k}" for k in range(400)]
    rows = [(7, " ".join(w[40 * k : 40 * k + 30])) for k in range(10)] + [(3, " ".join(w[0:30])), (9, " ".join(w[81:110])), (1, "z y x")]
    rows += [(9, " ".join(w[81:110]))] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(G.jaccard_components(docs)) == brute(rows, 3, 90)


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 57, 999, 2000, 5000, 15000])
def test_filters_lose_no_similar_pair(n):
    rnd = np.random.default_rng(n)
    for _ in range(20):
        both = rnd.integers(0, 1 << 63, n).astype(np.uint64)
        extra = rnd.integers(0, 1 << 63, max(1, n // 9 + 1)).astype(np.uint64)
        cut = rnd.integers(0, len(extra) + 1)
        a, b = np.unique(np.r_[both, extra[:cut]]), np.unique(np.r_[both, extra[cut:]])
        if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            continue
        assert set(a[: G.prefix_length(len(a), 90)].tolist()) & set(b[: G.prefix_length(len(b), 90)].tolist())
        counts, large = G.opened([G.signature(a), G.signature(b)])
        assert G._few_differences(counts[:1], counts[1:], large[:1] & large[1:], np.array([len(a) + len(b)]), 90)[0]
        if n > 50:
            other, big = G.opened([G.signature(rnd.integers(0, 1 << 63, n).astype(np.uint64))])
            assert not G._few_differences(counts[:1], other, large[:1] & big, np.array([len(a) + n]), 90)[0]


def test_query_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert found(queries.QUERIES["op13_jaccard_join"](spark, sf_dir)) == brute(rows, 3, 90)
