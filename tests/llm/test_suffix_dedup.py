"""Repeated bytes against a search of every 50-byte string; induced sorting against a plain sort."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import induced, queries
from quarry.llm import suffix_dedup as S
from tests.llm.data import documents, nothing, odd_documents, prose

L = S.LENGTH


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, digest) of every row; rows without an id are not compared."""
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        if i is not None:
            for k in range(len(t) - L + 1):
                first[t[k : k + L]] = min(i, first.get(t[k : k + L], i))
    out = []
    for i, t in data:
        gone = np.zeros(len(t) + 1, bool)
        if i is not None:
            for k in range(len(t) - L + 1):
                if first[t[k : k + L]] < i:
                    gone[k : k + L] = True
        left = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_planted_repeats(spark):
    p = prose(1, 200)
    texts = [
        p,
        "start " + p[100:400] + " middle " + p[90:150] + " end",
        p[10:60],  # exactly the length
        p[10:59],  # one byte short
        "é" + p[300:349] + "é",
        p[:500] + "X" + p[501:],  # one byte changed
        "ab" * 300,
        "xab" + "ab" * 100 + "y",  # a string that overlaps itself
        "日本語" * 40,
        "本語日" * 40,
        "z" * 49 + "q",
        "z" * 50,
        "z" * 200,
        p,
    ]
    random.Random(2).shuffle(texts)
    got = S.repeat_digest(documents(spark, texts))
    assert found(got) == brute(list(enumerate(texts, 1)))


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_letters(spark, monkeypatch, seed):
    """Many partial repeats, anchors that tie, small batches and shards."""
    monkeypatch.setattr(S, "BATCH_ANCHORS", 20)
    monkeypatch.setattr(S, "SHARD_BYTES", 300)
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("ab" if seed else "abcde ") for _ in range(rnd.randint(30, 90))) for _ in range(12)]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, 5))) for _ in range(40)]
    assert found(S.repeat_digest(documents(spark, texts))) == brute(list(enumerate(texts, 1)))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(S.repeat_digest(docs)) == brute(rows)
    assert S.repeat_digest(nothing(spark)).count() == 0
    cut = {r.doc_id: [tuple(x) for x in r.removed] for r in S.remove_repeats(documents(spark, ["a" * 60, "b" + "a" * 60])).collect()}
    assert cut == {1: [], 2: [(1, 61)]}


def test_query_on_the_table(spark, sf_dir):
    from quarry.llm.common import table

    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = found(queries.QUERIES["op6_suffix_dedup"](spark, sf_dir))
    assert got == brute(rows) and any(r[2] for r in got)


def test_runs_cover_every_window_once():
    rnd = np.random.default_rng(1)
    for alphabet in (1, 2, 200):
        for n in (50, 51, 80, 700):
            x = rnd.integers(0, alphabet, n).astype(np.uint8)
            hashes, place, first, last = S.runs(x)
            assert first[0] == 0 and last[-1] == n - L and (first[1:] == last[:-1] + 1).all()
            assert (place >= last).all() and (place - first <= L - S.GRAM).all()


def _sorted(text, depth, limit):
    positions, common = [], []
    induced.sorted_suffixes(text, depth, lambda p, c: (positions.append(p), common.append(c)), limit)
    return np.concatenate(positions).tolist(), np.concatenate(common).tolist()


@pytest.mark.parametrize("limit", [5, 10**6])  # with and without files
@pytest.mark.parametrize("alphabet", [1, 2, 3, 8])
def test_induced_sorting(monkeypatch, limit, alphabet):
    rnd = random.Random(alphabet)
    for trial in range(30):
        monkeypatch.setattr(induced, "BLOCK", rnd.choice([2, 7, 1 << 20]))
        t = [rnd.randint(1, alphabet) for _ in range(rnd.randint(1, 100))]
        t = t + t[: len(t) // 2] + [1] + t if trial % 2 else t
        text, depth = np.array([*t, 0], np.uint16), rnd.choice([3, 8, 50])
        down, common = _sorted(text, depth, limit)
        s = text.tolist()
        assert sorted(down) == list(range(len(s)))
        heads = [tuple(s[p : p + depth]) for p in down]
        assert heads == sorted(heads, reverse=True)
        for k in range(1, len(down)):
            same = next((j for j in range(depth) if heads[k][j : j + 1] != heads[k - 1][j : j + 1] or j >= len(heads[k])), depth)
            assert common[k] == same


@pytest.mark.parametrize("sample", [1, 2])
def test_hot_anchors(spark, monkeypatch, sample):
    """A phrase in every document, amid other bytes: no group of classes grows with the documents that hold it."""
    monkeypatch.setattr(S, "HOT_BYTES", 2000)
    monkeypatch.setattr(S, "HOT_SAMPLE", sample)
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz ,.0123456789"
    other = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    phrase, common = other(44), other(60)
    texts = [other(80) + phrase + other(80) for _ in range(300)]
    texts += [other(70) + common + phrase + texts[k][124:150] + other(70) for k in range(40)]
    docs = documents(spark, texts)
    cut = S._cut_documents(docs, S._shared_anchors(docs))
    groups = S._bytes(cut, S._alike(S._classes(cut)).where("alike")).selectExpr("anchor", "length(bytes) as n")
    assert groups.groupBy("anchor").sum("n").toArrow().column(1).to_numpy().max() < 2 * S.HOT_BYTES
    got = found(S.repeat_digest(docs))
    assert got == brute(list(enumerate(texts, 1))) and any(r[2] for r in got)


def test_every_anchor_hot(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_BYTES", 1)
    monkeypatch.setattr(S, "HOT_SAMPLE", 1)
    docs = odd_documents(spark)
    assert found(S.repeat_digest(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    texts = ["ab" * 300, "xab" + "ab" * 100 + "y", prose(1, 300), prose(2, 9) + prose(1, 90)]
    assert found(S.repeat_digest(documents(spark, texts))) == brute(list(enumerate(texts, 1)))


def test_sides_of_joined_texts():
    """Equal windows share a side, wherever they stand and whatever texts are joined; runs without the bytes have none."""
    p = prose(3, 300).encode()
    a, b = b"x" * 40 + p[:900], p[100:1500] + b"end"
    shares = 0
    for one, two in ((a, b), (b, a)):
        of = [S.runs(np.frombuffer(t, np.uint8)) for t in (one, two)]
        got = []
        for shift, (h, place, first, last) in zip((0, len(one)), of, strict=True):
            args = (place - first, last - first + L, S._Powers())
            alone = S._sides(two if shift else one, first, *args)
            joined = S._sides(one + two, first + shift, *args)
            assert all((x == y).all() for x, y in zip(alone, joined, strict=True))
            got.append(np.stack([np.ascontiguousarray(c).view(np.uint32).reshape(-1, 2) for c in alone], 1).reshape(len(first), -1))
        texts = [[t[x : y + L] for x, y in zip(f, e, strict=True)] for t, (_, _, f, e) in zip((one, two), of, strict=True)]
        for i, x in enumerate(texts[0]):
            for j, y in enumerate(texts[1]):
                if of[0][0][i] == of[1][0][j] and any(x[k : k + L] in y for k in range(len(x) - L + 1)):
                    shares += 1
                    assert ((got[0][i] == got[1][j]) & (got[0][i] != 0)).any()
    assert shares > 20


def test_shared_anchors_come_packed(spark):
    """A row for each pair of parts at most, not one for each document in each of them."""
    texts = [prose(1, 400)] * 60
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = S._shared_anchors(documents(spark, texts)).collect()
    assert sum(len(set(r.ids)) for r in rows) > len(rows) and len(rows) <= parts * (parts + 1)
    assert {i for r in rows for i in r.ids} == set(range(1, 61))
    assert all((S._dealt(np.array(r.ids), parts) == r.part).all() for r in rows)
    got = spark.createDataFrame([(i,) for i in (-(2**63), -7, 0, 5, 2**40, 2**63 - 1)], "id long").withColumn("part", S._part(F.col("id"), parts))
    assert all(S._dealt(np.array([r.id]), parts)[0] == r.part for r in got.collect())


def test_texts_are_cut_together():
    """Many short texts make few pieces, and a piece gives the runs and anchors that its texts give alone."""
    rnd = np.random.default_rng(4)
    for alphabet in (1, 2, 60):
        texts = [rnd.integers(0, alphabet, n).astype(np.uint8).tobytes() for n in [50, 51, *rnd.integers(50, 400, 60).tolist(), 3000, 50]]
        pieces = list(S._together(texts, 2000))
        assert [k for first, stop, *_ in pieces for k in range(first, stop)] == list(range(len(texts))) and len(pieces) < len(texts) / 3
        for first, stop, data, starts in pieces:
            assert data == b"".join(texts[first:stop])
            x = np.frombuffer(data, np.uint8)
            alone = [S.runs(np.frombuffer(t, np.uint8)) for t in texts[first:stop]]
            hashes, *places = (np.concatenate(c) for c in zip(*alone, strict=True))
            shift = np.repeat(starts, [len(c[0]) for c in alone])
            got = S.runs(x, starts)
            assert (got[0] == hashes).all() and all((a == b + shift).all() for a, b in zip(got[1:], places, strict=True))
            alone = [S.anchors(np.frombuffer(t, np.uint8)) for t in texts[first:stop]]
            assert S.anchors(x, starts)[0].tolist() == [p + s for (own, _), s in zip(alone, starts.tolist(), strict=True) for p in own.tolist()]
            assert (S.anchors(x, starts)[1] == np.concatenate([h for _, h in alone])).all()


def test_batches_of_two_rows(spark, monkeypatch):
    """A class and its bytes come in two batches; rows of one id, of none and of no text stand among texts that are cut together."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(S, "CUT_BYTES", 300)
    monkeypatch.setattr(S, "SHARD_BYTES", 300)
    rnd = random.Random(9)
    pool = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(30, 90))) for _ in range(8)]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, 4))) for _ in range(30)]
    rows = [(k // 2 if k % 7 else None, t if k % 11 else None) for k, t in enumerate(texts)]
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        got = found(S.repeat_digest(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        spark.conf.set(key, before)
    assert got == brute(rows) and any(r[2] for r in got)


def test_united_runs_of_many_rows():
    rnd = np.random.default_rng(6)
    row, starts = np.sort(rnd.integers(0, 5, 60)), rnd.integers(0, 400, 60)
    stops = starts + rnd.integers(1, 30, 60)
    whole = np.zeros((5, 500), bool)
    for r, a, z in zip(row, starts, stops, strict=True):
        whole[r, a:z] = True
    edges = np.diff(np.pad(whole, ((0, 0), (1, 1))).astype(int), axis=1)
    expected = [[*np.nonzero(edges == 1)], np.nonzero(edges == -1)[1]]
    got = S.united(row, starts, stops)
    assert (got[0] == expected[0][0]).all() and (got[1] == expected[0][1]).all() and (got[2] == expected[1]).all()
    assert all(len(c) == 0 for c in S.united(*[np.empty(0, np.int64)] * 3))
