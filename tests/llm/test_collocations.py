"""Collocations against brute force: borders, blocks, forced collisions, odd rows."""

import random
import re
from collections import Counter

import pytest

from quarry.llm import collocations as K
from quarry.llm import queries
from quarry.llm.common import table
from tests.llm.data import lower_ascii, nothing, odd_documents

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD = re.compile(r"[^\x20\x09]+")
COLUMNS = "lang rank phrase a l r n score".split()


def brute(rows, least=100, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in PIECE.split(lower_ascii(text)):
            w = WORD.findall(piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        often = {p: c for p, c in count.items() if c >= least}
        best = []
        for p, a in often.items():
            if len(p) < 2 or any(
                len(o) > len(p) and 100 * c >= 100 * a and any(o[i : i + len(p)] == p for i in range(len(o) - len(p) + 1))
                for o, c in often.items()
            ):
                continue
            cuts = [(1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def texts(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "日本", "a.b", "x\ty", "N\x0bm", "İ", "A  B", "\x00", "?!"]
    fixed = ["New York city hall of fame", "kick the bucket", "a a a a a a a"]
    out = []
    for k in range(n):
        words = [rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(vocabulary) for _ in range(rnd.randrange(60))]
        out.append((["en", "de", None, "und"][k % 4], " ".join(w + rnd.choice(["", "", "", ",", "\n", " "]) for w in words)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(k, t, g) for k, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")


@pytest.mark.parametrize("least,top", [(5, 2000), (20, 7)])
def test_brute_force(spark, least, top):
    rows = texts(1)
    assert found(K.collocations(frame(spark, rows), least, top)) == brute(rows, least, top)


def test_blocks_of_words(spark, monkeypatch):
    """Long texts in blocks of 16 words, aggregated 50 n-grams at a time."""
    monkeypatch.setattr(K, "BLOCK_WORDS", 16)
    monkeypatch.setattr(K, "BLOCK_GRAMS", 50)
    rows = texts(2, 60) + [("en", ("kick the bucket " * 200 + ". ") * 2)]
    assert found(K.collocations(frame(spark, rows), 6)) == brute(rows, 6)


def test_collisions_are_counted_by_words(spark, monkeypatch):
    """With 7 bits of the first fingerprint nearly every phrase collides; the result stays the same."""
    rows = texts(3)
    monkeypatch.setattr(K, "FINGERPRINT_BITS", 7)
    assert found(K.collocations(frame(spark, rows), 10)) == brute(rows, 10)


@pytest.mark.parametrize("size", [7, 16, 500_000])
def test_blocks_hold_each_gram_once(size):
    text = texts(4, 1)[0][1] + " kick the bucket" * 40
    whole = [w for w in text.encode().translate(K._SPACES).replace(b"\n", b" \n ").split(b" ") if w]
    for n in range(1, 6):
        got = [tuple(w[i : i + n]) for _, w, new in K.split_blocks(text.encode(), size) for i in range(min(new, len(w) - n + 1))]
        assert got == [tuple(whole[i : i + n]) for i in range(len(whole) - n + 1)]
    assert all(w[0] == whole[first] for first, w, _ in K.split_blocks(text.encode(), size))


def test_fingerprints_do_not_depend_on_the_place():
    a, b = K.Grams(64, 100), K.Grams(64, 100)
    a.block("en", b"x y kick the bucket z".split())
    b.block("en", b"kick the bucket".split())
    import numpy as np

    for f in ("first", "second"):
        assert getattr(a, f)(3, np.array([2])) == getattr(b, f)(3, np.array([0]))
        assert getattr(a, f)(2, np.array([2])) != getattr(a, f)(2, np.array([3]))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert found(K.collocations(docs, 100)) == brute(rows, 100)
    assert found(K.collocations(nothing(spark))) == []


@pytest.mark.parametrize("least", [1, 300])
def test_thresholds_around_the_counters(spark, monkeypatch, least):
    """Cells that many n-grams share, and counts beyond what a counter holds."""
    monkeypatch.setattr(K, "CELLS", K.REGION)
    rows = [("en", "a b c, " * 310), ("de", "a b " * 299 + "c d"), ("en", "x y"), (None, "a b c " * 400)]
    assert found(K.collocations(frame(spark, rows), least)) == brute(rows, least)


def test_scores_past_64_bits(spark):
    big = 4 * 10**15
    phrases = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big - 7), ("en", 2, "a b", big - 9)], "lang string, n int, phrase string, count long")
    totals = spark.createDataFrame([("en", 9 * 10**15)], "lang string, words long")
    got = K._scored(phrases, totals).first()
    assert got.score == 1000 * (big - 9) * 9 * 10**15 // (big * (big - 7))


def test_query_on_the_table(spark, sf_dir):
    rows = [(r.lang, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert found(queries.QUERIES["op12_collocations"](spark, sf_dir)) == brute(rows)
