"""Segmentation-marginalised unigrams against explicit sums; held-out accuracy; odd rows."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import language_id as L
from quarry.llm import queries
from quarry.llm.common import learn_fold, table
from tests.llm.data import nothing, odd_documents

P = pytest.importorskip("public_tokenizers")
PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return L.pieces_of(PATH)


def plain_total(word, pieces, probability):
    number = {p: k for k, p in enumerate(pieces)}

    @functools.cache
    def rest(i):
        if i == len(word):
            return 1.0
        total = 0.0
        for j in range(i + 1, min(len(word), i + L.LONGEST) + 1):
            k = number.get(word[i:j])
            if k is not None:
                total += probability[k] * rest(j)
            elif j == i + 1:
                total += probability[-1] * rest(j)
        return total

    return rest(0)


WORDS = [L.MARK + w for w in ("the", "a", "international", "ß日x", "zzzzzzzz", "übergrößenträger", "e" * 32, "\U0001f600x", "q")]


def test_totals_sum_all_segmentations(pieces):
    p = np.random.default_rng(0).random(len(pieces) + 1) / 1000
    lattices = L.Lattices(L.Trie(pieces), WORDS)
    got = lattices.totals(p[lattices.piece][:, None])[:, 0]
    want = [plain_total(w, pieces, p) for w in WORDS]
    assert np.allclose(got, want, rtol=1e-9, atol=0)


def test_expected_uses_cover_the_word(pieces):
    p = np.random.default_rng(1).random(len(pieces) + 1) / 1000
    lattices = L.Lattices(L.Trie(pieces), WORDS)
    used = lattices.expected(p[lattices.piece][:, None])
    assert np.allclose(np.bincount(lattices.word, used * (lattices.end - lattices.start)), lattices.sizes)
    # the derivative of the log total by a piece's log probability is its expected use
    w, k = WORDS[2], next(int(x) for x, n in zip(lattices.piece, lattices.word, strict=True) if n == 2 and x >= 0)
    e, q = 1e-6, p.copy()
    q[k] *= 1 + e
    slope = (np.log(plain_total(w, pieces, q)) - np.log(plain_total(w, pieces, p))) / e
    assert abs(slope - used[(lattices.word == 2) & (lattices.piece == k)].sum()) < 1e-4


def test_trie_finds_all_pieces(pieces):
    lattices = L.Lattices(L.Trie(pieces), pieces[:3000])
    whole = (lattices.start == 0) & (lattices.end == lattices.sizes[lattices.word])
    assert dict(zip(lattices.word[whole].tolist(), lattices.piece[whole].tolist(), strict=True)) == {k: k for k in range(3000)}


def test_words_of_any_chunk(monkeypatch):
    text = "Été d'Amour 123 x_y\nßß " + "w" * 70 + " end"
    whole = [w for some in L.words_of(text) for w in some]
    monkeypatch.setattr(L, "CHUNK", 3)
    assert [w for some in L.words_of(text) for w in some] == whole
    assert whole[:3] == ["été", "d", "amour"] and [len(p) for p in L.parts_of("w" * 70)] == [33, 33, 7]


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = queries.QUERIES["op10_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and len(held) > 20
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_languages_do_not_matter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(60).cache()
    other = docs.withColumn("lang", F.when(learn_fold("doc_id", 4, 2), F.lit("xx")).otherwise(F.col("lang")))
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in L.identify(d, PATH).collect()} for d in (docs, other))
    assert a == b


def test_small_cache(spark, pieces, monkeypatch):
    models = L.Models(["a", "b"], pieces, np.array([2.0, 1.0]))
    models.probability[:, 1] *= np.random.default_rng(2).random(len(pieces) + 1)
    texts = ["the quick brown fox", "", "quick quick fox " * 50, "über alles"]
    whole = L.Scorer(models).score(texts)
    monkeypatch.setattr(L, "CACHED", 2)
    small = L.Scorer(models)
    assert [small.score([t])[0][0] for t in texts] == [x[0] for x in whole]
    assert np.allclose([small.score([t])[0][1] for t in texts], [x[1] for x in whole])
    assert whole[1] == ("und", 0.0)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = {(r.doc_id, r.text): r for r in docs.collect()}
    got = L.identify(docs, PATH).collect()
    assert len(got) == docs.count()
    und = [r for r in got if r.lang_pred == "und"]
    assert len(und) == sum(not any(c.isalpha() for c in t or "") for _, t in [(r.doc_id, r.text) for r in docs.collect()]) and rows
    assert all(r.score == 0 for r in und) and {r.lang_pred for r in got} <= {"en", "de", "und"}
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.identify(blank, PATH).collect()} == {("und", 0.0)}
    assert L.identify(nothing(spark), PATH).count() == 0


def test_too_many_languages_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        L.fit_languages(odd_documents(spark), PATH, F.lit(False))


def test_latin_words_skip_the_pattern(monkeypatch):
    """Texts of the first 256 characters are split by a table, as the pattern would."""
    text = "".join(map(chr, range(256))) + " Straße café\xa0x\x85y µm 1ª n\xba aÃ\xadz_q9w"
    want = L._LETTERS.findall(text.lower())
    assert L._found("日本 " + text.lower())[1:] == want

    class Never:
        def findall(self, text):
            raise AssertionError(text)

    monkeypatch.setattr(L, "_LETTERS", Never())
    assert [w for some in L.words_of(text) for w in some] == want


def test_texts_are_scored_together(pieces, monkeypatch):
    """Words of a slice are looked up at once; groups cut by the cache or by chunks give the same sums."""
    models = L.Models(["a", "b", "c"], pieces, np.array([2.0, 1.0, 1.0]))
    models.probability *= np.random.default_rng(3).random(models.probability.shape)
    texts = ["the quick brown fox", "", "123", "word " * 300 + "x" * 100, "über alles 日本 x", "the"]
    whole = L.Scorer(models)
    calls = []
    real = L.Scorer._learn
    monkeypatch.setattr(L.Scorer, "_learn", lambda self, words: (calls.append(len(words)), real(self, words)))
    got = whole.score(texts)
    assert len(calls) == 1
    monkeypatch.setattr(L, "CACHED", 3)
    monkeypatch.setattr(L, "CHUNK", 7)
    for (lang, score), text in zip(got, texts, strict=True):
        words = [w for some in L.words_of(text) for w in some]
        total = models.prior + sum(np.log([plain_total(p, pieces, models.probability[:, k]) for k in range(3)]) for w in words for p in L.parts_of(w))
        odds = np.exp(total - total.max())
        want = (models.languages[int(np.argmax(total))], float(odds.max() / odds.sum())) if words else ("und", 0.0)
        assert lang == want[0] and abs(score - want[1]) < 1e-9
        again = L.Scorer(models).score([text])[0]
        assert again[0] == lang and abs(again[1] - score) < 1e-9
