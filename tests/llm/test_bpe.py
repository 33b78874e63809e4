"""Byte-level BPE against the public library; the queue against a scan; round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import bpe, queries
from tests.llm.data import nothing, odd_documents, prose, rows

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.BytePairCoder(bpe.read_ranks(PATH), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


TEXTS = ["", " ", "a", "\n\n  x  ", "Hello world's  été\t\n 123 !!! <|endoftext|>", "  " * 100 + "x", "日本語テキスト😀",
         "abc" * 3000, "ab " * 100000 + "  \n q", "aaaaaaaaaaaaa" * 500, prose(1, 3000), "   x 　", "'S 's 'LL 'll"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_round_trip(coder, reference, text):
    ids = reference.encode_ordinary(text)
    assert list(coder.encode(text)) == ids and coder.decode(ids) == text.encode()
    n, a, b = coder.digest(text)
    assert n == len(ids)
    assert a == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert b == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80))
def test_queue_and_scan_agree(coder, piece):
    assert coder.merge(piece) == scanned(coder.ranks, piece)
    assert not coder.queue.top and not coder.queue.buckets


def scanned(ranks, piece):
    """Ids of a pre-token by looking for the lowest-ranked, leftmost pair again and again."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_every_pretoken_that_is_no_token_meets_the_queue(monkeypatch, sf_dir, spark):
    """On the texts of the table, each pre-token is a token or is merged from what the queue hands out."""
    from quarry.llm.common import table

    own = bpe.BytePairCoder(bpe.read_ranks(PATH), P.PATTERN)
    taken = [0]
    take = own.queue.take
    monkeypatch.setattr(own.queue, "take", lambda: taken.__setitem__(0, taken[0] + 1) or take())
    by_queue = 0
    for r in table(spark, sf_dir, "documents").collect():
        for piece in own.find(r.text or ""):
            taken[0] = 0
            ids = own.merge(piece.encode())
            assert (taken[0] > 0) == (piece.encode() not in own.ranks)
            assert taken[0] >= len(piece.encode()) - len(ids) or piece.encode() in own.ranks
            by_queue += taken[0] > 0
    assert by_queue > 10_000


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(coder, reference, text):
    assert list(coder.encode(text)) == reference.encode_ordinary(text)


def test_chunks_do_not_cut_tokens(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 7)
    small = bpe.BytePairCoder(bpe.read_ranks(PATH), P.PATTERN)
    for text in (prose(3, 200), "a  \n b   c\t\td", " " * 50, "x" * 50 + "   y"):
        assert list(small.encode(text)) == reference.encode_ordinary(text)


def test_cache_that_overflows(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    small = bpe.BytePairCoder(bpe.read_ranks(PATH), P.PATTERN)
    for seed in range(20):
        ids = reference.encode_ordinary(prose(seed, 50))
        assert small.digest(prose(seed, 50))[0] == len(ids)


def test_rank_queue_orders_ranks_then_positions():
    q = bpe.RankQueue(300000)
    for rank, position in ((70000, 3), (5, 9), (70000, 1), (299999, 0), (5, 2)):
        q.push(rank, position)
    out = []
    while (x := q.take())[0] >= 0:
        out.append(x)
    assert out == [(5, 2), (5, 9), (70000, 1), (70000, 3), (299999, 0)]


def test_query_and_odd_rows(spark, sf_dir, reference):
    from quarry.llm.common import table

    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    for r in queries.QUERIES["op4_byte_bpe"](spark, sf_dir).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    odd = bpe.round_trip(odd_documents(spark), PATH, P.PATTERN).collect()
    assert sorted(r.decoded_sha256 for r in odd) == sorted(hashlib.sha256((x[1] or "").encode()).hexdigest() for x in rows())
    assert bpe.round_trip(nothing(spark), PATH, P.PATTERN).count() == 0


def test_texts_come_back(spark):
    docs = odd_documents(spark)
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(x[0]), x[1] or "") for x in rows())
