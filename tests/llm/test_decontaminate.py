"""Contamination against a search of every window in every document."""

import hashlib
import re

import pytest

from quarry.llm import decontaminate as D
from quarry.llm import queries
from tests.llm.data import documents, lower_ascii, nothing, odd_documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, bench):
    windows: dict[tuple, set] = {}
    for item, text in bench:
        w = WORD.findall(lower_ascii(text))
        own = [tuple(w[k : k + 13]) for k in range(len(w) - 12)] if len(w) >= 13 else [tuple(w)] if w else []
        for x in own:
            windows.setdefault(x, set()).add(item)
    out = []
    for i, text in docs:
        w = WORD.findall(lower_ascii(text))
        hit, items = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    items |= windows[x]
                    hit[k : k + n] = [True] * n
        names = ",".join(sorted(map(str, items)))
        out.append((i, len(w), sum(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=str)


def judged(df):
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


BENCH = [(1, prose(1, 40)), (2, "one two"), (3, None), (4, ""), (5, prose(1, 20)), (5, prose(9, 15)), (6, "alpha alpha " * 10),
         (7, prose(2, 5000)), (10, "日本語 text"), (None, prose(12, 14))]


def planted(spark):
    p = prose(1, 40).split()
    return [
        prose(20, 30) + " " + " ".join(p[:13]).upper() + " " + prose(21, 30),
        prose(22, 30) + " " + " ".join(p[:12]) + " " + prose(23, 30),
        " ".join(p[5:18]) + ", " + " ".join(p[6:30]),
        "One, TWO! one two two one two",
        "alpha " * 40,
        prose(24, 600) + " " + " ".join(p[:13]),
        "\x00one\x7ftwo 日本語-text",
        prose(2, 5000),
    ]


def test_planted_cases(spark):
    texts = planted(spark)
    got = judged(D.contamination(documents(spark, texts), bench_of(spark, BENCH)))
    assert got == brute(list(enumerate(texts, 1)), BENCH)


@pytest.mark.parametrize("words", [1, 50, 1000])
def test_segments_blocks_and_parts_of_any_size(spark, monkeypatch, words):
    monkeypatch.setattr(D, "SEGMENT_WORDS", words)
    monkeypatch.setattr(D, "BLOCK_WORDS", 60)
    monkeypatch.setattr(D, "PART_WORDS", 20)
    texts = planted(spark)
    index = D.benchmark_parts(bench_of(spark, BENCH))
    assert index.count() > 200  # the long item has many parts
    bench = BENCH[:7]  # (fewer blocks)
    assert judged(D.contamination(documents(spark, texts), bench_of(spark, bench))) == brute(list(enumerate(texts, 1)), bench)


def test_many_candidates_of_frequent_terms(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(D, "CANDIDATES", 10)
    terms = np.array([3, 5, 3, 5, 3, 5, 3, 5, 3, 5, 3, 5, 3, 5])
    block = D.Block([(0, terms, 0)])
    slots = np.r_[np.arange(0, 60, 2), np.arange(1, 60, 2)].astype(np.int32)
    window, start = D.phrases(block, np.array([0, 1]), np.array([0, 30, 60]), slots)
    assert sorted(zip(window.tolist(), start.tolist(), strict=True)) == sorted((k % 2, k) for k in range(48))


def test_query_on_the_table(spark, sf_dir):
    from quarry.llm.common import table

    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    bench = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    got = judged(queries.QUERIES["op5_decontamination"](spark, sf_dir))
    assert got == brute(docs, bench) and any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    own = [(r.doc_id, r.text) for r in docs.collect()]
    assert judged(D.contamination(docs, bench_of(spark, BENCH))) == brute(own, BENCH)
    none = judged(D.contamination(docs, bench_of(spark, [])))
    assert none == brute(own, [])
    assert D.contamination(nothing(spark), bench_of(spark, BENCH)).count() == 0
    kept = D.drop_contaminated_rows(docs, bench_of(spark, BENCH))
    assert kept.columns == docs.columns
    bad = {r[0] for r in brute([(k, t) for k, (_, t) in enumerate(own)], BENCH) if r[-1]}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for k, (i, _) in enumerate(own) if k not in bad)


def test_proximity(spark):
    item = "quokka saw wombat near platypus " + prose(1, 10)
    close = "a quokka and then a platypus met the wombat " + prose(1, 10).replace(" ", " , ")
    far = "quokka " + "word " * 60 + "platypus " + "word " * 60 + "wombat " + prose(1, 10)
    bench = bench_of(spark, [(1, item)])
    got = {r.doc_id: r.near for r in D.match_documents(documents(spark, [close, far, prose(3, 20)]), bench).collect()}
    assert got == {1: [1], 2: [], 3: []}


def test_items_are_near_their_own_text_and_changed_copies(spark, sf_dir):
    """Each item of the table, of three terms, of repeated words, and one of several parts."""
    from quarry.llm.common import table

    items = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    items += ["quokka wombat platypus", "aye bee " * 30 + "sea", prose(40, 5000)]
    texts, want = [], {}
    for k, text in enumerate(items):
        words = text.split()
        copies = [text]
        for at in {0, len(words) // 2, len(words) - 1}:
            copies.append(" ".join([*words[:at], f"changed{k}x", *words[at + 1 :]]))
        for c in copies:
            texts.append(c)
            want[len(texts)] = k
    # two terms never lack one; all must meet
    items.append("lonely pair")
    texts += ["a pair that is lonely", "lonely"]
    want[len(texts) - 1] = len(items) - 1
    bench = bench_of(spark, list(enumerate(items)))
    got = {r.doc_id: r.near for r in D.match_documents(documents(spark, texts), bench).collect()}
    assert [i for i, k in want.items() if k not in got[i]] == []
    assert len(items) - 1 not in got[len(texts)]
