"""Conversation trie against brute force; contraction of odd trees; long conversations over many partitions."""

import hashlib
import random
import re
import zlib

import pytest

from quarry.llm import prefix_trie as T
from quarry.llm import queries
from quarry.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def digest(role, text):
    role, text = role.encode(), text.encode()
    return hashlib.blake2b(len(role).to_bytes(8, "big") + role + text, digest_size=16).digest()


def brute(rows, rebuilt=True):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, digest(r or "", x or ""), r or "", x or ""))
    convs = {c: [v[3:] for v in sorted(x)] for c, x in convs.items()}
    if rebuilt:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        convs = {c: convs.get(c - c % 20, [])[: h[c]] + convs[c][h[c] :] for c in convs}
    members, kids, totals, out = {}, {}, {}, []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(members, key=len, reverse=True):
        saved, leaves = (len(members[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0), int(k not in kids)
        for x in kids.get(k, []):
            saved, leaves = saved + totals[x][0], leaves + totals[x][1]
        totals[k] = saved, leaves
        ends = ",".join(str(c) for c in sorted(c for c in members[k] if len(convs[c]) == len(k)))
        above = min(members[k[:-1]]) if k else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[k]), len(k), above, len(members[k]), len(kids.get(k, [])), leaves, saved, sha))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_rows():
    rows = [(c, t, "user", f"word {t % 3} x") for c in (0, 1, 2, 3, 4, 20, 21, 25, 39) for t in range(c % 5)]
    rows += [(40, None, "user", "no number"), (40, 1, None, None), (40, 2, "user", ""), (40, None, "user", "no number")]
    rows += [(41, 5, "user", "tie b"), (41, 5, "user", "tie a"), (41, 5, "bot", "tie a")]
    rows += [(42, 0, "u", "a" * 200_000 + " " + "b c " * 60_000), (43, 0, "u", "a" * 200_000 + " " + "b c " * 60_000)]
    rows += [(44, 0, "ab", "c"), (45, 0, "a", "bc"), (45, 0, "a", "bc")]  # borders of role and text count
    rows += [(None, 0, "user", "nobody"), (61, 0, "x", " \t\n\x0b\x0c\r "), (62, 0, "user", "日本 語 x")]
    rows += [(c, t, "user", "hot turn") for c in range(100, 160) for t in range(3)]
    return rows


@pytest.mark.parametrize("rebuilt", [True, False])
def test_odd_rows(spark, rebuilt):
    from pyspark.sql import functions as F

    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in "id parent key row pid idx acc words h heads".split()})
    got = T.conversation_trie(docs, period=20 if rebuilt else None)
    assert found(got) == brute(rows, rebuilt)


def test_empty_and_turnless(spark):
    assert found(T.conversation_trie(spark.createDataFrame([], SCHEMA), period=20)) == []
    # conversations with h >= 1 whose base is absent lose all of their turns
    rows = [(c, 0, "user", "only turn") for c in range(1, 20)]
    got = found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA), period=20))
    assert got == brute(rows) and len(got) == 2


def test_a_conversation_of_a_third_of_all_turns(spark):
    """Its run crosses partitions, its chain is compressed; texts repeat, so prefixes differ by place only."""
    rnd = random.Random(4)
    rows = [(20, t, "user", f"turn {t % 7}") for t in range(700)] + [(21, t, "user", f"turn {t % 7}") for t in range(500)]
    rows += [(c, t, "user", f"turn {t % 7}") for c in range(22, 60) for t in range(rnd.randrange(40))]
    rnd.shuffle(rows)
    assert found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA), period=20)) == brute(rows)


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(T, "kept_table", lambda df, tag, **k: kept.append(tag) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    n = 400
    tree = spark.createDataFrame([(f"{k:04}".encode(), f"{k - 1:04}".encode() if k else None, k, 1) for k in range(n)], "id binary, parent binary, w long, l long")
    got = {int(r.id): (r.w, r.l) for r in T.subtree_totals(tree).collect()}
    assert got == {k: (sum(range(k, n)), n - k) for k in range(n)}
    assert kept.count("tree") < 30


@pytest.mark.parametrize("seed", range(2))
def test_contraction_of_random_forests(spark, seed):
    rnd = random.Random(seed)
    up = {k: rnd.choice([k - 1, rnd.randrange(k), 0]) if k and rnd.random() > 0.03 else None for k in range(150)}
    weight = {k: rnd.randrange(100) for k in up}
    want = {k: [weight[k], 1] for k in up}
    for k in sorted(up, reverse=True):
        if up[k] is not None:
            want[up[k]] = [a + b for a, b in zip(want[up[k]], want[k], strict=True)]
    rows = [(str(k).encode(), None if up[k] is None else str(up[k]).encode(), weight[k], 1) for k in up]
    got = T.subtree_totals(spark.createDataFrame(rows, "id binary, parent binary, w long, l long"))
    assert {int(r.id): [r.w, r.l] for r in got.collect()} == want


def test_id_lists_in_several_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "LIST_BYTES", 40)
    rows = [(c, 0, "user", "same") for c in range(100, 100 + 200)]
    assert found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_words_in_pieces(monkeypatch):
    text = " a\tbc\n\n d\x0b\x0c\re日 f ".encode()
    for piece in (1, 2, 3, 7, 100):
        monkeypatch.setattr(T, "PIECE", piece)
        assert T.count_words(text) == 5 and T.count_words(b"") == 0 and T.count_words(b" ") == 0 and T.count_words(b"x") == 1


def test_query_on_the_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op11_conversation_trie"](spark, sf_dir)) == brute(rows)
