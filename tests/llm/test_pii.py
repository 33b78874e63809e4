"""Personal data against finditer; disclosure against plain counts."""

import hashlib
import math
import re
from collections import Counter

import pytest

from quarry.llm import pii, queries
from quarry.llm.common import table
from tests.llm.data import documents, nothing, odd_documents, prose

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(x) <= 255 for x in text.split("."))
    if kind == 2:
        total = sum(d - 9 * (d > 9) for d in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text or "") if holds(k, m[0]))


TEXTS = [
    "a@b@c.d.e x@y.zz@q.com é.é@x.y %@-.- @a.b a@.b a@b a@b. a@b..c",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.02.003.255 0000000255.1.1.1 1.1.1.1234 1.1.1..1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 4111111111111112 " + "4" * 40 + " 12345678901234567890123",
    "+1 (555) 123-4567 ++1234567890 +12- +44 20 7946 0958. +1234567890123456 +(5)",
    "mail me: joe@example.com or +1 555 123 4567, 10.0.0.1",
    "." * 1000 + "@", "1" * 5000, "a" * 5000 + "@",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_those_of_finditer(text):
    assert [s[:3] for s in pii.base_spans(text)] == brute(text)


def test_query_on_the_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = queries.QUERIES["op8_pii_sanitisation"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        base = brute(docs[r.doc_id])
        said = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(said) <= set(every) and len(every) == len(said) + r.n_term


def corpus():
    """'Zanzibar' stands by one address only, 'office' by any, 'rareword' near it once."""
    out = []
    for k in range(60):
        if k % 10 == 0:
            out.append(f"{prose(k, 8)} zanzibar office ann@example.com {prose(k + 100, 12)} Zanzibar {prose(k, 5)}")
        elif k % 10 == 1:
            out.append(f"{prose(k, 8)} office bob{k}@example.com {prose(k + 100, 30)}")
        else:
            out.append(f"{prose(k, 30)} office")
    out.append(f"rareword ann@example.com {prose(500, 20)}")
    return out


def wilson(both, docs):
    p, z = both / docs, pii.Z
    return (p + z * z / (2 * docs) - z * math.sqrt(p * (1 - p) / docs + z * z / (4 * docs * docs))) / (1 + z * z / docs)


def lower_bounds(texts):
    """{(text number, term): disclosure} of all pairs that reach GENERALISE, by loops over the documents."""
    own = [(pii.base_spans(t or ""), t or "") for t in texts]
    own = [{(x["entity"], x["term"]) for x in pii.near_terms(t, s)} for s, t in own]
    both, holders, docs = Counter(), Counter(), Counter()
    for pairs, text in zip(own, texts, strict=True):
        both.update(pairs)
        holders.update({e for e, _ in pairs})
        docs.update({m.lower() for m in re.findall(r"[^\W\d_]+", text or "")})
    out, n = {}, len(texts)
    for k, pairs in enumerate(own):
        for e, t in pairs:
            value = wilson(both[e, t], docs[t])
            if round(value, 6) >= pii.GENERALISE and math.log2(value * n / holders[e]) >= pii.LIFT:
                out[k, t] = max(out.get((k, t), 0), round(value, 6))
    return out


def test_disclosing_terms(spark):
    texts = corpus()
    want = lower_bounds(texts)
    named = {t for _, t in want}
    assert "zanzibar" in named and "office" not in named and "rareword" not in named
    got = {r.doc_id: r.spans for r in pii.find_private(documents(spark, texts, 0)).collect()}
    for n, text in enumerate(texts):
        marked = {text[s.start : s.end].lower() for s in got[n] if pii.KINDS[s.kind] == "term"}
        assert marked == {t for k, t in want if k == n}
        assert [(s.start, s.kind, s.end) for s in got[n]] == sorted((s.start, s.kind, s.end) for s in got[n])
    both = [s for s in got[0] if pii.KINDS[s.kind] == "term" and texts[0][s.start : s.end].lower() == "zanzibar"]
    assert len(both) == 2  # all its places in a document that holds the address


def test_sanitised_texts(spark):
    texts = [*corpus(), None, ""]
    got = {r.doc_id: r.text for r in pii.sanitise(documents(spark, texts, 0)).collect()}
    assert len(got) == len(texts) and got[61] is None and got[62] == ""
    assert "zanzibar" not in got[0].lower() and "ann@" not in got[0] and "[EMAIL]" in got[0]
    assert got[2] == texts[2]
    assert pii.sanitise_text("ab cd ef", [{"start": 3, "end": 5, "kind": 4, "disclosure": 0.35}]) == "ab [TERM] ef"
    assert pii.sanitise_text("ab cd ef", [{"start": 3, "end": 5, "kind": 4, "disclosure": 0.42}]) == "ab  ef"


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = pii.private_digest(docs).collect()
    assert len(got) == docs.count() and all(r.spans == "" for r in got)
    assert pii.private_digest(nothing(spark)).count() == 0
    assert pii.sanitise(docs).count() == docs.count()
    every = pii.find_private(documents(spark, ["same a@b.cc word"] * 5)).collect()  # in all documents: no information
    assert all(len(r.spans) == 1 for r in every)


def test_term_spans_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    texts, at = dict(rows), {i: k for k, (i, _) in enumerate(rows)}
    want = lower_bounds([t for _, t in rows])
    marked = set()
    for r in queries.QUERIES["op8_pii_sanitisation"](spark, sf_dir).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("term")]
        marked |= {(at[r.doc_id], texts[r.doc_id][int(a) : int(b)].lower()) for _, a, b in spans}
    assert marked == want.keys() and marked
    assert any(v >= pii.REMOVE for v in want.values())
    words = sum(len(re.findall(r"[^\W\d_]+", t or "")) for _, t in rows)
    assert len(marked) < 0.02 * words


def test_evidence_and_not_rarity(spark):
    """Planted: words that go with an address in several documents, and rare words that stand beside one once."""
    texts = [f"{prose(k, 30)} office" for k in range(60)]
    texts += [f"platypus {prose(90, 40)} joe@example.com sue@example.com {prose(91, 40)} wombat office"]
    texts += [f"quokka {prose(92 + k, 20)} ann@example.com" for k in range(2)]
    texts += [f"numbat {prose(95 + k, 20)} bob@example.com" for k in range(3)] + ["numbat elsewhere"]
    for times in (1, 4):  # the same pairs in a corpus of four times the size
        corpus = texts + [prose(1000 + k, 30) for k in range((times - 1) * len(texts))]
        got = {r.doc_id: r.spans for r in pii.find_private(documents(spark, corpus, 0)).collect()}
        terms = {(k, corpus[k][s.start : s.end].lower(), s.disclosure) for k, x in got.items() for s in x if pii.KINDS[s.kind] == "term"}
        assert terms == {(k, t, v) for (k, t), v in lower_bounds(corpus).items()}
        verdicts = {t: v >= pii.REMOVE for _, t, v in terms if t in ("platypus", "wombat", "quokka", "numbat", "office")}
        assert verdicts == {"quokka": True, "numbat": False}
