"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are words and their PREFIXES (invented and inflected words share those), each also
as "occurs LEVELS times or more"; the vocabulary is the TERMS terms whose association with the label is strongest
(log-likelihood ratio) among at most EXAMPLES labelled documents of each class.
Inverse document frequencies count all documents.  The examples' vectors form an
inverted index whose postings are cut into blocks of BLOCK examples; for every term
and block the largest weight is known, so a query bounds each block's best cosine,
visits blocks from the highest bound, and stops once the bound falls below its
NEIGHBOURS-th best: the neighbours found are exact.  Their votes are weighed by
squared cosine; a logistic map fitted on the examples (each without itself), with
the classes' shares put back, turns the vote into a probability.  The neighbours'
ids are the evidence.

Results: a text without vocabulary terms (null and empty ones too) has no
neighbours and gets the score of an empty vote; equal cosines are broken by the
order of the examples; repeated rows get equal results; rows without a label or id
are scored but not learned from; with no labels of one class every score is the share
of label 1 (0.5 without any labels); very long texts count whole; an empty table of documents gives an
empty result; columns other than doc_id and text, of any name, are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_chunks, learn_fold, map_texts, slices, small_batches
from quarry.llm.decontaminate import WORD_BYTES
from quarry.llm.quality_mil import training_rows

EXAMPLES = 4000
TERMS = 4096
PREFIXES = (4, 5, 6)
LEVELS = (2, 3, 5)
LEAST_DOCS = 3
LEAST_RATIO = 30.0  # log-likelihood ratio of a term that counts as associated
NEIGHBOURS = 15
BLOCK = 128
FIRST_BLOCKS = 4  # visited first; then four times as many in each further step
PRIOR_WEIGHT = 0.05
CACHED = 300_000


def term_names(word: bytes) -> list[bytes]:
    """The terms of a word: itself, and its longer prefixes with a mark no word holds."""
    return [word] + [word[:n] + b"*" for n in PREFIXES if len(word) > n]


def level_names(name: bytes, count: int) -> list[bytes]:
    """The term, and it with the number of each of LEVELS that its count reaches."""
    return [name] + [b"%s#%d" % (name, n) for n in LEVELS if count >= n]


class Terms(dict):
    """word -> numbers of those of its terms that the vocabulary holds at any level; forgets all when it has CACHED words."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        plain = dict.fromkeys(t.split(b"#")[0] for t in vocabulary)
        self.number = {t: k for k, t in enumerate(plain)}
        # a row for each term: its places in the vocabulary from one occurrence on, from LEVELS on, or -1
        self.places = np.array([[vocabulary.get(x, -1) for x in level_names(t, max(LEVELS))] for t in plain], np.int64)
        self.places = self.places.reshape(-1, 1 + len(LEVELS))

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHED:
            self.clear()
        found = tuple(self.number[t] for t in term_names(word) if t in self.number)
        if len(word) < 64:
            self[word] = found
        return found

    def count(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary terms of a text, ascending, and how often each occurs (a level's term: once)."""
        hits: list[int] = []
        for chunk in byte_chunks(text.translate(WORD_BYTES)):
            for found in filter(None, map(self.__getitem__, chunk.split())):
                hits += found
        own, n = np.unique(np.array(hits, np.int64), return_counts=True)
        reached = n[:, None] >= np.array([1, *LEVELS])
        terms = self.places[own]
        often = np.where(np.arange(1 + len(LEVELS)) == 0, n[:, None], 1)
        there = reached & (terms >= 0)
        order = np.argsort(terms[there])
        return terms[there][order], often[there][order]


class Index:
    """Unit vectors of the examples, by term, in blocks of examples."""

    def __init__(self, idf: np.ndarray, counted: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray):
        self.idf = idf
        vectors = [self.vector(*c) for c in counted]
        # examples whose heaviest terms agree stand together, which makes the blocks' bounds tight
        heavy = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self.order = np.argsort(np.array(heavy, np.int64), kind="stable")
        self.labels = labels[self.order]
        n = len(vectors)
        self.blocks = max(1, -(-n // BLOCK))
        term = np.concatenate([vectors[i][0] for i in self.order] or [np.empty(0, np.int64)])
        weight = np.concatenate([vectors[i][1] for i in self.order] or [np.empty(0)])
        example = np.repeat(np.arange(n), [len(vectors[i][0]) for i in self.order])
        by = np.lexsort((example, term))
        term, self.weight, self.example = term[by], weight[by], example[by]
        cell = term * self.blocks + self.example // BLOCK
        self.first = np.searchsorted(cell, np.arange(len(idf) * self.blocks + 1))
        best = np.zeros(len(idf) * self.blocks)
        np.maximum.at(best, cell, self.weight)
        self.best = best.reshape(len(idf), self.blocks)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(counts)) * self.idf[terms]
        return terms, w / max(1e-12, np.sqrt((w * w).sum()))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples (but ``without``) of the highest cosines above 0, and those; ties by number."""
        found, cosines = np.empty(0, np.int64), np.empty(0)
        if not len(terms):
            return found, cosines
        bound = weights @ self.best[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        step = FIRST_BLOCKS
        while len(order):
            # the blocks whose bound may still reach the k-th best, some at a time
            some, order = order[:step], order[step:]
            cell = (terms[:, None] * self.blocks + some).ravel()
            low, n = self.first[cell], self.first[cell + 1] - self.first[cell]
            at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            dots = np.bincount(self.example[at], self.weight[at] * np.repeat(np.repeat(weights, len(some)), n), len(self.labels))
            if without >= 0:
                dots[without] = 0
            there = np.flatnonzero(dots > 0)
            found, cosines = np.r_[found, there], np.round(np.r_[cosines, dots[there]], 12)
            best = np.lexsort((found, -cosines))[:k]
            found, cosines = found[best], cosines[best]
            if len(found) == k:
                order = order[bound[order] >= cosines[-1] - 1e-11]
            step *= 4
        return found, cosines


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Votes:
    """Weighted votes of the nearest examples and their calibration."""

    def __init__(self, index: Index, vocabulary: dict[bytes, int], ids: list, share: float):
        self.index, self.vocabulary = index, vocabulary
        self.ids = [ids[i] for i in index.order]
        self.slope, self.offset = 1.0, 0.0
        self.base = index.labels.mean()
        self.share = share

    def vote(self, near: np.ndarray, cosines: np.ndarray) -> float:
        """Log odds of the neighbours' votes, with PRIOR_WEIGHT for the examples' own share of label 1."""
        w = cosines * cosines
        yes = float((w * self.index.labels[near]).sum()) + PRIOR_WEIGHT * self.base
        no = float((w * (1 - self.index.labels[near])).sum()) + PRIOR_WEIGHT * (1 - self.base)
        return float(np.log(yes / no))

    def calibrate(self, counted: list) -> Votes:
        x = np.zeros(len(counted))
        for place, i in enumerate(self.index.order):
            x[place] = self.vote(*self.index.nearest(*self.index.vector(*counted[i]), NEIGHBOURS, without=place))
        y = self.index.labels
        # the examples weigh as much as their classes do among all labelled documents
        weight = np.where(y == 1, self.share / self.base, (1 - self.share) / (1 - self.base))
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps of a lightly penalised logistic regression
            p = _sigmoid(a * x + b)
            r, v = weight * (p - y), weight * p * (1 - p)
            g = np.array([(r * x).sum() + 0.1 * (a - 1), r.sum() + 0.01 * b])
            h = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
            d = np.linalg.solve(h, g)
            a, b = a - d[0], b - d[1]
            if np.abs(d).max() < 1e-9:
                break
        self.slope, self.offset = float(a), float(b)
        return self

    def score(self, terms: Terms, text: bytes) -> tuple[float, list]:
        near, cosines = self.index.nearest(*self.index.vector(*terms.count(text)), NEIGHBOURS)
        p = float(_sigmoid(self.slope * self.vote(near, cosines) + self.offset))
        return p, [self.ids[i] for i in near]


class Constant:
    """What is known without labels of both classes."""

    vocabulary: dict[bytes, int] = {}

    def __init__(self, share: float):
        self.share = share

    def score(self, terms: Terms, text: bytes) -> tuple[float, list]:
        return self.share, []


def _associated(rows: DataFrame, totals: np.ndarray) -> dict[bytes, int]:
    """The vocabulary: the TERMS terms of the highest log-likelihood ratio, from (y, text) rows."""

    def run(batches):
        held: dict[bytes, list[int]] = {}

        def counted():
            cols = [pa.array(held, pa.binary()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in (0, 1))]
            return pa.RecordBatch.from_arrays(cols, names=["term", "n0", "n1"])

        for b in slices(batches):
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found: Counter[bytes] = Counter()
                for w, n in Counter((text or b"").translate(WORD_BYTES).split()).items():
                    for t in term_names(w):
                        found[t] += n
                for t, n in found.items():
                    for x in level_names(t, n):
                        held.setdefault(x, [0, 0])[y] += 1
            if len(held) > 200_000:
                yield counted()
                held = {}
        if held:
            yield counted()

    counts = rows.select("__y", "text").mapInArrow(run, "term binary, n0 bigint, n1 bigint")
    counts = counts.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(f"n0 + n1 >= {LEAST_DOCS}")
    n = [float(x) for x in totals]
    part = F.lit(0.0)
    for y, c in enumerate(("n0", "n1")):
        expected = (F.col("n0") + F.col("n1")) * n[y] / sum(n)
        other = F.lit(n[y]) - expected
        part = part + F.when(F.col(c) > 0, F.col(c) * F.log(F.try_divide(F.col(c), expected))).otherwise(0.0)
        part = part + F.when(F.col(c) < n[y], (n[y] - F.col(c)) * F.log(F.try_divide(n[y] - F.col(c), other))).otherwise(0.0)
    best = counts.withColumn("ratio", F.round(2 * part, 6)).where(F.col("ratio") >= LEAST_RATIO)
    best = best.orderBy(F.desc("ratio"), "term").limit(TERMS)
    return {bytes(r["term"]): k for k, r in enumerate(best.select("term").collect())}


def _document_frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """How many of all documents hold each vocabulary term, and how many documents there are."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        terms, n = Terms(held.value), np.zeros(len(held.value) + 1, np.int64)
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                n[terms.count(text or b"")[0]] += 1
                n[-1] += 1
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(n[there], pa.int64())], names=["term", "n"])

    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "term bigint, n bigint")
    out = np.zeros(len(vocabulary) + 1)
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most TERMS + 1 rows
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, fold: Column, per_class: int = EXAMPLES):
    """The index, votes and calibration, learned from labelled documents that ``fold`` doesn't hold out."""
    picked, share = training_rows(labels, "toxic", fold, per_class)
    if len({y for _, y in picked}) < 2:
        return Constant(share)
    spark = docs.sparkSession
    small_batches(spark)
    kind = labels.schema["doc_id"].dataType.simpleString()
    chosen = spark.createDataFrame(picked, f"__id {kind}, __y int")  # at most 2 * per_class rows
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    rows = rows.select("doc_id", "__y", F.col("text").cast("binary").alias("text"))
    vocabulary = _associated(rows, np.bincount([y for _, y in picked], minlength=2))
    frequency, n_docs = _document_frequencies(docs, vocabulary)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    held = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        terms = Terms(held.value)
        for b in slices(batches):
            got = [terms.count(t or b"") for t in b.column(2).to_pylist()]
            lists = [pa.array([g[k] for g in got], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], names=["doc_id", "y", "terms", "counts"])

    out = f"doc_id {kind}, y int, terms array<bigint>, counts array<bigint>"
    got = rows.mapInArrow(run, out).toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    y = np.array(got.column("y").to_pylist(), float)
    if len(set(y)) < 2:
        return Constant(share)
    counted = [
        (np.array(t, np.int64), np.array(c, np.int64))
        for t, c in zip(got.column("terms").to_pylist(), got.column("counts").to_pylist(), strict=True)
    ]
    return Votes(Index(idf, counted, y), vocabulary, got.column("doc_id").to_pylist(), share).calibrate(counted)


def score_toxicity(docs: DataFrame, model, columns: list) -> DataFrame:
    """``columns`` of every row with score, predicted (1 from 0.5 on) and neighbours (ids of the examples that voted)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        own = held.value
        terms = Terms(own.vocabulary)

        def work(text):
            score, near = own.score(terms, text)
            return score, int(score >= 0.5), near

        return work

    return map_texts(docs, make, f"score double, predicted int, neighbours array<{kind}>", columns, binary=True)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    fold = learn_fold("doc_id", 5, 0)
    return score_toxicity(docs, fit_toxicity(docs, labels, fold), ["doc_id", fold.alias("held_out")])
