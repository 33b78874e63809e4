"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (SPAN bytes each, the whole text).  A passage
is described by the frequencies of pairs of neighbouring character classes, by
how much of it repeats inside the text, and by its length.  A layer encodes each
passage; gated attention (tanh and sigmoid gates) weighs the passages of a
document; the weighted representation gives the score.  Only document labels are
used to learn the encoder, the gates and the score together.

The model is fitted on at most TRAIN_DOCS labelled documents of each class
(those whose hashed ids are smallest; whole texts), which bounds what the driver
holds; every document is scored, with all of its passages.  Classes are weighed
evenly in fitting, and the score's offset then puts the classes' shares back.

Results: a null or empty text is one passage without characters, scored like any
other; repeated rows get equal scores; rows without a label or id are scored but not
learned from; with no labels of one class, every score is the share of label 1
(0.5 without any labels).  A text of more than BLOCK bytes is described block by
block, with the 8-byte strings of all blocks before; the features do not depend on
BLOCK.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import learn_fold, map_texts, slices, small_batches

SPAN = 512
BLOCK = 1 << 20
TRAIN_DOCS = 1500
ENCODED, GATES = 24, 12
EPOCHS, BATCH, RATE = 25, 64, 0.01
THRESHOLD = 0.7

_CLASSES = 12


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 0xC0:
        return 10
    if b >= 0x80:
        return 11
    if c.isalpha():
        return 1 if c.isupper() else 0
    if c.isdigit():
        return 2
    for k, some in ((3, " "), (4, "\n"), (5, ".,;:'\"?-()"), (6, "!"), (7, "#*$%&"), (8, "|<>")):
        if c in some:
            return k
    return 9


_CLASS = np.array([_class_of(b) for b in range(256)], np.uint8)
FEATURES = _CLASSES * _CLASSES + 4


class _Seen:
    """The distinct 8-byte strings of the blocks before, as sorted arrays of at least doubling length."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def holds(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), bool)
        for own in self.levels:
            out |= own[np.minimum(np.searchsorted(own, words), len(own) - 1)] == words
        return out

    def add(self, words: np.ndarray) -> None:
        while self.levels and len(self.levels[-1]) < 2 * len(words):
            words = np.union1d(self.levels.pop(), words)
        self.levels.append(words)


def _describe(data: np.ndarray, n: int, total: int, seen: _Seen) -> np.ndarray:
    """Features of the passages of one block of a text of ``total`` bytes: the first ``n`` of ``data``, which has 7 more if there are."""
    bags = max(1, -(-n // SPAN))
    out = np.zeros((bags, FEATURES), np.float32)
    size = np.full(bags, SPAN, np.float32)
    size[-1] = max(1, n - SPAN * (bags - 1))
    if len(data) > 1:
        cls = _CLASS[data[: n + 1]].astype(np.int32)
        passage = np.arange(len(cls) - 1, dtype=np.int32) // SPAN
        pair = passage * (_CLASSES * _CLASSES) + cls[:-1] * _CLASSES + cls[1:]
        pairs = np.bincount(pair, minlength=bags * _CLASSES * _CLASSES).reshape(bags, -1)
        out[:, :-4] = np.sqrt(pairs / size[:, None])
    if len(data) >= 8:
        grams = np.lib.stride_tricks.sliding_window_view(data, 8)
        word = np.ascontiguousarray(grams).view(np.uint64)[:, 0]
        words, first, which = np.unique(word, return_index=True, return_inverse=True)
        known = seen.holds(words)[which]
        start = first[which]
        at = np.arange(len(word))
        own = at // SPAN
        there = np.maximum(1, np.bincount(own, minlength=bags))
        out[:, -4] = np.bincount(own, weights=known | (start != at), minlength=bags) / there
        out[:, -3] = np.bincount(own, weights=known | (start // SPAN != own), minlength=bags) / there
        if n < total:
            seen.add(words)
    out[:, -2] = np.log1p(total) / 10
    out[:, -1] = size / SPAN
    return out


def passages(text: bytes) -> np.ndarray:
    """One row of features for each passage of a whole text."""
    data = np.frombuffer(text, np.uint8)
    seen, n = _Seen(), len(data)
    blocks = range(0, max(1, n), BLOCK)
    return np.concatenate([_describe(data[k : k + BLOCK + 7], min(BLOCK, n - k), n, seen) for k in blocks])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionModel:
    """Encoder, gated attention and score; bags come as one array of passages and the bags' first rows."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        scale = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {
            "encode": scale(FEATURES, ENCODED), "encode0": np.zeros(ENCODED),
            "tanh": scale(ENCODED, GATES), "gate": scale(ENCODED, GATES), "weigh": scale(GATES, 1)[:, 0],
            "score": scale(ENCODED, 1)[:, 0], "score0": np.zeros(1),
        }
        self.mean, self.std, self.shift = np.zeros(FEATURES), np.ones(FEATURES), 0.0

    def forward(self, x: np.ndarray, firsts: np.ndarray) -> dict:
        p = self.p
        x = np.clip((x - self.mean) / self.std, -6, 6)
        bag = np.repeat(np.arange(len(firsts)), np.diff(np.r_[firsts, len(x)]))
        h = np.tanh(x @ p["encode"] + p["encode0"])
        t, s = np.tanh(h @ p["tanh"]), _sigmoid(h @ p["gate"])
        e = (t * s) @ p["weigh"]
        e = np.exp(e - np.maximum.reduceat(e, firsts)[bag])
        a = e / np.add.reduceat(e, firsts)[bag]
        z = np.add.reduceat(a[:, None] * h, firsts)
        return {"x": x, "bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "o": z @ p["score"] + p["score0"][0]}

    def gradients(self, f: dict, firsts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        p, bag, h, t, s, a = self.p, f["bag"], f["h"], f["t"], f["s"], f["a"]
        do = (_sigmoid(f["o"]) - y) * weight / len(y)
        dz = do[:, None] * p["score"]
        da = (h * dz[bag]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, firsts)[bag])
        dg = de[:, None] * p["weigh"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = a[:, None] * dz[bag] + dt @ p["tanh"].T + ds @ p["gate"].T
        dx = dh * (1 - h * h)
        return {
            "encode": f["x"].T @ dx, "encode0": dx.sum(axis=0), "tanh": h.T @ dt, "gate": h.T @ ds,
            "weigh": (t * s).T @ de, "score": f["z"].T @ do, "score0": do.sum(keepdims=True),
        }

    def fit(self, bags: list[np.ndarray], y: np.ndarray, share: float) -> AttentionModel:
        """Adam over mini-batches of bags; ``share``: label 1's share of all labelled documents."""
        every = np.concatenate(bags)
        self.mean, self.std = every.mean(axis=0), every.std(axis=0) + 0.02
        own = y.mean()
        weight = np.where(y == 1, 0.5 / own, 0.5 / (1 - own))
        r = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = r.permutation(len(bags))
            for k in range(0, len(order), BATCH):
                some = order[k : k + BATCH]
                sizes = np.array([len(bags[i]) for i in some])
                firsts = np.cumsum(sizes) - sizes
                f = self.forward(np.concatenate([bags[i] for i in some]), firsts)
                g = self.gradients(f, firsts, y[some], weight[some])
                step += 1
                for name, v in self.p.items():
                    d = g[name] + 1e-4 * v
                    first[name] = 0.9 * first[name] + 0.1 * d
                    second[name] = 0.999 * second[name] + 0.001 * d * d
                    v -= RATE * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
        self.shift = float(np.log(share / (1 - share)))
        return self

    def score(self, x: np.ndarray) -> float:
        return float(_sigmoid(self.forward(x, np.zeros(1, np.int64))["o"][0] + self.shift))

    def attention(self, x: np.ndarray) -> np.ndarray:
        return self.forward(x, np.zeros(1, np.int64))["a"]


class Constant:
    """What is known without labels of both classes: the share of label 1."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray) -> float:
        return self.share

    def attention(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), 1 / len(x))


def training_rows(labels: DataFrame, label: str, fold: Column, per_class: int) -> tuple[list, float]:
    """At most ``per_class`` (doc_id, label) of each class, by hashed id, and the share of label 1 of all."""
    rows = labels.where(~fold & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    rows = rows.select("doc_id", F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    total = sum(counts.values())
    picked = []
    for y in sorted(counts):
        one = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked += [(r["doc_id"], y) for r in one.collect()]
    return picked, counts.get(1, 0) / total if total else 0.5


def fit_quality(docs: DataFrame, labels: DataFrame, fold: Column, per_class: int = TRAIN_DOCS):
    """The model, learned from the labelled documents that ``fold`` doesn't hold out."""
    picked, share = training_rows(labels, "quality", fold, per_class)
    if len({y for _, y in picked}) < 2:
        return Constant(share)
    spark = docs.sparkSession
    small_batches(spark)
    kind = labels.schema["doc_id"].dataType.simpleString()
    chosen = spark.createDataFrame(picked, f"__id {kind}, __y int")  # at most 2 * per_class rows
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    rows = rows.select("doc_id", "__y", F.col("text").cast("binary").alias("text"))

    def run(batches):
        for b in slices(batches):
            x = [passages(t or b"").astype(np.float32).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.binary())], names=["doc_id", "y", "x"])

    got = rows.mapInArrow(run, f"doc_id {kind}, y int, x binary").toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    y = np.array(got.column("y").to_pylist(), float)
    if len(set(y)) < 2:
        return Constant(share)
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in got.column("x").to_pylist()]
    return AttentionModel().fit(bags, y, share)


def score_quality(docs: DataFrame, model, columns: list) -> DataFrame:
    """``columns`` of every row of ``docs`` with score, predicted (1 from THRESHOLD on) and top_passage (the most attended)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = held.value

        def work(text):
            x = passages(text)
            score = own.score(x)
            return score, int(score >= THRESHOLD), int(np.argmax(own.attention(x)))

        return work

    return map_texts(docs, make, "score double, predicted int, top_passage int", columns, binary=True)


def fold_of(modulus: int = 4, held: int = 2) -> Column:
    return learn_fold("doc_id", modulus, held)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_quality(docs, labels, fold_of())
    return score_quality(docs, model, ["doc_id", fold_of().alias("held_out")])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects; each row travels once, its text with it."""
    held = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, fold_of()))
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        own = held.value
        for piece in slices(batches):
            texts = [t.encode() if isinstance(t, str) else t or b"" for t in piece.column(at).to_pylist()]
            yield piece.filter(pa.array([own.score(passages(t)) >= THRESHOLD for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
