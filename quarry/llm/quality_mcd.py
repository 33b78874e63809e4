"""Quality rules: base limits, then robust multivariate outliers by minimum covariance determinant.

Every document that the base limits pass becomes a vector of transformed
statistics (STATISTICS, logs of rates that are shrunk so that short texts don't
stand out by chance).  For each language and source, and for each language, the
centre and covariance are those of the HALF of the vectors whose covariance has
the smallest determinant: from three deterministic starts (the medians with no
correlation, with that of the squashed vectors, and with that of their directions)
concentration steps keep the nearest HALF and estimate anew; the start
with the smallest determinant wins and is reweighted once.  A document goes
if its squared Mahalanobis distance exceeds CUTOFF.

All of it covers all documents.  Vectors are packed into blocks by group, each
step joins a group's parameters to its blocks and sums integers (fixed point), so a
group of any size is spread over its blocks and results do not depend on the order.
The nearest HALF is found from a histogram of the distances.

Results: null and empty texts have no words and fail the base limits.  A group
with fewer than MIN_GROUP vectors is judged by its language, a language with fewer
by the base limits alone (distance null).  Null languages and sources are groups of
their own.  Rows are judged each by itself, also if ids repeat; equal distances
are in or out of the HALF together.  Very long texts count whole; an empty table gives an empty
result; columns other than doc_id, text, lang and source, of any name, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, kept_table, map_texts, small_batches, temporary_tables
from quarry.llm.near_dedup import _HASHES, _odd, mix

STATISTICS = ("word length", "symbol rate", "repeated lines", "repeated words", "capitals", "words")
P = len(STATISTICS)
#: Least standard deviation of each statistic: a group whose vectors all agree on one would reject any other value.
FLOOR = np.array([0.1, 0.35, 0.5, 0.5, 0.35, 0.5])
UNIT = 1000  # fixed point: statistics in thousandths
HALF = 0.75
STEPS = 3
MIN_GROUP = 50
BINS = 64  # of the histogram of distances, for each doubling
WINDOW = 5
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123)) + bytes(range(0xC0, 0x100))


def _chi2(x: float, p: int) -> float:
    """Chi-square distribution for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(p // 2))


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, p) < q else (low, mid)
    return high


CUTOFF = _chi2_quantile(1 - 1e-7, P)
_REWEIGH = 0.975


def _consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal vectors is to be multiplied by."""
    return share / _chi2(_chi2_quantile(share, P), P + 2)


def repeated_words(words: list[bytes]) -> int:
    """Words in WINDOW-word windows that occur twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    h = w[:n] * _odd(0)
    for k in range(1, WINDOW):
        h += w[k : n + k] * _odd(k)
    _, which, count = np.unique(mix(h), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[which] > 1)
    edge = np.zeros(len(words) + 1, np.int32)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def _without(data: bytes, some: bytes) -> int:
    return len(data) - len(data.translate(None, some))


_CONTINUED = bytes(range(0x80, 0xC0))


def statistics(data: bytes) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, vector (fixed point)."""
    words = data.split()
    n_words = len(words)
    word_chars = len(data) - _without(data, _CONTINUED) - _without(data, SPACE)
    symbols = _without(data, b"#*$%&|<>")
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    vector = (
        math.log((word_chars + 250) / (n_words + 50)),
        math.log1p(1000 * symbols / (word_chars + 500)),
        math.log1p(100 * dup / (len(lines) + 20)),
        math.log1p(100 * repeat / (n_words + 50)),
        math.log1p(100 * _without(data, _CAPITALS) / (_without(data, _LETTERS) + 500)),
        math.log1p(n_words),
    )
    return n_words, word_chars, symbols, dup, repeat, [round(UNIT * v) for v in vector]


def _blocks(vectors: DataFrame, rows: int = 100_000) -> DataFrame:
    """(g, x): the vectors (g, x) packed by group, ``x`` int32 rows; made where the rows are."""

    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        n = 0

        def packed():
            xs = [np.concatenate(v).astype(np.int32).tobytes() for v in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(xs, pa.binary())], names=["g", "x"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(0).dictionary_encode()
            which = keys.indices.to_numpy()
            x = b.column(1).flatten().to_numpy().reshape(-1, P)
            order = np.argsort(which, kind="stable")
            cuts = np.searchsorted(which[order], np.arange(len(keys.dictionary) + 1))
            for k, name in enumerate(keys.dictionary.to_pylist()):
                held.setdefault(name, []).append(x[order[cuts[k] : cuts[k + 1]]])
            n += b.num_rows
            if n >= rows:
                yield packed()
                held, n = {}, 0
        if held:
            yield packed()

    return vectors.mapInArrow(run, "g string, x binary")


def _sums(blocks: DataFrame, params: DataFrame, each) -> DataFrame:
    """(g, k, i, v): sums over the blocks of what ``each(x, model)`` gives: [(start k, indices, integers)]."""

    def run(batches):
        for b in batches:
            g, k, i, v = [], [], [], []
            for name, x, model in zip(*[c.to_pylist() for c in b.columns], strict=True):
                vectors = np.frombuffer(x, np.int32).reshape(-1, P)
                for start, index, value in each(vectors, np.array(model)):
                    g += [name] * len(index)
                    k += [start] * len(index)
                    i += index.tolist()
                    v += value.tolist()
            cols = [pa.array(g, pa.string()), pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(v, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["g", "k", "i", "v"])

    joined = blocks.join(params, "g").select("g", "x", "model")
    parts = joined.mapInArrow(run, "g string, k int, i int, v bigint")
    return parts.groupBy("g", "k", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("double").alias("v"))


def _models(sums: DataFrame, params: DataFrame | None, make) -> DataFrame:
    """(g, model): ``make`` turns a group's sums {(k, i): v} and its old model into a new one; written."""
    if params is not None:
        sums = sums.unionByName(params.select("g", F.lit(-1).alias("k"), F.posexplode("model").alias("i", "v")))

    def run(rows: pa.Table) -> pa.Table:
        k, i, v = (rows.column(c).to_numpy() for c in ("k", "i", "v"))
        old = np.zeros((k == -1).sum())
        old[i[k == -1]] = v[k == -1]
        model = make({int(s): (i[k == s], v[k == s]) for s in np.unique(k) if s >= 0}, old)
        out = pa.schema([("g", pa.string()), ("model", pa.list_(pa.float64()))])
        if model is None:
            return out.empty_table()
        return pa.table({"g": [rows.column("g")[0].as_py()], "model": [np.asarray(model, float).tolist()]}, schema=out)

    return kept_table(sums.groupBy("g").applyInArrow(run, "g string, model array<double>"), "mcd")


# A model is a flat array.  First: medians, scales.  Then for each of the starts: centre, covariance, cut, rows.
_LEN = P + P * P + 2
STARTS = 3
_UPPER = np.triu_indices(P)


def _medians(vectors: DataFrame) -> DataFrame:
    """(g, model = medians and scales) of the groups of MIN_GROUP vectors or more, from counts of equal values."""
    counts = vectors.select("g", F.posexplode("x").alias("k", "i")).groupBy("g", "k", "i").agg(F.count(F.lit(1)).cast("double").alias("v"))

    def make(by, _):
        values = []
        for k in range(P):
            at, n = by[k]
            if n.sum() < MIN_GROUP:
                return None
            mid = _weighted_median(at, n)
            values.append((mid, 1.4826 * _weighted_median(np.abs(at - mid), n)))
        mids, mads = np.array(values).T
        return np.r_[mids, np.maximum(mads, FLOOR * UNIT)]

    return _models(counts, None, make)


def _weighted_median(values: np.ndarray, counts: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    total = np.cumsum(counts[order])
    return float(values[order][np.searchsorted(total, total[-1] / 2)])


def _start_sums(x: np.ndarray, model: np.ndarray):
    z = (x - model[:P]) / model[P:]
    length = np.sqrt((z * z).sum(axis=1, keepdims=True))
    for k, y in ((0, np.tanh(z)), (1, z / np.maximum(length, 1e-9))):
        y = np.rint(y * UNIT).astype(np.int64)
        yield k, np.arange(len(_UPPER[0])), (y.T @ y)[_UPPER]
    yield 2, np.zeros(1, int), np.array([len(x)])


def _start_models(by, old):
    scale = old[P:]
    out = []
    for k in range(STARTS):
        r = np.eye(P)
        if k:
            s = np.zeros((P, P))
            at, v = by[k - 1]
            s[_UPPER[0][at], _UPPER[1][at]] = v
            s = s + s.T - np.diag(np.diag(s))
            d = np.sqrt(np.maximum(np.diag(s), 1e-9))
            # a little towards no correlation keeps it invertible
            r = 0.95 * s / d[:, None] / d + 0.05 * np.eye(P)
        out.append(np.r_[old[:P], (r * scale[:, None] * scale).ravel(), 0, by[2][1][0]])
    return np.concatenate(out)


def _distances(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    y = x - start[:P]
    return np.einsum("ij,jk,ik->i", y, np.linalg.inv(start[P : P + P * P].reshape(P, P)), y)


def _bins(d: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(1 + d) * BINS).astype(np.int64)


def _each_start(model: np.ndarray):
    return enumerate(model.reshape(-1, _LEN))


def _histogram(x: np.ndarray, model: np.ndarray):
    for k, start in _each_start(model):
        at, n = np.unique(_bins(_distances(x, start)), return_counts=True)
        yield k, at, n


def _cut_models(by, old):
    out = old.reshape(-1, _LEN).copy()
    for k, start in enumerate(out):
        at, n = by[k]
        order = np.argsort(at)
        total = np.cumsum(n[order])
        start[-2] = at[order][np.searchsorted(total, math.ceil(HALF * total[-1]))]
    return out.ravel()


def _moments(x: np.ndarray, model: np.ndarray):
    for k, start in _each_start(model):
        y = x[_bins(_distances(x, start)) <= start[-2]].astype(np.int64)
        yield k, np.arange(1 + P + len(_UPPER[0])), np.r_[len(y), y.sum(axis=0), (y.T @ y)[_UPPER]]


def _estimate(sums, old: np.ndarray, share: float | None) -> np.ndarray:
    at, v = sums
    v = v[np.argsort(at)]
    n, centre = v[0], v[1 : P + 1] / v[0]
    cov = np.zeros((P, P))
    cov[_UPPER] = v[P + 1 :] / n
    cov = cov + cov.T - np.diag(np.diag(cov)) - np.outer(centre, centre)
    cov = cov * _consistency(n / old[-1] if share is None else share) + np.diag((FLOOR * UNIT) ** 2)
    return np.r_[centre, cov.ravel(), old[-2], old[-1]]


def _step_models(by, old):
    return np.concatenate([_estimate(by[k], start, HALF) for k, start in _each_start(old)])


def _best_model(by, old):
    """The start of the smallest determinant, with the cut of the reweighting."""
    starts = old.reshape(-1, _LEN)
    volumes = [np.linalg.slogdet(s[P : P + P * P].reshape(P, P))[1] for s in starts]
    best = starts[int(np.argmin(np.round(volumes, 9)))].copy()
    best[-2] = _bins(np.array([_chi2_quantile(_REWEIGH, P)]))[0]
    return best


def _final_model(by, old):
    m = _estimate(by[0], old, _REWEIGH)
    inverse = np.linalg.inv(m[P : P + P * P].reshape(P, P))
    return np.r_[m[:P], inverse.ravel()]


def covariance_models(vectors: DataFrame) -> DataFrame:
    """(g, model = centre and inverse covariance) of every group of the vectors (g, x) that is large enough."""
    blocks = kept_table(_blocks(vectors), "mcd-blocks")
    middle = _medians(vectors)
    params = _models(_sums(blocks, middle, _start_sums), middle, _start_models)
    for _ in range(STEPS):
        params = _models(_sums(blocks, params, _histogram), params, _cut_models)
        params = _models(_sums(blocks, params, _moments), params, _step_models)
    params = _models(params.select("g", F.lit(0).alias("k"), F.lit(0).alias("i"), F.lit(0.0).alias("v")), params, _best_model)
    return _models(_sums(blocks, params, _moments), params, _final_model)


def judge(docs: DataFrame) -> DataFrame:
    """The counts of every whole text, base_failed, the squared distance and kept; one row for each row of ``docs``."""
    small_batches(docs.sparkSession)
    schema = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, x array<int>"
    )
    keys = [F.to_json(F.struct("lang", "source")).alias("g"), F.to_json(F.struct("lang")).alias("g_lang")]
    rows = map_texts(docs, lambda: statistics, schema, ["doc_id", *keys], binary=True)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = kept_table(rows.withColumn("base_failed", failed), "statistics")
    good = rows.where("not base_failed")
    with temporary_tables(docs.sparkSession):
        models = covariance_models(good.select(F.explode(F.array("g", "g_lang")).alias("g"), "x"))
        models = kept_table(models, "mcd-models", for_caller=True)
    own = models.select("g", F.col("model").alias("own"))
    wide = models.select(F.col("g").alias("g_lang"), F.col("model").alias("wide"))
    both = rows.join(own, "g", "left").join(wide, "g_lang", "left")
    y = F.transform("x", lambda v, i: v - F.get("model", i))
    squared = F.aggregate(
        F.transform(
            y,
            lambda a, i: a * F.aggregate(F.transform(y, lambda b, j: b * F.get("model", P + P * i + j)), F.lit(0.0), lambda s, v: s + v),
        ),
        F.lit(0.0),
        lambda s, v: s + v,
    )
    judged = both.withColumn("model", F.coalesce("own", "wide")).withColumn(
        "distance", F.when(~F.col("base_failed") & F.col("model").isNotNull(), squared)
    )
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance"
    )
