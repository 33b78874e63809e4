"""Near duplicates: fast similarity sketching, banding, exact verification.

1. Sketch.  Every document's distinct word shingles are hashed to 64 bits and
   sketched with COORDINATES coordinates: in round i every shingle is thrown
   into one bin, and a bin keeps the smallest (round, hash) it gets; after
   COORDINATES rounds, round COORDINATES + b throws all shingles into bin b, so
   every coordinate fills, and two or three rounds are enough for most texts.  The
   share of equal coordinates of two sketches is concentrated around their
   similarity.  A coordinate is kept as 16 bits, four of them make a band.
2. Copies.  Documents of equal shingle sets collapse into a class (smallest
   doc_id), so copies never form pairs.
3. Candidates.  Classes that share a band meet.  They join one cluster if their
   sketches agree on AGREE coordinates at least; pairs of similarity 0.8 agree on 102
   on average, with a standard deviation of 4.5, and share one of the 32
   bands but for a chance of 5e-8.  First each member meets the smallest and the
   largest class of its band; only bands of four or more members in different
   clusters then compare all of their members, in blocks, and return one edge
   for each member.
4. Verification.  Each cluster's full shingle sets meet in blocks of BLOCK_DOCS
   documents (every pair of blocks); an inverted index counts the exact
   intersections of all their pairs, and links with 100 * intersection >=
   PERCENT * union are returned as one edge for each document of a linked set.
5. The components of those links are the groups of near duplicates.

No list of pairs is ever made: edges grow with the documents, also in a group
of thousands of near copies.

Results: null and empty texts have no shingles and are linked with nothing;
fewer words than SHINGLE make one shingle; rows that share a doc_id are one
node, linked if any of them is; rows without a doc_id are linked with nothing,
their component is null and they are kept; copies and other ties keep the smallest doc_id; very long texts
count whole; an empty table gives an empty result; extra columns of any name are not read, and stay in rows that are kept.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_chunks, kept_table, map_texts, small_batches, temporary_tables
from quarry.llm.components import components

SHINGLE = 5
PERCENT = 80
COORDINATES = 128
BANDS = COORDINATES // 4
AGREE = 74
BLOCK_DOCS = 512
BLOCK_SHINGLES = 2_000_000
BAND_BLOCK = 1024
CACHED = 300_000

_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_SPACES = bytes(32 if b in b"\t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_ROUND_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=_U) * _ODD[0])


class _Hashes(dict):
    """word -> 64-bit hash; forgets all when it has CACHED words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = h
        return h


_HASHES = _Hashes()


def shingles(text: bytes, size: int) -> np.ndarray:
    """The distinct ``size``-word shingles of a text, as sorted 64-bit hashes."""
    got = []
    for chunk in byte_chunks(text.translate(_SPACES)):
        words = chunk.split(b" ")
        got.append(np.fromiter([_HASHES[w] for w in words if w], _U))
    w = got[0] if len(got) == 1 else np.concatenate(got)
    if not len(w):
        return w
    if len(w) < size:
        return mix(np.array([sum(int(x) * int(c) for x, c in zip(w, _ODD, strict=False)) + len(w) & (1 << 64) - 1], _U))
    n = len(w) - size + 1
    h = w[:n] * _odd(0)
    for k in range(1, size):
        h += w[k : n + k] * _odd(k)
    return np.unique(mix(h))


def _odd(k: int) -> np.uint64:
    return _ODD[k] if k < len(_ODD) else mix(np.array([k], _U))[0] | _U(1)


def sketch(found: np.ndarray) -> np.ndarray:
    """COORDINATES 16-bit coordinates of a non-empty set of 64-bit hashes."""
    n, first = len(found), 0
    out = np.zeros(COORDINATES, np.uint16)
    filled = np.zeros(COORDINATES, bool)
    starts = np.arange(COORDINATES, dtype=_U) << _U(57)
    while first < COORDINATES and not filled.all():
        rounds = min(max(1, 1024 // n), COORDINATES - first)
        h = mix(found[None, :] ^ _ROUND_SEEDS[first : first + rounds, None])
        # sorted by bin (7 bits), round within this pass (8 bits), hash (49 bits)
        key = (h >> _U(57) << _U(57)) | (np.arange(rounds, dtype=_U)[:, None] << _U(49)) | (h & _U((1 << 49) - 1))
        key = np.sort(key, axis=None)
        at = np.searchsorted(key, starts)
        there = at < len(key)
        low = key[np.minimum(at, len(key) - 1)]
        there &= (low >> _U(57)) == np.arange(COORDINATES, dtype=_U)
        new = there & ~filled
        at_round = _U(first) + (low[new] >> _U(49) & _U(0xFF))
        out[new] = (mix((low[new] & _U((1 << 49) - 1)) + at_round * _ODD[1]) & _U(0xFFFF)).astype(np.uint16)
        filled |= new
        first += rounds
    for b in np.flatnonzero(~filled):
        low = mix(found ^ _ROUND_SEEDS[COORDINATES + b]).min(keepdims=True)
        out[b] = (mix(low + _ODD[2]) & _U(0xFFFF))[0]
    return out


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, bands): the size, 128-bit fingerprint and sketch of every whole text's set."""

    def make():
        def work(text):
            found = shingles(text, size)
            if not len(found):
                return 0, None, None, None
            fp = xxhash.xxh3_128_digest(found.tobytes())
            a, b = np.frombuffer(fp, np.int64)
            return len(found), int(a), int(b), sketch(found).view(np.int64)

        return work

    return map_texts(
        docs, make, "n_shingles bigint, fp1 bigint, fp2 bigint, bands array<bigint>", ["doc_id"], binary=True
    )


def _lanes(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, COORDINATES)


def _agreeing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree on AGREE coordinates."""
    small_batches(pairs.sparkSession)
    left = sets.select(F.col("doc_id").alias("a"), F.col("bands").alias("bands_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("bands").alias("bands_b"))

    def run(batches):
        for x in batches:
            if x.num_rows:
                same = (_lanes(x.column("bands_a")) == _lanes(x.column("bands_b"))).sum(axis=1) >= AGREE
                yield x.select(["a", "b"]).filter(pa.array(same))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "bands_a", "bands_b")
    return joined.mapInArrow(run, pairs.select("a", "b").schema)


class Roots:
    """Union-find over 0 .. n-1; the smallest number is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def _in_blocks(rows: DataFrame, blocks) -> DataFrame:
    """``rows`` once for each pair of blocks of their group: columns low, high (the pair) and block (the row's own).

    ``blocks``: the group's number of blocks.  A row of block k meets all
    blocks; a group of one block is there once.
    """
    own = F.pmod(F.xxhash64("doc_id", F.lit(17)), blocks)
    rows = rows.withColumn("block", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    return rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")


def _by_group(rows: DataFrame, key: list[str], link, edge_schema) -> DataFrame:
    """Stream the groups of ``key`` through ``link(list of rows) -> [(a, b)]``; a task holds one group at a time."""
    small_batches(rows.sparkSession)
    n = len(key)

    def run(batches):
        def each():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)

        out: list[tuple] = []
        for _, group in groupby(each(), key=lambda r: r[:n]):
            out += link([r[n:] for r in group])
            if len(out) > 10_000:
                yield _edges(out, edge_schema)
                out = []
        yield _edges(out, edge_schema)

    arranged = rows.repartition(*key).sortWithinPartitions(*key)
    return arranged.mapInArrow(run, edge_schema)


def _edges(rows, edge_schema) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(edge_schema).types
    cols = list(zip(*rows, strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["a", "b"])


def _star(ids: list, roots: Roots) -> list[tuple]:
    return [(x, ids[r]) for k, x in enumerate(ids) if (r := roots.root(k)) != k]


def _link_sketches(rows: list[tuple]) -> list[tuple]:
    """rows: (doc_id, bands), of one band: an edge from each member to the root of those it agrees with."""
    rows.sort(key=lambda r: r[0])
    ids = [r[0] for r in rows]
    lanes = np.array([r[1] for r in rows], np.int64).view(np.uint16)
    roots = Roots(len(ids))
    for k in range(1, len(ids)):
        for other in np.flatnonzero((lanes[:k] == lanes[k]).sum(axis=1) >= AGREE).tolist():
            roots.join(k, other)
    return _star(ids, roots)


def _link_sets(size: int, percent: int):
    """Exact links of the rows (doc_id, text) of a group of blocks, through an inverted index of their shingles."""

    def link(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        rows.sort(key=lambda r: r[0])
        ids = [r[0] for r in rows]
        sets = [shingles(r[1] or b"", size) for r in rows]
        sizes = np.array([len(s) for s in sets])
        doc = np.repeat(np.arange(len(sets)), sizes)
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(token, kind="stable")
        holders = doc[order]  # of token 0, of token 1, ...; ascending
        count = np.bincount(token)
        first = np.cumsum(count) - count
        cuts = np.cumsum(sizes) - sizes
        roots = Roots(len(ids))
        for k in range(1, len(ids)):
            own = token[cuts[k] : cuts[k] + sizes[k]]
            own = own[count[own] > 1]
            both = np.zeros(len(ids), np.int64)
            for some in np.array_split(own, 1 + int(count[own].sum()) // 2_000_000):
                n = count[some]
                at = np.arange(n.sum()) + np.repeat(first[some] - (np.cumsum(n) - n), n)
                both += np.bincount(holders[at], minlength=len(ids))
            both = both[:k]
            for other in np.flatnonzero((both > 0) & (100 * both >= percent * (sizes[:k] + sizes[k] - both))).tolist():
                roots.join(k, other)
        return _star(ids, roots)

    return link


def _clusters(sets: DataFrame) -> DataFrame:
    """(node, component): clusters of classes whose sketches agree, through shared bands."""
    bands = sets.select("doc_id", F.posexplode("bands").alias("band", "value"))
    ends = bands.groupBy("band", "value").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
    met = kept_table(bands.join(ends.where("low < high"), ["band", "value"]), "bands")
    pairs = met.select(F.col("doc_id").alias("b"), F.explode(F.array("low", "high")).alias("a")).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = kept_table(_agreeing(pairs, sets), "agreeing")
    found = kept_table(components(edges), "clusters")
    # bands whose members are not all in one cluster: the pairs that met neither end are still to compare
    named = met.where("n > 3").join(found, F.col("doc_id") == F.col("node"), "left")
    named = named.select("band", "value", "n", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    split = named.groupBy("band", "value").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d")
    rest = named.join(split.select("band", "value"), ["band", "value"], "left_semi").join(sets.select("doc_id", "bands"), "doc_id")
    rest = _in_blocks(rest, F.ceil(F.col("n") / BAND_BLOCK))
    key = ["band", "value", "low", "high"]
    more = _by_group(rest.select(*key, "doc_id", "bands"), key, _link_sketches, edges.schema)
    more = kept_table(more, "agreeing")
    if more.isEmpty():
        return found
    return components(edges.unionByName(more))


def links(docs: DataFrame, sets: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that connect exactly the classes linked by exact similarity; ``sets`` has one row of sketches a class."""
    found = kept_table(_clusters(sets), "clusters")
    weight = found.join(sets.select("doc_id", "n_shingles"), F.col("node") == F.col("doc_id"))
    weight = weight.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("s") / BLOCK_SHINGLES))
    member = found.join(weight.select("component", blocks.alias("blocks")), "component")
    text = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("doc_id is not null")
    rows = member.join(text, F.col("node") == F.col("doc_id"))
    rows = _in_blocks(rows, F.col("blocks"))
    key = ["component", "low", "high"]
    kind = docs.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).schema
    return _by_group(rows.select(*key, "doc_id", "text"), key, _link_sets(size, percent), kind)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    with temporary_tables(docs.sparkSession):
        every = kept_table(sketches(docs, size), "sketches")
        own = every.where("n_shingles > 0 and doc_id is not null")
        classes = own.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"))
        named = kept_table(own.select("doc_id", "n_shingles", "fp1", "fp2").join(classes, ["fp1", "fp2"]), "classes")
        firsts = classes.select(F.col("rep").alias("doc_id"), "fp1", "fp2")
        sets = kept_table(
            every.join(firsts, ["doc_id", "fp1", "fp2"], "left_semi").dropDuplicates(["doc_id", "fp1", "fp2"]), "sets"
        )
        edges = links(docs.select("doc_id", "text"), sets, size, percent)
        # rows that share a doc_id are one node, so their classes are linked as well
        ends = named.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
        twice = named.join(ends, "doc_id").select(F.col("rep").alias("a"), F.col("low").alias("b"))
        joined = components(edges.unionByName(twice))
        found = named.join(joined, F.col("rep") == F.col("node"), "left")
        found = found.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
        alone = every.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        both = found.unionByName(alone)
        out = both.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return kept_table(out, "near-duplicates", for_caller=True)


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the one of the smallest doc_id.

    Of rows that share a kept doc_id one stays; rows without a doc_id all stay.
    """
    with temporary_tables(docs.sparkSession):
        kept = near_duplicates(docs.select("doc_id", "text"), size, percent).where("kept and doc_id is not null")
        kept = kept.groupBy(F.col("doc_id").alias("__kept_id")).agg(F.count(F.lit(1)).alias("__rows"))
        kept = kept_table(kept, "kept", for_caller=True)
    one, more = kept.where("__rows = 1"), kept.where("__rows > 1")
    once = docs.join(one, docs["doc_id"] == one["__kept_id"], "left_semi")
    again = docs.join(more, docs["doc_id"] == more["__kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(again).unionByName(docs.where("doc_id is null"))
