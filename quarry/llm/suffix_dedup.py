"""Suffix-array dedup: remove repeated byte strings, by external induced sorting of shards.

A byte goes if it is covered by a LENGTH-byte string that also starts in a document
with a smaller doc_id.  Every such string (window) has an anchor, its leftmost
smallest hash of GRAM bytes, so equal windows have equal anchors at equal places, and
all windows of a text fall into runs of one anchor each (about 18 windows).

1. Anchors that occur in one document only can't lead to a match.  Tasks send each
   anchor once for each batch of documents; what returns are the shared anchors
   of each document.
2. Documents with shared anchors are cut into the runs of these; the bytes of a run
   are its class.  Each task sends every class once, as hashes: of its bytes, and of the bytes on both sides of the
   anchor, with its smallest and largest document.
   Anchors whose classes have more than about HOT_BYTES bytes (as one document of
   HOT_SAMPLE tells, which decides about the way alone, not about results) would be
   groups without a bound; their runs are cut into single windows, each of which
   is an anchor and a class of its own (two 64-bit hashes), so no shard holds them.
3. Equal classes give their smallest document.  Classes of an anchor that share a side may share a window:
   their bytes alone are read again from the cut documents (a Bloom filter of fixed size names them), meet by anchor, are concatenated and their suffixes sorted
   (``induced``, queues that carry the common prefixes); a shard of SHARD_BYTES, or one
   anchor's HOT_BYTES, is sorted in memory, and only queues beyond
   ``induced.MEMORY_TUPLES`` go to files.  Suffixes with LENGTH common bytes are one
   window, whose smallest document decides which windows of a class repeat.
4. Runs of a class whose smallest document is smaller go whole; in the smallest document
   itself, the windows found in step 3 go.  The bytes of the windows are united and
   removed, and what is left is hashed.

Results: null and empty texts have no bytes and lose none; rows that share a doc_id do
not lose bytes to each other; rows without a doc_id are never compared; equal texts
keep only the one of the smallest doc_id; very long texts are compared whole; an empty table gives an empty
result; columns other than doc_id and text, of any name, are not read; matches never cross documents.  doc_id must be
an integer (of 64 bits at most).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.collocations import Bloom, bloom
from quarry.llm.common import kept_table, release_shuffles, slices, small_batches, temporary_tables
from quarry.llm.induced import sorted_suffixes

LENGTH = 50
GRAM = 16
SPAN = LENGTH - GRAM + 1  # places of an anchor within a window
BATCH_ANCHORS = 500_000
JOINED_BYTES = 1 << 18  # texts that are hashed together
CUT_BYTES = 1 << 15  # texts that are cut into runs together
BATCH_RUNS = 500_000  # runs that a task puts together before it sends them
SHARD_BYTES = 500_000  # shards are cut between anchors; one anchor's classes stay together
HOT_BYTES = 2_000_000  # bytes of an anchor's classes from which on its windows are dealt one by one
HOT_SAMPLE = 16
HOT_BITS = 23

_U = np.uint64
_SHIFTS = ((13, 7), (17, 32), (5, 16), (3, 8))


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each place (two words of eight)."""
    word = np.ndarray((len(x) - 7,), "<u8", x, 0, (1,)).copy()  # eight bytes from each place on
    n = len(x) - GRAM + 1
    h = word[:n] * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(29)
    h += word[8 : 8 + n]
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(29))


def _sliding(a: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of every ``width`` neighbours, by doubling."""
    out, step = a, 1
    while 2 * step <= width:
        out = least(out[:-step], out[step:])
        step *= 2
    if step < width:
        n = len(a) - width + 1
        out = least(out[:n], out[width - step : width - step + n])
    return out


_ALONE = np.zeros(1, np.int64)


def _anchors(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, least of each window, windows within a text) of joined texts of LENGTH bytes or more each; ties all count.

    The upper halves of the hashes are compared.
    """
    h = _gram_hashes(x)
    upper = (h >> _U(32)).astype(np.uint32)
    around = np.zeros(len(x) - LENGTH + 2 * SPAN - 1, np.uint32)
    least = around[SPAN - 1 : 1 - SPAN]
    least[:] = _sliding(upper, SPAN, np.minimum)
    inner, there = np.ones(len(least), bool), np.ones(len(h), bool)
    inner[(starts[1:, None] - np.arange(1, LENGTH)).ravel()] = False
    there[(starts[1:, None] - np.arange(1, GRAM)).ravel()] = False
    least[~inner] = 0
    places = np.flatnonzero((_sliding(around, SPAN, np.maximum) == upper) & there)
    return places, h[places], least, inner


def anchors(x: np.ndarray, starts: np.ndarray = _ALONE) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of a text of LENGTH bytes or more, or of several that are joined (``starts``)."""
    return _anchors(x, starts)[:2]


def runs(x: np.ndarray, starts: np.ndarray = _ALONE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place of the anchor, first window, last window) of each run of windows with the same leftmost anchor.

    ``x`` may be several joined texts of LENGTH bytes or more each, which begin at ``starts``; windows across two are left out.
    """
    places, hashes, least, inner = _anchors(x, starts)
    upper = (hashes >> _U(32)).astype(np.uint32)
    # windows of one least hash; its places follow each other as the window passes them
    cuts = np.flatnonzero((least[1:] != least[:-1]) | (inner[1:] != inner[:-1]))
    first, last = np.append(0, cuts + 1), np.append(cuts, len(least) - 1)
    some = inner[first]
    first, last = first[some], last[some]
    value = least[first]
    done = []
    own = np.searchsorted(places, first)
    while len(first):
        wrong = np.flatnonzero(upper[own] != value)
        while len(wrong):
            own[wrong] += 1
            wrong = wrong[upper[own[wrong]] != value[wrong]]
        end = np.minimum(last, places[own])
        done.append((hashes[own], places[own], first, end))
        more = np.flatnonzero(end < last)
        first, last, value, own = end[more] + 1, last[more], value[more], own[more] + 1
    if len(done) == 1:
        return done[0]
    cols = [np.concatenate(c) for c in zip(*done, strict=True)]
    order = np.argsort(cols[2], kind="stable")
    return tuple(c[order] for c in cols)


def _together(texts: list[bytes], most: int) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, stop, bytes, where each begins) of neighbours among ``texts``, joined up to about ``most`` bytes."""
    first = 0
    while first < len(texts):
        starts, n, stop = [], 0, first
        while stop < len(texts) and (stop == first or n < most):
            starts.append(n)
            n += len(texts[stop])
            stop += 1
        yield first, stop, b"".join(texts[first:stop]), np.array(starts, np.int64)
        first = stop


def _class_hashes(data: bytes, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run."""
    parts = map(data.__getitem__, map(slice, first.tolist(), (first + size).tolist()))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), _U, len(first))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _dealt(ids: np.ndarray, parts: int) -> np.ndarray:
    """The part of each id: its bits shifted into each other, whatever steps the ids come in; ``_part`` does the same."""
    x = ids.astype(np.int64).view(_U)
    for left, right in _SHIFTS:
        x = x ^ x << _U(left)
        x = x ^ x >> _U(right)
    return (x.view(np.int64) % parts).astype(np.int32)


def _part(column: Column, parts: int) -> Column:
    for left, right in _SHIFTS:
        column = column.bitwiseXOR(F.shiftleft(column, left))
        column = column.bitwiseXOR(F.shiftrightunsigned(column, right))
    return F.pmod(column, F.lit(parts)).cast("int")


def _shared_anchors(docs: DataFrame) -> DataFrame:
    """(part, ids, keys): the anchors (short hashes) of documents that others may have as well, by the documents' parts."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("text"))
    schema = "part int, ids array<bigint>, keys array<int>, buckets array<int>"

    def run(batches):
        hs, ids, n = [], [], 0

        def packed():
            h, d = np.concatenate(hs), np.concatenate(ids)
            order = np.argsort(h)
            sorted_h, sorted_d = h[order], d[order]
            cuts = np.append(0, np.flatnonzero(sorted_h[1:] != sorted_h[:-1]) + 1)
            many = np.minimum.reduceat(sorted_d, cuts) != np.maximum.reduceat(sorted_d, cuts)
            many = np.sort(order[np.repeat(many, np.diff(np.append(cuts, len(h))))])
            bucket = (h % _U(parts)).astype(np.int32)
            key = (h >> _U(32)).astype(np.uint32).view(np.int32)
            # one of each anchor goes to its bucket, by document, which packs well
            out = [(bucket, np.sort(order[cuts]), False), (_dealt(d, parts), many, True)]
            for part, some, known in out:
                if known:  # once for each document
                    by = np.lexsort((h[some], d[some]))
                    some = some[by]
                    some = some[np.append(True, (h[some][1:] != h[some][:-1]) | (d[some][1:] != d[some][:-1]))[: len(some)]]
                some = some[np.argsort(part[some].astype(np.min_scalar_type(parts)), kind="stable")]
                cuts = np.flatnonzero(np.r_[True, np.diff(part[some]) != 0]) if len(some) else np.empty(0, np.int64)
                ends = np.r_[cuts, len(some)].astype(np.int32)
                none = np.zeros(len(cuts) + 1, np.int32)
                numbers = part[some[cuts]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers + parts if known else numbers, pa.int32()),
                        pa.ListArray.from_arrays(ends, d[some]),
                        pa.ListArray.from_arrays(ends, key[some]),
                        pa.ListArray.from_arrays(ends, bucket[some]) if known else pa.ListArray.from_arrays(none, np.empty(0, np.int32)),
                    ],
                    names=["part", "ids", "keys", "buckets"],
                )

        for b in slices(batches):
            b = b.filter(pc.greater_equal(pc.binary_length(b.column(1)), LENGTH))
            i = b.column(0).to_numpy()
            for first, stop, text, starts in _together(b.column(1).to_pylist(), CUT_BYTES):
                places, h = anchors(np.frombuffer(text, np.uint8), starts)
                hs.append(h)
                ids.append(i[first:stop][np.searchsorted(starts, places, "right") - 1])
                n += len(h)
            if n >= BATCH_ANCHORS:
                yield from packed()
                hs, ids, n = [], [], 0
        if n:
            yield from packed()

    def meet(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        d, key = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("ids", "keys"))
        if part >= parts:  # shared within a batch: known already
            bucket = pc.list_flatten(rows.column("buckets")).to_numpy().astype(np.int64)
        else:
            order = np.lexsort((d, key))
            d, key = d[order], key[order]
            first = np.r_[True, key[1:] != key[:-1]]
            group = np.cumsum(first) - 1
            last = np.r_[np.flatnonzero(first)[1:] - 1, len(d) - 1]
            some = (d[last] != d[first])[group]
            d, key = d[some], key[some]
            bucket = np.full(len(d), part, np.int64)
        # a few rows, one for each part of the documents
        to = _dealt(d, parts)
        order = np.lexsort((d, to))
        d, to, full = d[order], to[order], (bucket << 32 | key.view(np.uint32).astype(np.int64))[order]
        cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(d) else np.empty(0, np.int64)
        ends = np.r_[cuts, len(d)].astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, c) for c in (d, full)]
        return pa.table({"part": pa.array(to[cuts], pa.int32()), "ids": lists[0], "keys": lists[1]})

    small_batches(spark)
    packed = rows.mapInArrow(run, schema)
    return packed.groupBy("part").applyInArrow(meet, "part int, ids array<bigint>, keys array<bigint>")


def _hot_anchors(docs: DataFrame) -> np.ndarray:
    """One bit for each value of a hot anchor's low HOT_BITS bits; an anchor that shares its bit may be cut as well."""
    picked = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    picked = picked.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(HOT_SAMPLE)) == 0).select("text")

    def run(batches):
        for b in slices(batches, 64):
            cols: list[list[np.ndarray]] = [[], [], []]
            b = b.filter(pc.greater_equal(pc.binary_length(b.column(0)), LENGTH))
            for _, _, text, starts in _together(b.column(0).to_pylist(), CUT_BYTES):
                h, _, first, last = runs(np.frombuffer(text, np.uint8), starts)
                size = last - first + LENGTH
                for c, v in zip(cols, (_signed(h), _signed(_class_hashes(text, first, size)), size), strict=True):
                    c.append(v)
            done = [np.concatenate(c) if c else np.empty(0, np.int64) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in done], names=["anchor", "class", "size"])

    classes = picked.mapInArrow(run, "anchor bigint, class bigint, size bigint").groupBy("anchor", "class").agg(F.max("size").alias("size"))
    hot = classes.groupBy("anchor").agg(F.sum("size").alias("size")).where(F.col("size") >= HOT_BYTES / HOT_SAMPLE)
    low = F.col("anchor").bitwiseAND((1 << HOT_BITS) - 1).cast("int").alias("low")
    bits = np.zeros(1 << HOT_BITS, bool)
    bits[hot.select(low).distinct().toArrow().column(0).to_numpy()] = True  # at most 2**HOT_BITS numbers
    return bits


_CUT = (
    "id bigint, n_bytes bigint, digest string, text binary, "
    "anchor array<bigint>, class array<bigint>, at array<int>, first array<int>, size array<int>"
)


def _cut_documents(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """One row for each document: its digest if it shares no anchor, else its text and the runs of the shared ones; written.

    Windows of hot anchors are runs of their own, with at = -1.
    """
    small_batches(docs.sparkSession)
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(_hot_anchors(docs)).tobytes())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shift = 32 + parts.bit_length()  # the number of a text among some goes above an anchor's bucket and key
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("text"))
    part = F.coalesce(_part(F.col("id"), parts), _part(F.xxhash64("text"), parts)).alias("part")
    # a part's anchors come before its documents
    both = rows.select(part, "doc_id", "id", "text").unionByName(shared, allowMissingColumns=True)
    both = both.repartitionById(parts, "part").sortWithinPartitions("part", F.col("ids").isNull())

    def single(text, first, last):
        """hash, class, at, first window and size of each window of some runs."""
        places = np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
        both = [xxhash.xxh3_128_intdigest(text[a : a + LENGTH]) for a in places.tolist()]
        h, cls = (np.array([x >> k & (1 << 64) - 1 for x in both], _U) for k in (64, 0))
        return h, cls, np.full(len(places), -1), places, np.full(len(places), LENGTH)

    def run(batches):
        hot = np.unpackbits(np.frombuffer(packed.value, np.uint8)).astype(bool)
        now, waiting, known = None, [], []
        for b in slices(batches, 64):
            of, listed = b.column("part").to_numpy(), b.column("ids").is_valid().to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(listed).tolist():
                if of[k] != now:
                    now, waiting, known = of[k], [], []
                waiting.append([b.column(c)[k].values.to_numpy() for c in ("ids", "keys")])
            b = b.filter(pa.array(~listed))
            if not b.num_rows:
                continue
            if waiting and (b.column("part").to_numpy() == now).any():
                known, waiting = [np.concatenate(c) for c in zip(*waiting, strict=True)], []
                order = np.lexsort(known[::-1])
                known = [c[order] for c in known]
            texts = [t or b"" for t in b.column("text").to_pylist()]
            # the shared anchors of the texts; rows that have some are cut
            spans = [(0, 0)] * len(texts)
            if len(known):
                i = b.column("id").fill_null(0).to_numpy()
                own = (b.column("part").to_numpy() == now) & b.column("id").is_valid().to_numpy(zero_copy_only=False)
                ends = [np.searchsorted(known[0], i, side) * own for side in ("left", "right")]
                spans = list(zip(*[c.tolist() for c in ends], strict=True))
            some = [k for k, (a, z) in enumerate(spans) if a < z and len(texts[k]) >= LENGTH]
            counts = np.zeros(len(texts), np.int64)
            cols: list[list[np.ndarray]] = [[] for _ in range(5)]
            for start, stop, text, starts in _together([texts[k] for k in some], CUT_BYTES):
                rows = np.array(some[start:stop])
                keys = [known[1][slice(*spans[k])] for k in rows.tolist()]
                keys = np.concatenate(keys) | np.repeat(np.arange(len(rows)), [len(c) for c in keys]) << shift
                h, place, first, last = runs(np.frombuffer(text, np.uint8), starts)
                of = np.searchsorted(starts, first, "right") - 1
                full = (h % _U(parts)).astype(np.int64) << 32 | (h >> _U(32)).astype(np.int64) | of << shift
                # each text's keys are sorted
                found = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, full), len(keys) - 1)] == full)
                many = hot[(h[found] & _U((1 << HOT_BITS) - 1)).astype(np.int64)]
                cold, warm = found[~many], found[many]
                size = last[cold] - first[cold] + LENGTH
                own = [h[cold], _class_hashes(text, first[cold], size), place[cold] - first[cold], first[cold], size]
                of = of[cold]
                if len(warm):
                    own = [np.concatenate(x) for x in zip(own, single(text, first[warm], last[warm]), strict=True)]
                    of = np.searchsorted(starts, own[3], "right") - 1
                    order = np.argsort(of, kind="stable")
                    own, of = [c[order] for c in own], of[order]
                own[3] = own[3] - starts[of]
                counts[rows] = np.bincount(of, minlength=len(rows))
                for c, v in zip(cols, own, strict=True):
                    c.append(v)
            flat = [np.concatenate(c) if c else np.empty(0, np.int64) for c in cols]
            ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(_signed(c), pa.int64())) for c in flat[:2]]
            lists += [pa.ListArray.from_arrays(ends, pa.array(c.astype(np.int32))) for c in flat[2:]]
            digests = [None if n else hashlib.sha256(t).hexdigest() for n, t in zip(counts.tolist(), texts, strict=True)]
            text = pc.if_else(pa.array(counts > 0), b.column("text"), pa.scalar(None, b.column("text").type))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            names = ["doc_id", "id", "n_bytes", "digest", "text", "anchor", "class", "at", "first", "size"]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("id"), sizes, pa.array(digests, pa.string()), text, *lists], names=names)

    cut = both.mapInArrow(run, f"doc_id {id_type}, {_CUT}")
    return kept_table(cut.withColumn("row", F.monotonically_increasing_id()), "cut-documents")


#: A window has SPAN - 1 = 34 bytes besides its anchor.  With b of them before it, b from each of these to the next,
#: it has at least as many before and behind it as one of SIDES.
_STEPS = (0, 6, 12, 18, 24, 30, SPAN)
SIDES = tuple((a, SPAN - b) for a, b in zip(_STEPS, _STEPS[1:], strict=False))


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse, as many as the longest text so far has bytes."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.empty(0, _U)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 1 << 16)
            self.up, self.down = (self._powers(x, n) for x in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        return self.up, self.down

    @staticmethod
    def _powers(x: int, n: int) -> np.ndarray:
        out = np.full(n, x, _U)
        out[0] = 1
        return np.multiply.accumulate(out)


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _sides(text: bytes, first: np.ndarray, at: np.ndarray, size: np.ndarray, powers: _Powers) -> list[np.ndarray]:
    """For each of SIDES a hash of so many bytes before and behind the anchor of some runs, and of the anchor; 0 where a run has fewer.

    Two hashes of 32 bits make a number.  ``text`` may be several joined: a run's bytes alone tell its hashes.  Classes that share a window share the bytes of one of SIDES.
    """
    up, down = powers.of(len(text))
    sums = np.zeros(len(text) + 1, _U)
    np.cumsum((np.frombuffer(text, np.uint8).astype(_U) + _U(1)) * up[: len(text)], out=sums[1:])
    place = first + at
    out = np.zeros((len(SIDES), len(first)), np.uint32)
    for h, (before, behind) in zip(out, SIDES, strict=True):
        there = np.flatnonzero((at >= before) & (at >= 0) & (at + GRAM + behind <= size))
        start = place[there] - before
        own = (sums[start + before + GRAM + behind] - sums[start]) * down[start]
        h[there] = (own ^ own >> _U(29)) * _U(0xBF58476D1CE4E5B9) >> _U(32) | _U(1)
    return [np.ascontiguousarray(out[k : k + 2].T).view(np.int64)[:, 0] for k in range(0, len(SIDES), 2)]


def _least(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Columns anchor, class, id, most (the largest id) and the sides: one row for each class."""
    anchor, cls, least, most, *sides = cols
    order = np.lexsort((cls, anchor))
    anchor, cls, least, most, *sides = (c[order] for c in (anchor, cls, least, most, *sides))
    cut = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (cls[1:] != cls[:-1])])
    return [anchor[cut], cls[cut], np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut), *(x[cut] for x in sides)]


_SIDE_NAMES = [f"side{k}" for k in range(len(SIDES) // 2)]


def _classes(cut: DataFrame) -> DataFrame:
    """(anchor, class, least, most, side0, ...): every class once for each task, with its smallest and largest document and its sides."""
    names = ["anchor", "class", "least", "most", *_SIDE_NAMES]

    def run(batches):
        held: list[list[np.ndarray]] = []
        n, powers = 0, _Powers()

        def sent(cols):
            for k in range(0, len(cols[0]), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 20_000]) for c in cols], names=names)

        for b in slices(batches, 64):
            counts = pc.list_value_length(b.column("anchor")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(counts)
            anchor, cls, at, first, size = (_flat(b.column(c)) for c in ("anchor", "class", "at", "first", "size"))
            if not len(anchor):
                continue
            i = np.repeat(b.column("id").to_numpy(zero_copy_only=False), counts)
            texts = b.column("text").to_pylist()
            sides, start = [], 0
            while start < len(texts):  # texts together, up to JOINED_BYTES
                offsets = [0]
                while start + len(offsets) - 1 < len(texts) and (len(offsets) == 1 or offsets[-1] < JOINED_BYTES):
                    offsets.append(offsets[-1] + len(texts[start + len(offsets) - 1]))
                stop = start + len(offsets) - 1
                some = slice(ends[start] - counts[start], ends[stop - 1])
                shift = np.repeat(offsets[:-1], counts[start:stop])
                sides.append(_sides(b"".join(texts[start:stop]), first[some] + shift, at[some], size[some], powers))
                start = stop
            held.append([anchor, cls, i, i, *(np.concatenate(x) for x in zip(*sides, strict=True))])
            n += len(anchor)
            if n >= BATCH_RUNS:
                held = [_least([np.concatenate(c) for c in zip(*held, strict=True)])]
                n = 0
                if len(held[0][0]) >= BATCH_RUNS:
                    yield from sent(held[0])
                    held = []
        if held:
            yield from sent(_least([np.concatenate(c) for c in zip(*held, strict=True)]))

    rows = cut.where(F.size("anchor") > 0).select("id", "text", "anchor", "class", "at", "first", "size")
    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _comparable(cols: list[np.ndarray]) -> np.ndarray:
    """Which rows (anchor, sides) share a side with another row of their anchor."""
    anchor, out = cols[0], np.zeros(len(cols[0]), bool)
    # rows come sorted by anchor
    group = np.cumsum(np.append(False, anchor[1:] != anchor[:-1])[: len(anchor)]) << 32
    for side in (half for c in cols[1:] for half in np.ascontiguousarray(c).view(np.uint32).reshape(-1, 2).T):
        some = np.flatnonzero(side)
        both = group[some] | side[some]
        order = np.argsort(both)
        same = both[order][1:] == both[order][:-1]
        out[some[order[1:][same]]] = True
        out[some[order[:-1][same]]] = True
    return out


def _alike(classes: DataFrame) -> DataFrame:
    """(anchor, class, least, many, alike) of the classes of several documents, and of those that may share a window with another."""
    names = ["anchor", "class", "least", "many", "alike"]

    def run(batches):
        held: list[np.ndarray] = []

        def done(cols):
            anchor, cls, least, most, *sides = cols
            alike, many = _comparable([anchor, *sides]), most > least
            some = np.flatnonzero(alike | many)
            for k in range(0, len(some), 20_000):
                at = some[k : k + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in (anchor, cls, least, many, alike)], names=names)

        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if held:
                cols = [np.concatenate(c) for c in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            # rows come sorted by anchor: the last one may go on
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            yield from done([c[:last] for c in cols])
            held = [c[last:] for c in cols]
        if held:
            yield from done(held)

    once = classes.repartition("anchor").groupBy("anchor", "class").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), *[F.max(c).alias(c) for c in _SIDE_NAMES]
    )
    kind = "anchor bigint, class bigint, least bigint, many boolean, alike boolean"
    return once.sortWithinPartitions("anchor").mapInArrow(run, kind)


def _bytes(cut: DataFrame, alike: DataFrame) -> DataFrame:
    """(anchor, class, bytes) of the classes in ``alike``, and of a few others, once for each task."""
    wanted = bloom(alike.select(F.col("class").alias("fp")))
    names = ["anchor", "class", "bytes"]

    def run(batches):
        filled, held, n = Bloom(wanted.value), {}, 0

        def sent():
            cols = list(zip(*[(*k, v) for k, v in held.items()], strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=names)

        for b in slices(batches, 64):
            counts = pc.list_value_length(b.column("anchor")).to_numpy(zero_copy_only=False)
            anchor, cls, at, first, size = (_flat(b.column(c)) for c in ("anchor", "class", "at", "first", "size"))
            row = np.repeat(np.arange(len(counts)), counts)
            some = np.flatnonzero(at >= 0)
            some = some[filled.holds(cls[some].view(_U))]
            texts = b.column("text").to_pylist()
            for r, h, c, a, z in zip(*(x[some].tolist() for x in (row, anchor, cls, first, size)), strict=True):
                if (h, c) not in held:
                    held[h, c] = texts[r][a : a + z]
                    n += z + 300  # what the objects take
            if n >= 40_000_000:
                yield sent()
                held, n = {}, 0
        if held:
            yield sent()

    rows = cut.where(F.size("anchor") > 0).select("text", "anchor", "class", "at", "first", "size")
    return rows.mapInArrow(run, "anchor bigint, class bigint, bytes binary")


def repeated_windows(classes: list[bytes], owner: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(class, start) of the windows that also occur in a class of a smaller owner, sorted; classes by their numbers."""
    sizes = np.array([len(c) for c in classes], np.int64)
    ends = np.cumsum(sizes + 1)  # each class is followed by a separator
    raw = np.frombuffer(b"\0".join(classes) + b"\0", np.uint8).astype(np.uint16) + 2
    raw[ends - 1] = 1
    text = np.r_[raw, np.uint16(0)]
    of = np.repeat(np.arange(len(classes)), sizes + 1)
    left = ends[of] - 1 - np.arange(len(of))  # bytes of the class from each place on
    hits: list[np.ndarray] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def settle(position, group):
        """Windows whose group (same window) has a smaller owner than their own class."""
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        least = np.minimum.reduceat(owner[of[position]], cuts)
        hits.append(position[np.repeat(least, np.diff(np.r_[cuts, len(position)])) < owner[of[position]]])

    def emit(position, common):
        # groups are runs of suffixes with a common prefix of the whole length; the last may go on
        new = np.flatnonzero(common < length)
        if held and len(new):
            own = [held.pop() for _ in range(len(held))][::-1]
            whole = np.concatenate([*[p for p, _ in own], position[: new[0]]])
            keep(whole, np.zeros(len(whole), np.int64))
            position, common = position[new[0] :], common[new[0] :]
        elif held:
            held.append((position, common))
            return
        last = int(np.flatnonzero(common < length)[-1]) if len(position) else 0
        keep(position[:last], np.cumsum(common[:last] < length))
        held.append((position[last:], common[last:]))

    def keep(position, group):
        there = position < len(of)
        there[there] = left[position[there]] >= length
        if there.any():
            settle(position[there], group[there])

    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def gather(position, common):
        """Small blocks go to ``emit`` together."""
        waiting.append((position, common))
        if len(position) >= 1 << 16 or len(waiting) >= 64:
            emit(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
            waiting.clear()

    sorted_suffixes(text, length, gather)
    if waiting:
        emit(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
    if held:
        whole = np.concatenate([p for p, _ in held])
        keep(whole, np.zeros(len(whole), np.int64))
    found = np.sort(np.concatenate(hits)) if hits else np.empty(0, np.int64)
    return of[found], found - (ends - sizes - 1)[of[found]]


def _matched(cut: DataFrame, found: DataFrame) -> DataFrame:
    """(anchor, class, least, starts, stops): the class's smallest document, and the windows that repeat even there.

    ``found`` comes from ``_alike``; the classes that need comparing meet their bytes here, by anchor.
    """
    names = ["anchor", "class", "least", "starts", "stops"]

    def run(batches):
        waiting, n = [], 0

        def flushed():
            anchor, cls, least, many, data = zip(*waiting, strict=True)
            of, windows = repeated_windows(list(data), np.array(least))
            cuts = np.flatnonzero((of[1:] != of[:-1]) | (np.diff(windows) > 1))
            first, last = np.append(0, cuts + 1)[: len(of)], np.append(cuts, len(of) - 1)[: len(of)]
            counts = np.bincount(of[first], minlength=len(waiting))
            some = np.flatnonzero((counts > 0) | np.array(many))
            ends = np.append(0, np.cumsum(counts[some])).astype(np.int32)
            cols = [pa.array(np.array(c, np.int64)[some]) for c in (anchor, cls, least)]
            for c in (windows[first], windows[last] + LENGTH):
                cols.append(pa.ListArray.from_arrays(ends, c.astype(np.int32)))
            return pa.RecordBatch.from_arrays(cols, names=names)

        # a class's own row comes first, then its bytes, as often as tasks sent them
        before = None
        for b in slices(batches, 1 << 20):
            h, c = (x.to_numpy() for x in b.columns[:2])
            own = b.column("bytes").is_null().to_numpy(zero_copy_only=False)
            after = np.append(before is not None and before[:2] == (h[0], c[0]), own[:-1] & (h[1:] == h[:-1]) & (c[1:] == c[:-1]))
            some = np.flatnonzero(after & ~own)
            facts = [b.column(k).fill_null(v).to_numpy(zero_copy_only=False)[some - 1].tolist() for k, v in (("least", 0), ("many", False))]
            if len(some) and some[0] == 0:
                for k, v in zip(facts, before[2:], strict=True):
                    k[0] = v
            taken = [h[some].tolist(), c[some].tolist(), *facts, b.column("bytes").take(pa.array(some)).to_pylist()]
            for row in zip(*taken, strict=True):
                if n >= SHARD_BYTES and row[0] != waiting[-1][0]:
                    yield flushed()
                    waiting, n = [], 0
                waiting.append(row)
                n += len(row[-1]) + 1
            before = (h[-1], c[-1], b.column("least")[-1].as_py(), b.column("many")[-1].as_py()) if own[-1] else None
        if waiting:
            yield flushed()

    alike = found.where("alike")
    rows = alike.select("anchor", "class", "least", "many", F.lit(None).cast("binary").alias("bytes"))
    rows = rows.unionByName(_bytes(cut, alike).select("anchor", "class", F.lit(None).cast("bigint").alias("least"), F.lit(None).cast("boolean").alias("many"), "bytes"))
    rows = rows.repartition("anchor").sortWithinPartitions("anchor", "class", F.col("least").isNull())
    compared = rows.mapInArrow(run, "anchor bigint, class bigint, least bigint, starts array<int>, stops array<int>")
    none = F.array().cast("array<int>")
    return compared.unionByName(found.where("not alike").select("anchor", "class", "least", none.alias("starts"), none.alias("stops")))


def _placed(cut: DataFrame, matched: DataFrame) -> DataFrame:
    """(row, id, anchor, class, first, size) of the runs whose class is in ``matched``, and of a few others."""
    wanted = bloom(matched.select(F.col("class").alias("fp")))
    names = ["row", "id", "anchor", "class", "first", "size"]

    def run(batches):
        filled = Bloom(wanted.value)
        for b in slices(batches, 256):
            counts = pc.list_value_length(b.column("anchor")).to_numpy(zero_copy_only=False)
            anchor, cls, first, size = (_flat(b.column(c)) for c in ("anchor", "class", "first", "size"))
            row, i = (np.repeat(b.column(c).to_numpy(zero_copy_only=False), counts) for c in ("row", "id"))
            some = np.flatnonzero(filled.holds(cls.view(_U)))
            yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (row, i, anchor, cls, first, size)], names=names)

    rows = cut.where(F.size("anchor") > 0).select("row", "id", "anchor", "class", "first", "size")
    return rows.mapInArrow(run, "row bigint, id bigint, anchor bigint, class bigint, first int, size int")


def removed_runs(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, digest or text, and starts and stops of byte runs (not united yet)."""
    cut = _cut_documents(docs, _shared_anchors(docs))
    small_batches(docs.sparkSession)
    release_shuffles(docs.sparkSession, 4)  # the largest shuffles; their query's events may take a few seconds
    with temporary_tables(docs.sparkSession):
        known = kept_table(_alike(_classes(cut)), "alike-classes")
        release_shuffles(docs.sparkSession, 2)
        matched = kept_table(_matched(cut, known), "matched-classes")
        release_shuffles(docs.sparkSession, 2)
        both = _placed(cut, matched).join(matched, ["anchor", "class"]).where("least < id or (least = id and size(starts) > 0)")
        whole = F.col("least") < F.col("id")
        starts = F.when(whole, F.array("first")).otherwise(F.transform("starts", lambda s: s + F.col("first")))
        stops = F.when(whole, F.array(F.col("first") + F.col("size"))).otherwise(F.transform("stops", lambda s: s + F.col("first")))
        found = both.select("row", starts.alias("starts"), stops.alias("stops"))
        found = found.groupBy("row").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops")])
        found = kept_table(found, "found-runs", for_caller=True)
    release_shuffles(docs.sparkSession, 2)
    # collect_list gathers both lists row by row, so they stay in step
    touched = cut.where("text is not null").select("row", "doc_id", "n_bytes", "text").join(found, "row", "left")
    none = F.array().cast("array<int>")
    rest = cut.where("text is null").select("doc_id", "n_bytes", "digest", F.lit(None).cast("binary").alias("text"), none.alias("starts"), none.alias("stops"))
    return touched.select("doc_id", "n_bytes", F.lit(None).cast("string").alias("digest"), "text", "starts", "stops").unionByName(rest)


def united(row: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the maximal runs of each row's union, sorted."""
    a, b = row << 32 | starts, row << 32 | stops
    order = np.argsort(a)
    a, b = a[order], np.maximum.accumulate(b[order])
    cuts = np.flatnonzero(a[1:] > b[:-1])
    a, b = a[np.append(0, cuts + 1)[: len(a)]], b[np.append(cuts, len(b) - 1)[: len(b)]]
    low = (1 << 32) - 1
    return a >> 32, a & low, b & low


def _apply(docs: DataFrame, finish, columns: str) -> DataFrame:
    """doc_id and what ``finish(text or None, digest, n_bytes, runs)`` gives for each row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    extra = to_arrow_schema(_parse_datatype_string(columns))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in slices(batches, 64):
            counts = pc.list_value_length(b.column("starts")).fill_null(0).to_numpy()
            row, a, z = united(np.repeat(np.arange(len(counts)), counts), *(_flat(b.column(c)).astype(np.int64) for c in ("starts", "stops")))
            ends = np.searchsorted(row, np.arange(len(counts) + 1)).tolist()
            gone = list(zip(a.tolist(), z.tolist(), strict=True))
            out = []
            for k, (n, digest, text) in enumerate(zip(*[b.column(c).to_pylist() for c in ("n_bytes", "digest", "text")], strict=True)):
                out.append(finish(text, digest, n, gone[ends[k] : ends[k + 1]]))
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), extra.types, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", *extra.names])

    with temporary_tables(docs.sparkSession):
        rows = removed_runs(docs).select("doc_id", "n_bytes", "digest", "text", "starts", "stops")
        return kept_table(rows.mapInArrow(run, f"doc_id {kind}, {columns}"), "repeats", for_caller=True)


def _left(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in gone:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def repeat_digest(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes, removed runs and the digest of what is left of every whole text."""

    def finish(text, digest, n, gone):
        if text is not None:
            digest = hashlib.sha256(_left(text, gone)).hexdigest()
        return n, sum(b - a for a, b in gone), len(gone), digest

    return _apply(docs, finish, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, removed: array of byte runs (start, stop)) of every whole text."""

    def finish(text, digest, n, gone):
        return ([{"start": a, "stop": b} for a, b in gone],)

    return _apply(docs, finish, "removed array<struct<start:bigint,stop:bigint>>")
