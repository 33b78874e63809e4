"""Phrase collocations by Rabin-Karp fingerprints.

1. Words.  Texts are lower-cased (A-Z), cut into pieces at punctuation and line
   ends and into words; a word becomes two 64-bit hashes.  Prefix polynomials
   Q[i] = sum(w_j * BASE**-j, j < i) modulo 2**64 (numpy cumulative sums) give the
   fingerprint of any n-gram as (Q[i + n] - Q[i]) * BASE**i: one subtraction and one product.
2. Counts.  A first pass counts words and pairs in CELLS saturating counters of one byte,
   which are added up by region; a cell below the threshold holds nothing
   frequent.  A second pass aggregates the words and pairs of the other cells, in blocks of
   BLOCK_GRAMS, by task and then by shuffle, to (lang, n, fingerprint): occurrences, the smallest and the
   largest value of the second fingerprint, and an occurrence pointer (the hash of a text
   that holds it).  Two more passes do the same for phrases of three words whose pairs are all
   frequent, and for longer ones whose parts of three words are, known from Bloom filters.  Both filters reach the tasks as bitmaps of a fixed size at any scale: their
   errors cost rows and never change a result (beyond some 10**10 words most cells fill up, and the second pass shuffles
   what its blocks could not combine, unless CELLS is raised).
3. Text.  Frequent fingerprints alone are materialised: pointers are grouped by
   text, at most one for each n-gram of it, and searched there by rolling
   fingerprints; the second fingerprint is computed anew from the words found.  A fingerprint
   with two different second values, or whose pointer leads to another text,
   is a collision: its phrases are counted again by their words, in a
   further pass over the texts.
4. Scores.  Joins with the counts of both parts, exact decimal arithmetic (corpora
   of up to 10**16 words a language; beyond that an error, never a wrong number).
   A phrase inside a longer one is found from the sub-phrases of each candidate.
   The best of each language come from partial lists by hash of the phrase,
   then from those.

Results: null and empty texts have no words; a null lang is ``und``, together with
rows that say so; rows count each, also repeated ones; very long texts are
cut into blocks of words that overlap by four, short ones of a language are read together; ties of the score go to the
higher count, then to the smaller phrase in UTF-8 byte order; an empty
table has no phrases; columns other than text and lang are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import kept_table, release_shuffles, slices, small_batches, temporary_tables

LONGEST = 5
LEAST = 100
TOP = 2000
#: n-gram occurrences that a task aggregates at a time, and the most fingerprints that it holds meanwhile.
BLOCK_GRAMS = 1_000_000
#: Words of a text that are hashed together.
BLOCK_WORDS = 500_000
FILTER_BITS = 1 << 26
PROBES = 3
#: Cells of the counters for words and pairs, a multiple of REGION.
CELLS = 1 << 26
REGION = 1 << 16
FULL = 255
CACHED = 300_000
#: Bits of the first fingerprint (fewer in tests, to force collisions).
FINGERPRINT_BITS = 64

_U = np.uint64
_BASES = [_U(0x9E3779B97F4A7C13), _U(0xD6E8FEB86659FD93)]
_SPACES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK = b"\n"
_GRAMS = "lang string, n int, fp bigint, count bigint, low bigint, high bigint, text_hash bigint"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i = 0 .. size."""
    inverse = _U(pow(int(base), -1, 1 << 64))
    up, down = (np.full(size + 1, b, _U) for b in (base, inverse))
    up[0] = down[0] = _U(1)
    return np.cumprod(up), np.cumprod(down)


class Words(dict):
    """word -> number, with the hashes of the words by number."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.hashes: list[bytes] = [bytes(16)]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.hashes)
        self.hashes.append(xxhash.xxh3_128_digest(word))
        return n


def split_blocks(text: bytes, most: int):
    """Blocks of at most ``most`` words and breaks of a text; neighbours share LONGEST - 1 of them.

    Yields (first, words, new): the number of the first entry, the entries, and how many of
    them begin n-grams that belong to this block.
    """
    text = text.translate(_SPACES)
    held: list[bytes] = []
    first, start, n = 0, 0, len(text)
    size = 8 * most
    while start < n:
        end = start + size
        if end < n:
            cut = text.find(b" ", end)
            end = n if cut < 0 else cut
        held += [w for w in text[start:end].replace(_BREAK, b" \n ").split(b" ") if w]
        start = end
        while len(held) > most or (start >= n and held):
            last = len(held) <= most
            new = len(held) if last else most - LONGEST + 1
            yield first, held[:most], new
            first, held = first + new, held[new:]


class Bloom:
    """A filter of fixed size over 64-bit fingerprints."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def positions(keys: np.ndarray) -> list[np.ndarray]:
        return [_mix(keys + seed) & _U(FILTER_BITS - 1) for seed in _mix(np.arange(1, PROBES + 1, dtype=_U))]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        got = np.ones(len(keys), bool)
        for p in self.positions(keys):
            got &= (self.words[(p >> _U(6)).astype(np.int64)] >> (p & _U(63)) & _U(1)).astype(bool)
        return got


def bloom(fingerprints: DataFrame):
    """A broadcast Bloom filter of the column ``fp``; FILTER_BITS / 64 rows at most reach the driver."""

    def run(batches):
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(_U)
            p = np.concatenate(Bloom.positions(keys)) if len(keys) else np.zeros(0, _U)
            bit = (_U(1) << (p & _U(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((p >> _U(6)).astype(np.int64)), pa.array(bit)], names=["at", "bits"])

    rows = fingerprints.select("fp").mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    got = rows.toArrow()
    words = np.zeros(FILTER_BITS // 64, _U)
    words[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(_U)
    return fingerprints.sparkSession.sparkContext.broadcast(words)


def _lang_key(lang: str, n: int) -> np.uint64:
    return _U(xxhash.xxh3_64_intdigest(f"{n}:{lang}".encode()))


class Grams:
    """Fingerprints of the n-grams of blocks of words."""

    def __init__(self, bits: int, most: int):
        self.bits = bits
        self.vocabulary = Words()
        self.tables = [_powers(b, most + LONGEST) for b in _BASES]
        self.store = self.hashed = np.zeros((0, 2), _U)

    def block(self, lang: str, words: list[bytes]):
        """Prepare a block; the other methods then serve any length."""
        if len(self.vocabulary) > CACHED:
            self.vocabulary, self.hashed = Words(), self.store[:0]
        self.lang = lang
        self.ids = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
        known = self.vocabulary.hashes
        if len(known) > len(self.hashed):
            if len(known) > len(self.store):
                self.store = np.concatenate([self.store, np.zeros((max(len(known), 50_000), 2), _U)])
            fresh = np.frombuffer(b"".join(known[len(self.hashed) :]), _U).reshape(-1, 2)
            self.store[len(self.hashed) : len(known)] = fresh
            self.hashed = self.store[: len(known)]
        self.sums = [None, None]
        self.breaks = np.concatenate([[0], np.cumsum(self.ids == 0)])

    def _prefix_sums(self, k: int) -> np.ndarray:
        if self.sums[k] is None:
            q = np.zeros(len(self.ids) + 1, _U)
            np.cumsum(self.hashed[self.ids, k] * self.tables[k][1][: len(self.ids)], out=q[1:])
            self.sums[k] = q
        return self.sums[k]

    def within(self, n: int) -> np.ndarray:
        """Starts of the n-grams that no break crosses, as a mask."""
        size = max(0, len(self.ids) - n + 1)
        return self.breaks[n : n + size] == self.breaks[:size]

    def _rolled(self, k: int, n: int, at: np.ndarray) -> np.ndarray:
        q = self._prefix_sums(k)
        return (q[at + n] - q[at]) * self.tables[k][0][at]

    def first(self, n: int, at: np.ndarray) -> np.ndarray:
        """First fingerprints of the n-grams that start at ``at``, keyed by language and n."""
        a = _mix(self._rolled(0, n, at) ^ _lang_key(self.lang, n))
        return a & _U((1 << self.bits) - 1) if self.bits < 64 else a

    def second(self, n: int, at: np.ndarray) -> np.ndarray:
        return self._rolled(1, n, at)


def _rows_of(texts: DataFrame) -> DataFrame:
    return texts.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text")
    )


def _text_hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _each_block(batches, most: int):
    """(lang, text hashes, entries of each, words, new entries) of every block of the texts of Arrow batches.

    Short texts of a language share a block, with a break between them.
    """
    for piece in slices(batches):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist(), strict=True):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            hashes, sizes, held = [], [], []
            for text in texts:
                where = _text_hash(text)
                for first, words, new in split_blocks(text, most):
                    if first or new < len(words) or len(held) + len(words) >= most:
                        yield lang, [where], [len(words)], words, new
                        continue
                    held += words
                    held.append(_BREAK)
                    hashes.append(where)
                    sizes.append(len(words) + 1)
            if held:
                yield lang, hashes, sizes, held, len(held)


def count_cells(texts: DataFrame, least: int):
    """A broadcast bitmap of the cells that hold ``least`` words and pairs or more; CELLS / 8 bytes at the driver."""
    small_batches(texts.sparkSession)
    bits, most, cells = FINGERPRINT_BITS, BLOCK_WORDS, CELLS
    names = ["region", "data"]

    def count(batches):
        g, seen, held, size = Grams(bits, most), np.zeros(cells, np.uint8), [], 0

        def add():
            found = np.sort(np.concatenate(held))
            cut = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
            at = found[cut].astype(np.int64)
            seen[at] = np.minimum(FULL, seen[at] + np.diff(np.r_[cut, len(found)]))

        for lang, _, _, words, new in _each_block(batches, most):
            g.block(lang, words)
            for n in (1, 2):
                held.append((g.first(n, np.flatnonzero(g.within(n)[:new])) & _U(cells - 1)).astype(np.uint32))
                size += len(held[-1])
            if size > 2_000_000:
                add()
                held, size = [], 0
        if size:
            add()
        regions = seen.reshape(-1, REGION)
        for start in range(0, len(regions), 64):
            rows = []
            for k in range(start, min(start + 64, len(regions))):
                at = np.flatnonzero(regions[k])
                if len(at):
                    rows.append((k, at.astype("<u2").tobytes() + regions[k][at].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=names)

    def add_up(batches):
        now, total = None, np.zeros(REGION, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())], names=names)

        for piece in slices(batches, 64):
            for region, data in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                if region != now:
                    if now is not None:
                        yield out()
                    now, total = region, np.zeros(REGION, np.int64)
                n = len(data) // 3
                c = np.frombuffer(data, np.uint8, n, 2 * n).astype(np.int64)
                total[np.frombuffer(data, "<u2", n)] += np.where(c == FULL, max(least, FULL), c)
        if now is not None:
            yield out()

    counted = _rows_of(texts).mapInArrow(count, "region int, data binary")
    got = counted.repartition("region").sortWithinPartitions("region").mapInArrow(add_up, "region int, data binary").toArrow()
    bitmap = np.zeros((cells // REGION, REGION // 8), np.uint8)
    for region, data in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        bitmap[region] = np.frombuffer(data, np.uint8)
    return texts.sparkSession.sparkContext.broadcast(bitmap.reshape(-1))


_COLUMNS = [np.int32, np.int32, _U, np.int64, np.int64, np.int64, np.int64]  # lang, n, fp, count, low, high, text_hash


def _merged(rows: list[tuple]) -> tuple:
    """Columns with one row for each run of equal (fp, n, lang) after sorting by fingerprint; others may repeat."""
    lang, n, fp, count, low, high, text = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.argsort(fp)
    lang, n, fp, count, low, high, text = (c[order] for c in (lang, n, fp, count, low, high, text))
    cut = np.flatnonzero(np.r_[True, (fp[1:] != fp[:-1]) | (n[1:] != n[:-1]) | (lang[1:] != lang[:-1])])
    return lang[cut], n[cut], fp[cut], np.add.reduceat(count, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), text[cut]


def _packed(rows: tuple, langs: list[str], regions: int):
    """(region, langs, data) of sorted columns: a row for each range of fingerprints."""
    region = (rows[2] >> _U(32)) * _U(regions) >> _U(32)
    cut = np.flatnonzero(np.r_[True, region[1:] != region[:-1], True])
    for start in range(0, len(cut) - 1, 64):
        ends = cut[start : start + 65]
        data = [b"".join(c[i:j].tobytes() for c in rows) for i, j in zip(ends, ends[1:])]
        cols = [pa.array(region[ends[:-1]].astype(np.int64)), pa.array([langs] * len(data), pa.list_(pa.string())), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["region", "langs", "data"])


def _unpacked(langs: list[str], data: bytes, codes: dict[str, int]) -> tuple:
    """The columns of a row, languages coded by ``codes`` (which learns new ones)."""
    n, at, out = len(data) // sum(np.dtype(k).itemsize for k in _COLUMNS), 0, []
    for kind in _COLUMNS:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    own = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int32)
    return own[out[0]], *out[1:]


def _exact(rows: tuple) -> tuple:
    """``_merged`` columns with one row for each key, also where equal fingerprints of two keys stood mixed."""
    lang, n, fp = rows[:3]
    order = np.lexsort((lang, n, fp))
    lang, n, fp, count, low, high, text = (c[order] for c in rows)
    cut = np.flatnonzero(np.r_[True, (fp[1:] != fp[:-1]) | (n[1:] != n[:-1]) | (lang[1:] != lang[:-1])])
    reduced = np.add.reduceat(count, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.minimum.reduceat(text, cut)
    return lang[cut], n[cut], fp[cut], *reduced


def count_grams(texts: DataFrame, lengths: list[int], least: int, cells=None, known=None, below: int = 0) -> DataFrame:
    """Frequent n-grams by fingerprint: rows (lang, n, fp, count, low, high, text_hash) with ``least`` occurrences.

    Only n-grams of the ``cells`` are counted, or only those whose ``below``-grams are ``known``.
    With ``cells`` a row of n = 0 counts the words of each language.  Tasks
    send their counts as columns, a row for each range of fingerprints, as many ranges as
    the session has shuffle partitions; a range is added up by itself.
    """
    spark = texts.sparkSession
    small_batches(spark)
    bits, most, enough = FINGERPRINT_BITS, BLOCK_WORDS, BLOCK_GRAMS
    regions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [x.split()[0] for x in _GRAMS.split(", ")]

    def count(batches):
        g, langs, totals = Grams(bits, most), {}, {}
        hot = cells.value if cells is not None else None
        filled = Bloom(known.value) if known is not None else None
        held, size = [], 0
        for lang, hashes, sizes, words, new in _each_block(batches, most):
            g.block(lang, words)
            code, where = langs.setdefault(lang, len(langs)), np.repeat(np.array(hashes, np.int64), sizes)
            if hot is not None:
                totals[code] = totals.get(code, 0) + int(g.within(1)[:new].sum())
            flags = None
            if filled is not None:
                flags = g.within(below)
                at = np.flatnonzero(flags)
                flags[at] = filled.holds(g.first(below, at))
            for n in lengths:
                mask = g.within(n)[:new]
                if flags is not None:
                    for k in range(n - below + 1):
                        mask = mask & flags[k : k + len(mask)]
                at = np.flatnonzero(mask)
                fp = g.first(n, at)
                if hot is not None:
                    cell = (fp & _U(8 * len(hot) - 1)).astype(np.int64)
                    there = (hot[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
                    at, fp = at[there], fp[there]
                if len(at):
                    second, same = g.second(n, at).view(np.int64), np.ones(len(at), np.int64)
                    held.append((np.full(len(at), code, np.int32), np.full(len(at), n, np.int32), fp, same, second, second, where[at]))
                    size += len(at)
            if size >= enough:
                held, size = [_merged(held)], 0
                if len(held[0][0]) >= enough:
                    yield from _packed(held[0], list(langs), regions)
                    held = []
        for code, n in totals.items():
            held.append(tuple(np.array([x], k) for x, k in zip((code, 0, 0, n, 0, 0, 0), _COLUMNS, strict=True)))
        if held:
            yield from _packed(_merged(held), list(langs), regions)

    def add_up(batches):
        codes: dict[str, int] = {}
        now, held, size = None, [], 0

        def out():
            rows = _exact(_merged(held))
            keep = (rows[3] >= least) | (rows[1] == 0)
            cols = [pa.array((c.view(np.int64) if c.dtype == _U else c)[keep]) for c in rows]
            cols[0] = pa.array(list(codes), pa.string()).take(cols[0])
            return pa.RecordBatch.from_arrays(cols, names=names)

        for piece in slices(batches, 64):
            for region, langs, data in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                if region != now:
                    if held:
                        yield out()
                    now, held, size = region, [], 0
                held.append(_unpacked(langs, data, codes))
                size += len(held[-1][0])
                if size >= enough:
                    held, size = [_merged(held)], 0
        if held:
            yield out()

    parts = _rows_of(texts).mapInArrow(count, "region bigint, langs array<string>, data binary")
    return parts.repartition("region").sortWithinPartitions("region").mapInArrow(add_up, _GRAMS)


def _materialised(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, n, fp, count, phrase): the words at the pointer, null if they are not those of the fingerprints."""
    small_batches(texts.sparkSession)
    bits, most = FINGERPRINT_BITS, BLOCK_WORDS
    small = F.struct("n", "fp", "low", "lang", "count")
    # at most one pointer for each n-gram of a text
    pointers = frequent.groupBy(F.col("text_hash").alias("fp")).agg(F.collect_list(small).alias("all"))
    pointers = kept_table(pointers, "pointers")
    wanted = bloom(pointers)

    def hashed(batches):
        filled = Bloom(wanted.value)
        for piece in slices(batches):
            texts = [t or b"" for t in piece.column("text").to_pylist()]
            h = np.array([_text_hash(t) for t in texts], np.int64)
            keep = np.flatnonzero(filled.holds(h.view(_U)))
            if len(keep):
                yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array([texts[k] for k in keep], pa.binary())], names=["fp", "text"])

    def search(g, rows, words, new, found):
        """Fill ``found`` with the phrases of ``rows`` that begin in this block."""
        now = None
        for lang, n in sorted({(r["lang"], r["n"]) for r in rows}):
            if lang != now:
                g.block(now := lang, words)
            at = np.flatnonzero(g.within(n)[:new])
            fp = g.first(n, at).view(np.int64)
            order = np.argsort(fp, kind="stable")
            for k, r in enumerate(rows):
                if (r["lang"], r["n"]) == (lang, n) and found[k] is None:
                    i = np.searchsorted(fp, r["fp"], sorter=order)
                    if i < len(fp) and fp[order[i]] == r["fp"]:
                        start = int(at[order[i]])
                        if int(g.second(n, np.array([start])).view(np.int64)[0]) == r["low"]:
                            found[k] = b" ".join(words[start : start + n])

    def found(batches):
        g = Grams(bits, most)
        for piece in slices(batches, 16):
            out = []
            for text, rows in zip(piece.column("text").to_pylist(), piece.column("all").to_pylist(), strict=True):
                phrases = [None] * len(rows)
                for _, words, new in split_blocks(text or b"", most):
                    search(g, rows, words, new, phrases)
                out += [(r["lang"], r["n"], r["fp"], r["count"], p) for r, p in zip(rows, phrases, strict=True)]
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["lang", "n", "fp", "count", "phrase"])

    there = _rows_of(texts).mapInArrow(hashed, "fp bigint, text binary").groupBy("fp").agg(F.first("text").alias("text"))
    both = pointers.join(there, "fp", "left").select("text", "all")
    out = both.mapInArrow(found, "lang string, n int, fp bigint, count bigint, phrase binary")
    return out.withColumn("phrase", F.col("phrase").cast("string"))


def _recounted(texts: DataFrame, collided: DataFrame, least: int) -> DataFrame:
    """(lang, n, phrase, count) of the frequent phrases of collided fingerprints, counted by their words."""
    small_batches(texts.sparkSession)
    bits, most = FINGERPRINT_BITS, BLOCK_WORDS
    wanted = bloom(collided)
    names = ["lang", "n", "fp", "phrase", "count"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches):
        g, filled, got = Grams(bits, most), Bloom(wanted.value), {}

        def out():
            rows = [(*k, c) for k, c in got.items()]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for lang, _, _, words, new in _each_block(batches, most):
            g.block(lang, words)
            for n in range(1, LONGEST + 1):
                at = np.flatnonzero(g.within(n)[:new])
                fp = g.first(n, at)
                there = filled.holds(fp)
                for i, f in zip(at[there].tolist(), fp[there].view(np.int64).tolist(), strict=True):
                    key = (lang, n, f, b" ".join(words[i : i + n]))
                    got[key] = got.get(key, 0) + 1
            if len(got) > 100_000:
                yield out()
                got.clear()
        yield out()

    rows = _rows_of(texts).mapInArrow(run, "lang string, n int, fp bigint, phrase binary, count bigint")
    rows = rows.join(collided.select("lang", "n", "fp").distinct(), ["lang", "n", "fp"], "left_semi")
    rows = rows.withColumn("phrase", F.col("phrase").cast("string"))
    return rows.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("count")).where(F.col("count") >= least)


def frequent_phrases(texts: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, n, phrase, count) of all phrases of 1 to LONGEST words with ``least`` occurrences, (lang, words) totals)."""
    spark = texts.sparkSession
    cells = count_cells(texts, least)
    short = kept_table(count_grams(texts, [1, 2], least, cells=cells), "pairs")
    totals = short.where("n = 0").select("lang", F.col("count").alias("words"))
    cells.unpersist()
    release_shuffles(spark)
    often = short.where("n > 0")
    for lengths in ([3], list(range(4, LONGEST + 1))):
        below = lengths[0] - 1
        known = bloom(often.where(F.col("n") == below))
        longer = count_grams(texts, lengths, least, known=known, below=below)
        often = often.unionByName(kept_table(longer, "phrases"))
        known.unpersist()
        release_shuffles(spark)
    found = kept_table(_materialised(texts, often.where("low = high")), "materialised")
    collided = often.where("low <> high").select("lang", "n", "fp").unionByName(found.where("phrase is null").select("lang", "n", "fp"))
    phrases = found.where("phrase is not null").select("lang", "n", "phrase", "count")
    collided = kept_table(collided, "collided")
    if not collided.isEmpty():
        phrases = phrases.unionByName(kept_table(_recounted(texts, collided, least), "recounted"))
    return phrases, totals


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more, at their lowest-scoring cut."""
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("count").alias("f"))
    words = F.split("phrase", " ", -1)
    cuts = phrases.where("n >= 2").select("lang", "phrase", F.col("count").alias("a"), "n", words.alias("w"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("right", F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ")).drop("w", "n")
    cuts = cuts.join(part.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
    cuts = cuts.join(part.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    cuts = cuts.join(totals.withColumnRenamed("words", "n"), "lang")
    whole = {c: f"cast({c} as decimal(16, 0))" for c in "alrn"}
    cuts = cuts.withColumn("score", F.expr(f"({whole['a']} * {whole['n']} * cast(1000 as decimal(4, 0))) div ({whole['l']} * {whole['r']})"))
    low = F.min(F.struct("score", "k", "l", "r", "n", "a")).alias("x")
    return cuts.groupBy("lang", "phrase").agg(low).select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def _inner(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, most): the count of the most frequent longer phrase that holds the phrase (of two words or more)."""
    longer = phrases.where("n >= 3").select("lang", F.split("phrase", " ", -1).alias("w"), "n", "count")
    longer = longer.withColumn("k", F.explode(F.sequence(F.lit(2), F.col("n") - 1)))
    longer = longer.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1)))
    longer = longer.withColumn("phrase", F.array_join(F.slice("w", F.col("i"), F.col("k")), " "))
    return longer.groupBy("lang", "phrase").agg(F.max("count").alias("most"))


def collocations(texts: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    with temporary_tables(texts.sparkSession):
        phrases, totals = frequent_phrases(texts, least)
        phrases = kept_table(phrases, "frequent")
        scored = _scored(phrases, totals).join(_inner(phrases), ["lang", "phrase"], "left")
        scored = scored.where("most is null or 100 * most < 100 * a").drop("most")
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
        lists = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        scored = scored.withColumn("list", F.pmod(F.xxhash64("phrase"), F.lit(lists)))
        first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "list").orderBy(*order))).where(F.col("rank") <= top)
        best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        out = best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return kept_table(out, "collocations", for_caller=True)
