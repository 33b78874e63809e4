"""Benchmark decontamination over a distributed positional inverted index.

1. Index.  Every task cuts its documents into segments (about SEGMENT_WORDS
   words, whole documents), gives each word a slot, and stores the postings of
   the segment: term -> slots, one row each, with one more row for the
   documents' places.  Terms that no benchmark item holds can't match and are not
   stored; a bitmap of fixed size (BITMAP_BITS) tells them apart, so what is
   broadcast does not grow with the benchmark.  Terms are 64-bit hashes.
2. Match.  The benchmark's windows go, in parts of PART_WORDS words and blocks
   of about BLOCK_WORDS words (parts are dealt by hash), against every segment.  A window starts from the postings of
   its rarest term in the segment; the lists of its other terms, from rarer to more
   frequent, are shifted by their offsets and intersected with it.  What is left
   are exact phrases.  For proximity, items are probed every NEAR_WORDS words: of the
   PROBE_TERMS rarest terms of that stretch (by their postings in the whole index, of
   those that have any) all but one must lie within NEAR_WORDS words of the first of
   them, so each item matches its own text and a copy with a word changed.  A stretch
   of fewer than PROBE_TERMS distinct terms may lack one of three, and none of one or two.
3. The hits of all blocks are united for each document.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters.  A
window has 13 words; an item of fewer words is one window.

Results: null and empty texts have no words and no hits; rows that share a doc_id
are judged each by itself; items of equal text all count; an empty benchmark
hits nothing and an empty table of documents gives an empty result; very long texts are split into segments that
overlap, none is cut short; extra columns of any name are not read, and stay in rows that are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quarry.llm.common import byte_chunks, kept_table, slices, small_batches, temporary_tables

WINDOW = 13
SEGMENT_WORDS = 2_000_000
BITMAP_BITS = 23
PART_WORDS = 4096
BLOCK_WORDS = 400_000  # windows of a block: 13 numbers of 4 bytes each
NEAR_WORDS = 26
PROBE_TERMS = 4
CANDIDATES = 1_000_000  # phrase candidates that are intersected at a time
CACHED = 300_000

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: A-Z to a-z; digits, letters and bytes of non-ASCII characters stay; the rest become spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256)
)


def term_hash(word: bytes) -> int:
    """Signed 64-bit hash of a word."""
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


class _Terms(dict):
    """word -> its hash if the bitmap has it, else ABSENT; forgets all when it has CACHED words."""

    ABSENT = -(1 << 63)

    def __init__(self, bitmap: np.ndarray | None):
        super().__init__()
        self.bitmap = bitmap

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        h = term_hash(word)
        if h == self.ABSENT:
            h += 1
        if self.bitmap is not None and not self.bitmap[h & ((1 << BITMAP_BITS) - 1)]:
            h = self.ABSENT
        if len(word) < 64:
            self[word] = h
        return h

    def of(self, data: bytes):
        """Arrays of the hashes of the words of a text, piece by piece."""
        for chunk in byte_chunks(data.translate(WORD_BYTES)):
            words = chunk.split()
            yield np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def benchmark_parts(bench: DataFrame) -> DataFrame:
    """(item_id, terms, whole): the items' terms in parts of PART_WORDS that overlap by WINDOW - 1."""
    small_batches(bench.sparkSession)
    kind = bench.schema["item_id"].dataType
    picked = bench.select("item_id", F.col("text").cast("binary").alias("text"))
    out = StructType(
        [StructField("item_id", kind), StructField("terms", ArrayType(LongType())), StructField("part", IntegerType())]
    )

    def run(batches):
        terms = _Terms(None)
        for b in slices(batches):
            rows, ids, n = [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                got = [x for x in terms.of(text or b"")]
                whole = np.concatenate(got) if got else np.empty(0, np.int64)
                for k, at in enumerate(range(0, max(1, len(whole) - WINDOW + 1), PART_WORDS)):
                    if len(whole):
                        ids.append(i)
                        n.append(k)
                        rows.append(whole[at : at + PART_WORDS + WINDOW - 1])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(ids, pa.int64())),
                    pa.array(rows, pa.list_(pa.int64())),
                    pa.array(n, pa.int32()),
                ],
                names=["item_id", "terms", "part"],
            )

    return picked.mapInArrow(run, out)


def term_bitmap(parts: DataFrame) -> np.ndarray:
    """One bit for each value of a term's low BITMAP_BITS bits: at most 2**BITMAP_BITS numbers reach the driver."""
    low = F.col("term").bitwiseAND((1 << BITMAP_BITS) - 1).cast("int").alias("low")
    found = parts.select(F.explode("terms").alias("term")).select(low).distinct().toArrow().column(0).to_numpy()
    bits = np.zeros(1 << BITMAP_BITS, bool)
    bits[found] = True
    return bits


def build_index(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The stored index: (segment, term, slots); where term is null, (segment, doc_ids, slots = first slots, sizes = words)."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType
    packed = spark.sparkContext.broadcast(np.packbits(bitmap).tobytes())
    out = StructType(
        [
            StructField("segment", StringType()),
            StructField("term", LongType()),
            StructField("slots", ArrayType(IntegerType())),
            StructField("doc_ids", ArrayType(kind)),
            StructField("sizes", ArrayType(IntegerType())),
        ]
    )

    def run(batches):
        terms = _Terms(np.unpackbits(np.frombuffer(packed.value, np.uint8)).astype(bool))
        task, number = TaskContext.get().partitionId(), 0
        hashes, slots, firsts, sizes, ids, at = [], [], [], [], [], 0

        def segment():
            h = np.concatenate(hashes) if hashes else np.empty(0, np.int64)
            s = np.concatenate(slots) if slots else np.empty(0, np.int32)
            order = np.argsort(h, kind="stable")
            h, s = h[order], s[order]
            cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
            n = len(cuts)
            places = pa.ListArray.from_arrays(
                np.r_[cuts, len(s), len(s) + len(firsts)].astype(np.int32), np.r_[s, np.array(firsts, np.int32)]
            )
            own = np.zeros(n + 2, np.int32)
            own[-1] = len(ids)
            last = pa.array([True] * n + [False])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{number}"] * (n + 1), pa.string()),
                    pa.array(np.r_[h[cuts], 0], mask=np.r_[np.zeros(n, bool), True]),
                    places,
                    pa.ListArray.from_arrays(pa.array(own), pa.concat_arrays(ids_of), mask=last),
                    pa.ListArray.from_arrays(pa.array(own), pa.array(sizes, pa.int32()), mask=last),
                ],
                names=["segment", "term", "slots", "doc_ids", "sizes"],
            )

        ids_of: list[pa.Array] = []
        for b in slices(batches, 64):
            for i, text in enumerate(b.column(1).to_pylist()):
                firsts.append(at)
                first = at
                for h in terms.of(text or b""):
                    there = np.flatnonzero(h != terms.ABSENT)
                    hashes.append(h[there])
                    slots.append((there + at).astype(np.int32))
                    at += len(h)
                sizes.append(at - first)
                ids.append(i)
                at += 1  # an empty slot: no phrase goes on into the next document
            ids_of.append(b.column(0))
            if at >= SEGMENT_WORDS:
                yield segment()
                number += 1
                at = 0
                for x in (hashes, slots, firsts, sizes, ids, ids_of):
                    x.clear()
        if ids:
            yield segment()

    text = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return kept_table(text.mapInArrow(run, out), "postings")


def _windows(terms: np.ndarray, part: int) -> np.ndarray:
    """The windows of a part, one a row; -1 places pad the one window of a short item."""
    n = len(terms)
    if n >= WINDOW:
        return np.lib.stride_tricks.sliding_window_view(np.arange(n), WINDOW)
    return np.r_[np.arange(n), np.full(WINDOW - n, -1)][None, :] if part == 0 else np.empty((0, WINDOW), np.int64)


def _probes(terms: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(distinct terms in their order, how many of the rarest must meet) of each stretch of NEAR_WORDS words; the last ends with the part."""
    last = max(0, len(terms) - NEAR_WORDS)
    out = []
    for at in [*range(0, last, NEAR_WORDS), last]:
        stretch = terms[at : at + NEAR_WORDS]
        own = stretch[np.sort(np.unique(stretch, return_index=True)[1])]
        out.append((own, min(len(own), PROBE_TERMS) - (len(own) > 2)))
    return out


class Block:
    """The windows of a block of parts: distinct terms, windows as numbers of terms, their items."""

    def __init__(self, parts: list[tuple[int, np.ndarray, int]]):
        """parts: (number of the item, terms, number of the part)."""
        self.terms = np.unique(np.concatenate([p[1] for p in parts]))
        windows, items, heads = [], [], []
        for item, terms, number in parts:
            own = np.searchsorted(self.terms, terms)
            places = _windows(terms, number)
            windows.append(np.where(places < 0, -1, own[places]))
            items.append(np.full(len(places), item))
            heads += [(item, *probe) for probe in _probes(own)]
        self.windows = np.concatenate(windows).astype(np.int32)
        self.items = np.concatenate(items).astype(np.int32)
        self.heads = heads  # (item, distinct terms, how many must meet) of each stretch; see ``keep_rarest``

    def keep_rarest(self, often: np.ndarray) -> None:
        """Reduce the heads to their PROBE_TERMS rarest terms of those that occur, the earlier of equally rare ones."""
        for k, (item, terms, needed) in enumerate(self.heads):
            there = terms[often[terms] > 0]
            self.heads[k] = item, there[np.argsort(often[there], kind="stable")[:PROBE_TERMS]], needed


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts [2, 0, 1]: rows [0, 0, 2] and numbers [0, 1, 0]."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def phrases(block: Block, place: np.ndarray, cuts: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, first slot) of every exact occurrence.

    ``place``: number in the segment of each of the block's terms, or -1;
    term k of the segment has ``slots[cuts[k]:cuts[k + 1]]``, ascending.
    """
    width = int(slots.max(initial=0)) + 2 * WINDOW
    size = np.diff(cuts)
    keys = np.repeat(np.arange(len(size)), size) * width + slots  # ascending: (term, slot)
    known = np.where(block.windows < 0, -2, place[block.windows])
    alive = np.flatnonzero((known != -1).all(axis=1))
    known = known[alive]
    often = np.where(known < 0, np.iinfo(np.int64).max, size[known])
    order = np.argsort(often, axis=1, kind="stable")  # rarest first, padding last
    count = np.take_along_axis(often, order[:, :1], 1)[:, 0]
    found_w, found_s = [], []
    groups = np.cumsum(count) // CANDIDATES
    for g in np.unique(groups):
        some = np.flatnonzero(groups == g)
        row, k = _expand(count[some])
        row = some[row]
        off = order[row, 0]
        start = slots[cuts[known[row, off]] + k].astype(np.int64) - off
        row, start = row[start >= 0], start[start >= 0]
        for j in range(1, WINDOW):
            off = order[row, j]
            term = known[row, off]
            wanted = term * width + start + off
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            same = (term < 0) | (keys[at] == wanted)
            row, start = row[same], start[same]
        found_w.append(alive[row])
        found_s.append(start)
    return np.concatenate(found_w or [np.empty(0, np.int64)]), np.concatenate(found_s or [np.empty(0, np.int64)])


def near(block: Block, place: np.ndarray, cuts: np.ndarray, slots: np.ndarray, firsts: np.ndarray) -> set[tuple[int, int]]:
    """(document, item) where enough of the rarest terms of a stretch of the item lie within NEAR_WORDS words."""
    out = set()
    for item, terms, needed in block.heads:
        known = place[terms]
        lists = [slots[cuts[k] : cuts[k + 1]].astype(np.int64) for k in known[known >= 0]]
        if not lists or len(lists) < needed:
            continue
        first = np.concatenate(lists)  # of those that meet
        doc = np.searchsorted(firsts, first, "right") - 1
        stop = np.minimum(first + NEAR_WORDS, np.r_[firsts[1:], np.iinfo(np.int64).max][doc] - 1)
        met = np.zeros(len(first), np.int64)
        for own in lists:
            met += np.searchsorted(own, stop, "right") > np.searchsorted(own, first)
        out.update((int(d), item) for d in np.unique(doc[met >= needed]))
    return out


def frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Postings of each of a block's terms in the whole index; at most as many rows reach the driver."""
    wanted = index.sparkSession.createDataFrame(pa.table({"term": pa.array(terms, pa.int64())}))
    counts = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum(F.size("slots")).alias("n"))
    got = counts.join(wanted, "term", "left_semi").toArrow()
    out = np.zeros(len(terms), np.int64)
    out[np.searchsorted(terms, got.column("term").to_numpy())] = got.column("n").to_numpy()
    return out


def match_block(index: DataFrame, block: Block, names: pa.Array, item_type) -> DataFrame:
    """(segment, ordinal, starts, stops, items, near) of the documents with a hit: merged runs of hit words, item ids.

    ``names``: the ids of the block's items by their number in the block.
    """
    held = index.sparkSession.sparkContext.broadcast((block, names))
    out = StructType(
        [StructField("segment", StringType()), StructField("ordinal", IntegerType())]
        + [StructField(c, ArrayType(IntegerType())) for c in ("starts", "stops")]
        + [StructField(c, ArrayType(item_type)) for c in ("items", "near")]
    )

    def run(table: pa.Table) -> pa.Table:
        block, names = held.value
        head = table.filter(pa.compute.is_null(table.column("term")))
        rest = table.filter(pa.compute.is_valid(table.column("term"))).combine_chunks().sort_by("term")
        firsts = np.array(head.column("slots")[0].as_py(), np.int64)
        terms = rest.column("term").to_numpy()
        lists = rest.column("slots").combine_chunks()
        slots = lists.flatten().to_numpy() if len(terms) else np.empty(0, np.int32)
        cuts = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())] if len(terms) else np.zeros(1, np.int64)
        place = np.full(len(block.terms), -1, np.int64)
        if len(terms):
            at = np.minimum(np.searchsorted(terms, block.terms), len(terms) - 1)
            place = np.where(terms[at] == block.terms, at, -1)
        window, start = phrases(block, place, cuts, slots)
        length = (block.windows[window] >= 0).sum(axis=1)
        doc = np.searchsorted(firsts, start, "right") - 1
        runs: dict[int, list[list[int]]] = {}
        for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True):
            runs.setdefault(d, []).append([s - int(firsts[d]), s - int(firsts[d]) + n])
        items: dict[int, set[int]] = {}
        for d, i in zip(doc.tolist(), block.items[window].tolist(), strict=True):
            items.setdefault(d, set()).add(i)
        close: dict[int, set[int]] = {}
        for d, i in near(block, place, cuts, slots, firsts):
            close.setdefault(d, set()).add(i)
        docs = sorted(runs.keys() | close.keys())
        merged = [merge_runs(runs.get(d, [])) for d in docs]
        ints, of_names = pa.list_(pa.int32()), pa.list_(names.type)
        pick = lambda by: pa.array([names.take(pa.array(sorted(by.get(d, ())), pa.int32())).to_pylist() for d in docs], of_names)
        return pa.table(
            {
                "segment": pa.array([head.column("segment")[0].as_py()] * len(docs), pa.string()),
                "ordinal": pa.array(docs, pa.int32()),
                "starts": pa.array([[a for a, _ in m] for m in merged], ints),
                "stops": pa.array([[b for _, b in m] for m in merged], ints),
                "items": pick(items),
                "near": pick(close),
            }
        )

    return index.select("segment", "term", "slots").groupBy("segment").applyInArrow(run, out)


def merge_runs(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def match_documents(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, starts, stops (runs of hit words), items, near (item ids)."""
    spark = docs.sparkSession
    bench = kept_table(benchmark_parts(bench), "benchmark-parts")
    index = build_index(docs, term_bitmap(bench))
    words = bench.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-words // BLOCK_WORDS)
    numbered = bench.withColumn("block", F.pmod(F.xxhash64("item_id", "part"), F.lit(max(1, n_blocks))))
    item_type = bench.schema["item_id"].dataType
    found = None
    for b in range(n_blocks):
        rows = numbered.where(F.col("block") == b).select("item_id", "terms", "part").toArrow()
        if not rows.num_rows:
            continue
        ids = rows.column("item_id").to_pylist()
        numbers = {x: k for k, x in enumerate(dict.fromkeys(ids))}
        parts = [
            (numbers[x], np.array(t.as_py(), np.int64), p)
            for x, t, p in zip(ids, rows.column("terms"), rows.column("part").to_pylist(), strict=True)
        ]
        block = Block(parts)
        block.keep_rarest(frequencies(index, block.terms))
        hits = match_block(index, block, pa.array(list(numbers), rows.schema.field("item_id").type), item_type)
        found = hits if found is None else found.unionByName(hits)
    places = index.where(F.col("term").isNull()).select(
        "segment", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("ordinal", "doc")
    )
    places = places.select("segment", "ordinal", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.sizes").cast("bigint").alias("n_words"))
    if found is None:
        empty = F.array().cast("array<int>")
        none = F.array().cast(ArrayType(item_type))
        return places.select("doc_id", "n_words", empty.alias("starts"), empty.alias("stops"), none.alias("items"), none.alias("near"))
    if n_blocks > 1:
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops")]
        sets = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near")]
        found = found.groupBy("segment", "ordinal").agg(*lists, *sets)
    both = places.join(found, ["segment", "ordinal"], "left")
    filled = [F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("starts", "stops", "items", "near")]
    return both.select("doc_id", "n_words", *filled)


def contamination(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The verdict on each row of ``docs``: hit words, items whose windows occur, and whether 5 % of the words are hit."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    out = StructType(
        [
            StructField("doc_id", kind),
            StructField("n_words", LongType()),
            StructField("n_hit", LongType()),
            StructField("n_items", LongType()),
            StructField("items_sha256", StringType()),
            StructField("n_near", LongType()),
        ]
    )

    def run(batches):
        for b in batches:
            hit, n, digest, close = [], [], [], []
            for row in b.select(["starts", "stops", "items", "near"]).to_pylist():
                hit.append(sum(y - x for x, y in merge_runs([list(r) for r in zip(row["starts"], row["stops"], strict=True)])))
                names = sorted(str(i) for i in set(row["items"]))
                n.append(len(names))
                digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
                close.append(len(set(row["near"]) - set(row["items"])))
            long = pa.int64()
            cols = [pa.array(hit, long), pa.array(n, long), pa.array(digest, pa.string()), pa.array(close, long)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=out.fieldNames())

    with temporary_tables(docs.sparkSession):
        rows = kept_table(match_documents(docs, bench).mapInArrow(run, out), "contamination", for_caller=True)
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated_rows(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, each judged by itself: ids don't matter.

    The verdict depends on the text alone, so a digest of the text finds the rows again.
    """
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    bad = contamination(docs.select(digest.alias("doc_id"), "text"), bench).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("__bad_text")).distinct()
    own = F.unhex(F.sha2(docs["text"].cast("binary"), 256))
    return docs.join(bad, own == bad["__bad_text"], "left_anti")
