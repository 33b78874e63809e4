"""N-gram Jaccard join by grouped prefixes.

1. Order.  One total order of all shingles, rare ones first: by a frequency
   class (twice the logarithm of a counter) and then by hash.  The counters, CELLS of them, count
   the whole table; any order gives right results, a good one keeps common shingles out of the prefixes.
2. Prefixes.  Two sets of similarity PERCENT share a shingle of their first
   n - ceil(PERCENT * n / 100) + 1 shingles in that order.
3. Groups.  Documents of one set are a class; classes of one size and one
   prefix are a group, which stands for them in what follows.
4. Group pairs.  Groups meet in the buckets of their prefix shingles and size bands
   (two bandings, so that neighbouring bands meet in one of them), are
   filtered by their sizes and by the positions of the shingle, then expanded to their members, which
   a signature of SLOTS counts filters by a lower bound of the sets' difference (it tells strangers apart up to some
   20,000 shingles; larger sets go to verification).
5. Verification of member pairs on full sets, a set against slices of those paired with it.

Components don't need all pairs.  Each class is first verified against one candidate, the
smallest among the first of its buckets, so a family of thousands of near copies
costs one pair a copy.  Then the buckets that still hold several components compare, in blocks, the
members of different components; those that pass all filters are joined to clusters, one edge a
member, and the full sets of a cluster meet in blocks of documents, which return one edge for each
member of a linked set.  ``jaccard_pairs`` lists and verifies the pairs of every bucket instead.

Results: null and empty texts have no shingles and are linked with nothing;
fewer words than SHINGLE make one shingle; very long texts count whole; repeated rows and copies are one class;
rows that share a doc_id are one node, linked if any of them is; rows without a doc_id are linked with nothing and
their component is null; pairs of exactly PERCENT are links; an empty table gives an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import kept_table, map_texts, release_shuffles, slices, small_batches, temporary_tables
from quarry.llm.components import components
from quarry.llm.near_dedup import BLOCK_DOCS, BLOCK_SHINGLES, Roots, _by_group, _in_blocks, _link_sets, mix, shingles

SHINGLE = 3
PERCENT = 90
CELLS = 1 << 20
#: Cells that travel in one row, and the most that a task counts in one of them (more changes the order, not the result).
REGION = 1 << 14
FULL = (1 << 16) - 1
#: Slots of a signature, and the size of sets whose slots are counted modulo 256 in place of 16.
SLOTS = 256
LARGE = 2048
#: Rows of a bucket that are compared at a time, and partners of a set in one slice.
BUCKET_BLOCK = 1024
SLICE_PAIRS = 256

_U = np.uint64


def frequency_classes(docs: DataFrame, size: int) -> np.ndarray:
    """The class of each of CELLS cells of shingles: twice the logarithm of the shingles counted in it."""
    small_batches(docs.sparkSession)
    shift = _U(64 - CELLS.bit_length() + 1)

    def run(batches):
        count, held, n = np.zeros(CELLS, np.int64), [], 0
        for piece in slices(batches):
            for text in piece.column("text").to_pylist():
                held.append((shingles(text or b"", size) >> shift).astype(np.int64))
                n += len(held[-1])
                if n > 1_000_000:
                    count += np.bincount(np.concatenate(held), minlength=CELLS)
                    held, n = [], 0
        if held:
            count += np.bincount(np.concatenate(held), minlength=CELLS)
        regions = np.minimum(count, FULL).reshape(-1, min(REGION, CELLS))
        rows = []
        for k, cells in enumerate(regions):
            at = np.flatnonzero(cells)
            if len(at):
                rows.append((k, at.astype("<u2").tobytes() + cells[at].astype("<u2").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=names)

    def add_up(batches):
        total = {}
        for piece in slices(batches, 64):
            for region, data in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                at, n = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int64)
                total.setdefault(region, np.zeros(REGION, np.int64))[at] += n
        out = [(k, (1 + np.floor(2 * np.log2(np.maximum(n, 0.5)))).astype(np.uint8).tobytes()) for k, n in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=names)

    names = ["region", "data"]
    texts = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    counted = texts.mapInArrow(run, "region int, data binary").repartition("region")
    got = counted.mapInArrow(add_up, "region int, data binary").toArrow()  # CELLS bytes at most
    out = np.zeros((max(1, CELLS // REGION), REGION), np.uint8)
    for region, data in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        out[region] = np.frombuffer(data, np.uint8)
    return out.reshape(-1)


def signature(found: np.ndarray) -> bytes:
    """How many hashes fall into each of SLOTS slots: modulo 16 (two in a byte) for small sets, modulo 256 for large ones."""
    n = np.bincount((mix(found ^ _U(0x51ED270B)) & _U(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
    if len(found) > LARGE:
        return (n & 255).astype(np.uint8).tobytes()
    n = (n & 15).astype(np.uint8)
    return (n[::2] << 4 | n[1::2]).tobytes()


def opened(signatures: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(counts of each signature as a row, whether they are modulo 256)."""
    large = np.array([len(x) == SLOTS for x in signatures], bool)
    out = np.zeros((len(signatures), SLOTS), np.uint8)
    for k, x in enumerate(signatures):
        bytes_ = np.frombuffer(x, np.uint8)
        if large[k]:
            out[k] = bytes_
        else:
            out[k, ::2], out[k, 1::2] = bytes_ >> 4, bytes_ & 15
    return out, large


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, row, n_shingles, fp1, fp2, pf1, pf2, prefix, signature) of every row; ``row`` numbers them."""
    classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(docs, size))
    shift = _U(64 - CELLS.bit_length() + 1)

    def make():
        ranks = classes.value

        def work(text):
            found = shingles(text, size)
            if not len(found):
                return 0, None, None, None, None, None, None
            order = np.lexsort((found, ranks[(found >> shift).astype(np.int64)]))
            prefix = found[order[: prefix_length(len(found), percent)]]
            a, b = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
            c, d = np.frombuffer(xxhash.xxh3_128_digest(prefix.tobytes()), np.int64)
            return len(found), int(a), int(b), int(c), int(d), prefix.view(np.int64), signature(found)

        return work

    kind = "n_shingles bigint, fp1 bigint, fp2 bigint, pf1 bigint, pf2 bigint, prefix array<bigint>, signature binary"
    columns = ["doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.monotonically_increasing_id().alias("row")]
    return map_texts(docs, make, kind, columns, binary=True)


def _fits(percent: int, n_a: str, n_b: str, pos_a: str, pos_b: str):
    """Sizes and positions of a shared prefix shingle allow the similarity."""
    sizes = F.expr(f"100 * least({n_a}, {n_b}) >= {percent} * greatest({n_a}, {n_b})")
    bound = f"(least({pos_a}, {pos_b}) + least({n_a} - {pos_a}, {n_b} - {pos_b}))"
    return sizes & F.expr(f"{100 + percent} * {bound} >= {percent} * ({n_a} + {n_b})")


def _few_differences(left: np.ndarray, right: np.ndarray, both_large: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Slot counts (rows) differ by no more than sets of that similarity can; ``total``: sizes of both added.

    Counts that differ by d modulo 16 or 256 belong to slots with d, or more, different hashes.
    """
    top = np.where(both_large, 255, 15).astype(np.uint8)[:, None]
    d = left - right & top
    d = np.minimum(d, (0 - d) & top).sum(axis=1, dtype=np.int64)
    return d <= total - 2 * -(-percent * total // (100 + percent))


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose signatures allow the similarity."""
    small_batches(pairs.sparkSession)
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"signature_{x}"))

    def run(batches):
        for x in batches:
            if x.num_rows:
                (left, la), (right, lb) = (opened(x.column(c).to_pylist()) for c in ("signature_a", "signature_b"))
                total = x.column("n_a").to_numpy() + x.column("n_b").to_numpy()
                yield x.select(["a", "b"]).filter(pa.array(_few_differences(left, right, la & lb, total, percent)))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "n_a", "n_b", "signature_a", "signature_b").mapInArrow(run, "a bigint, b bigint")


def _texts(nodes: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, text) of the classes in ``nodes``."""
    named = nodes.join(sets.select("cid", "doc_id", "text_hash"), "cid")
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    return rows.join(named, ["doc_id", "text_hash"]).groupBy("cid").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, shared, united) of the pairs that are similar on their full sets; ``pairs`` are distinct."""
    small_batches(pairs.sparkSession)
    pairs = kept_table(pairs, "pairs")
    texts = kept_table(_texts(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), sets, docs), "texts")
    slots = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SLICE_PAIRS).alias("slots"))
    dealt = pairs.join(slots, "a").select("a", "b", F.pmod(F.xxhash64("b"), "slots").alias("slot"))
    own = dealt.select("a", "slot").distinct().join(texts, F.col("a") == F.col("cid")).selectExpr("a", "slot", "cast(null as bigint) as b", "text")
    others = dealt.join(texts, F.col("b") == F.col("cid")).select("a", "slot", "b", "text")
    arranged = own.unionByName(others).repartition("a", "slot").sortWithinPartitions("a", "slot", F.col("b").asc_nulls_first())

    def run(batches):
        mine = None
        for piece in slices(batches, 32):
            out = []
            for a, b, text in zip(*[piece.column(c).to_pylist() for c in ("a", "b", "text")], strict=True):
                found = shingles(text or b"", size)
                if b is None:
                    mine = found
                    continue
                shared = len(np.intersect1d(mine, found, assume_unique=True))
                united = len(mine) + len(found) - shared
                if 100 * shared >= percent * united:
                    out.append((a, b, shared, united))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "shared", "united"])

    return arranged.mapInArrow(run, "a bigint, b bigint, shared bigint, united bigint")


def _buckets(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(token, side, part, band, gid, n, pos): the groups in the buckets where they meet others, and, as side 2, their own members.

    ``gid`` of side 2 is a member.  ``groups`` (cid, gid, n) are the members of groups of several classes.
    """
    others = groups.where("cid <> gid").select("cid")
    first = sets.join(others, "cid", "left_anti")
    entries = first.select(F.col("cid").alias("gid"), F.col("n_shingles").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    ends = entries.groupBy("token").agg(F.min("gid").alias("low"), F.max("gid").alias("high")).where("low < high").select("token")
    met = entries.join(ends, "token")
    # sizes within the similarity differ by one band at most
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent) * 1.0001)))
    met = met.withColumn("band", band)
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.floor((F.col("band") + k) / 2).alias("part")) for k in (0, 1)])
    met = met.select("token", F.explode(sides).alias("x"), "band", "gid", "n", "pos")
    met = met.select("token", "x.side", "x.part", F.floor(F.col("band") / 2).alias("band"), "gid", "n", "pos")
    inner = groups.selectExpr("gid as token", "2 as side", "0L as part", "0L as band", "cid as gid", "n", "0 as pos")
    return met.unionByName(inner)


def _expanded(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with ``cid`` in place of ``gid``, one for each member of the group."""
    own = groups.select("gid", F.col("cid").alias("member"))
    return rows.join(own, "gid", "left").withColumn("cid", F.coalesce("member", "gid")).drop("gid", "member")


def _first_pairs(buckets: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """One candidate (a, b) for each class that has any: the smallest of the first groups of its buckets that fits."""
    key = ["token", "side", "part"]
    first = F.min(F.struct("gid", "n", "pos")).alias("f")
    heads = buckets.groupBy(*key).agg(first, F.count(F.lit(1)).alias("rows")).where("rows > 1")
    heads = heads.select(*key, F.col("f.gid").alias("b"), F.col("f.n").alias("n_b"), F.col("f.pos").alias("pos_b"))
    pairs = buckets.join(heads, key).where("gid <> b").where(_fits(percent, "n", "n_b", "pos", "pos_b"))
    own = pairs.where("side = 2").select(F.col("gid").alias("a"), "b")
    across = _expanded(pairs.where("side < 2").select("gid", "b").distinct(), groups).select(F.col("cid").alias("a"), "b")
    close = _close(own.unionByName(across).distinct(), sets, percent)
    return close.groupBy("a").agg(F.min("b").alias("b"))


def _compared(buckets: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, apart: DataFrame | None) -> DataFrame:
    """Distinct candidates (a, b), a > b, of all buckets.

    With ``apart`` (cid, component) only members of different components are
    compared, and what comes back are edges that connect those that pass, one for each row of a bucket at most.
    """
    key = ["token", "side", "part"]
    rows = buckets.where("side = 2").withColumnRenamed("gid", "cid")
    rows = rows.unionByName(_expanded(buckets.where("side < 2"), groups))
    if apart is not None:
        rows = rows.join(apart, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    else:
        rows = rows.withColumn("component", F.col("cid"))
    stars = apart is not None
    # side 1 serves pairs of different bands only
    split = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.min("component").alias("c"), F.max("component").alias("d"), F.min("band").alias("e"), F.max("band").alias("f")
    )
    split = split.where("c < d and (side <> 1 or e < f)").select(*key, F.ceil(F.col("rows") / BUCKET_BLOCK).alias("blocks"))
    rows = rows.join(split, key).join(sets.select("cid", "signature"), "cid")
    own = F.pmod(F.xxhash64("cid", F.lit(5)), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    key += ["low", "high"]
    rows = rows.select(*key, "block", "band", "cid", "n", "pos", "component", "signature").repartition(*key).sortWithinPartitions(*key)

    def pairs_of(group, side, low, high):
        block, band, cid, n, pos, component = (np.array(c, np.int64) for c in list(zip(*group, strict=True))[:6])
        counts, large = opened([r[6] for r in group])
        roots = Roots(len(group))
        for k in range(len(group) - 1):
            x = slice(k + 1, None)
            big, small = np.maximum(n[x], n[k]), np.minimum(n[x], n[k])
            bound = np.minimum(pos[x], pos[k]) + np.minimum(n[x] - pos[x], n[k] - pos[k])
            ok = (component[x] != component[k]) & (100 * small >= percent * big) & ((100 + percent) * bound >= percent * (big + small))
            if side == 1:
                ok &= band[x] != band[k]
            if low != high:
                ok &= block[x] != block[k]
            at = np.flatnonzero(ok) + k + 1
            if len(at):
                at = at[_few_differences(counts[at], counts[k], large[at] & large[k], n[at] + n[k], percent)]
                for other in at.tolist():
                    if stars:
                        roots.join(k, other)
                    else:
                        yield max(int(cid[other]), int(cid[k])), min(int(cid[other]), int(cid[k]))
        if stars:
            for k in range(len(group)):
                if (r := roots.root(k)) != k:
                    yield max(int(cid[r]), int(cid[k])), min(int(cid[r]), int(cid[k]))

    def run(batches):
        def each():
            for b in slices(batches, 1000):
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)

        def batch(out):
            cols = list(zip(*out, strict=True)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

        out = set()
        for (_, side, _, low, high), group in groupby(each(), key=lambda r: r[:5]):
            for pair in pairs_of([r[5:] for r in group], side, low, high):
                out.add(pair)
                if len(out) >= 50_000:
                    yield batch(out)
                    out = set()
        yield batch(out)

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _links_apart(edges: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect the linked classes of each cluster that ``edges`` connect; full sets meet in blocks."""
    found = kept_table(components(edges).select(F.col("node").alias("cid"), "component"), "clusters")
    weight = found.join(sets.select("cid", "n_shingles"), "cid").groupBy("component")
    weight = weight.agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("s") / BLOCK_SHINGLES))
    member = found.join(weight.select("component", blocks.alias("blocks")), "component")
    rows = member.join(kept_table(_texts(found.select("cid"), sets, docs), "texts"), "cid").withColumnRenamed("cid", "doc_id")
    rows = _in_blocks(rows, F.col("blocks"))
    key = ["component", "low", "high"]
    kind = edges.select("a", "b").schema
    return _by_group(rows.select(*key, "doc_id", "text"), key, _link_sets(size, percent), kind)


def _prepared(docs: DataFrame, size: int, percent: int):
    """(rows of all documents, classes, sets, groups).

    A class of documents of one set has the number ``cid`` of one of its rows; ``sets`` has a row for each class,
    ``groups`` (cid, gid, n) the classes that share size and prefix with another one.
    """
    small_batches(docs.sparkSession)
    every = kept_table(_sets(docs, size, percent), "sets")
    own = every.where("n_shingles > 0 and doc_id is not null")
    one = F.min(F.struct("doc_id", "row")).alias("one")
    classes = own.groupBy("fp1", "fp2").agg(one).select(F.col("one.row").alias("cid"), F.col("one.doc_id").alias("rep"), "fp1", "fp2")
    classes = kept_table(classes, "classes")
    sets = every.join(classes.select("cid"), F.col("row") == F.col("cid"))
    sets = kept_table(sets.select("cid", "doc_id", "text_hash", "n_shingles", "pf1", "pf2", "prefix", "signature"), "class-sets")
    key = ["n_shingles", "pf1", "pf2"]
    many = sets.groupBy(*key).agg(F.min("cid").alias("gid"), F.max("cid").alias("last")).where("gid < last").drop("last")
    groups = kept_table(sets.select("cid", *key).join(many, key).select("cid", "gid", F.col("n_shingles").alias("n")), "groups")
    return every, classes, sets, groups


def jaccard_pairs(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The whole join: pairs (a, b, shared, united) of similar classes, and the membership (doc_id, cid) of all documents in them."""
    with temporary_tables(docs.sparkSession):
        every, classes, sets, groups = _prepared(docs, size, percent)
        buckets = kept_table(_buckets(sets, groups, percent), "buckets")
        pairs = _close(_compared(buckets, groups, sets, percent, None), sets, percent)
        members = every.join(classes.select("fp1", "fp2", "cid"), ["fp1", "fp2"]).where("doc_id is not null").select("doc_id", "cid")
        pairs = kept_table(_verified(pairs, sets, docs, size, percent), "similar", for_caller=True)
        return pairs, kept_table(members, "members", for_caller=True)


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    with temporary_tables(spark):
        every, classes, sets, groups = _prepared(docs, size, percent)
        release_shuffles(spark)
        buckets = kept_table(_buckets(sets, groups, percent), "buckets")
        release_shuffles(spark)
        first = kept_table(_verified(_first_pairs(buckets, groups, sets, percent), sets, docs, size, percent).select("a", "b"), "first-links")
        release_shuffles(spark)
        found = components(first).select(F.col("node").alias("cid"), "component")
        rest = kept_table(_compared(buckets, groups, sets, percent, kept_table(found, "first-components")), "apart")
        links = kept_table(_links_apart(rest, sets, docs, size, percent), "links")
        release_shuffles(spark)
        # rows that share a doc_id are one node, so their classes are linked as well
        rows = every.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "fp1", "fp2")
        rows = kept_table(rows.join(classes.select("fp1", "fp2", "cid"), ["fp1", "fp2"]).drop("fp1", "fp2"), "rows")
        ends = rows.groupBy("doc_id").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high")
        twice = rows.join(ends, "doc_id").where("cid > low").select(F.col("cid").alias("a"), F.col("low").alias("b")).distinct()
        joined = components(first.unionByName(links).unionByName(twice))
        place = classes.select("cid", "rep").join(joined, F.col("cid") == F.col("node"), "left")
        place = place.select("cid", "rep", F.coalesce("component", "cid").alias("component"))
        least = place.groupBy("component").agg(F.min("rep").alias("component_id"))
        named_by = place.join(least, "component").select("cid", "component_id")
        out = rows.join(named_by, "cid").select("doc_id", "n_shingles", "component_id")
        alone = every.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        return kept_table(out.unionByName(alone), "jaccard", for_caller=True)
