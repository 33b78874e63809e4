"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

1. Turns.  A turn becomes a 128-bit digest of role and text and its number of
   words; texts travel no further.
2. Prefixes.  A prefix is named by the polynomial sum(t_i * BASE**i) over its
   turns t_1, t_2, ... modulo the prime 2**127 - 1.  Turns are range-partitioned
   by (conversation, turn), each partition sums its own runs, and what earlier
   partitions hold of a run is added from one row for each partition that it
   crosses: a conversation with a third of all turns is spread like any other.
   A prefix shifted by some turns is the sum times a power of BASE, so conversations that
   borrow their first turns from another one (``period``, ``most``) need no second pass.
3. Nodes: one aggregate over the prefixes, pre-aggregated before the shuffle.
   The parent's name is the sum without the last turn.
4. Contraction.  Rounds of joins alternate two steps.  Rake: all leaves leave
   the tree and add their totals to their parents.  Compress: of the nodes with
   a single child, an independent set (those whose hash of the round exceeds
   that of their parent and of their child) leave it; the child moves up to
   the grandparent, which takes over the node's own value.  Chains lose about a third
   of their nodes a round and bushes their leaves, so the rounds grow
   with the logarithm of the tree.  Every join is on unique names on both sides;
   sums for a parent of many children are pre-aggregated.
5. Expansion, in reverse order: a compressed node's total is its own value and
   its child's total, which a later round has found.

Results: a null conv_id is no conversation; a null turn sorts first; null role
or text is empty; turns of one number stand in the order of their digests, equal
rows are turns of their own; an empty table has no nodes, not even a root;
conversations without a turn belong to the root alone; very long texts are
read in place and counted in pieces; other columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, kept_table, release_shuffles, slices, small_batches, temporary_tables

PRIME = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15 % PRIME
ROOT = bytes(16)
#: Bytes of joined ids that one row of a node's id list holds.
LIST_BYTES = 1 << 16
#: Bytes of a text that are looked at in one piece when its words are counted.
PIECE = 1 << 22

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True


def count_words(text: bytes) -> int:
    """Runs of bytes other than ASCII white space."""
    n, before = 0, True
    for start in range(0, len(text), PIECE):
        space = _IS_SPACE[np.frombuffer(text, np.uint8, min(PIECE, len(text) - start), start)]
        n += int((space[:-1] & ~space[1:]).sum()) + int(before and not space[0])
        before = bool(space[-1])
    return n


def _named(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _number(name: bytes | None) -> int:
    return int.from_bytes(name, "big") if name is not None else 0


def _stream(df: DataFrame, work, schema: str) -> DataFrame:
    """``work`` maps an iterator of row tuples to an iterator of tuples; rows pass through one task in their order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    small_batches(df.sparkSession)
    out = _parse_datatype_string(schema)
    names, kinds = out.fieldNames(), to_arrow_schema(out).types

    def run(batches):
        def rows():
            for piece in slices(batches, 1000):
                yield from zip(*[c.to_pylist() for c in piece.columns], strict=True)

        def batch(done):
            cols = zip(*done, strict=True) if done else repeat((), len(names))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        done, held = [], 0
        for row in work(rows()):
            done.append(row)
            held += sum(len(x) for x in row if type(x) is bytes)
            if len(done) >= 2000 or held > 1 << 22:
                yield batch(done)
                done, held = [], 0
        yield batch(done)

    return df.mapInArrow(run, out)


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, row, key, words): ``row`` tells equal turns apart."""

    def work(rows):
        for conv, turn, row, role, text in rows:
            role, text = role or b"", text or b""
            h = hashlib.blake2b(len(role).to_bytes(8, "big"), digest_size=16)
            h.update(role)
            h.update(text)
            yield conv, turn, row, h.digest(), count_words(text)

    own = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.monotonically_increasing_id().alias("row"),
        F.col("role").cast("string").cast("binary").alias("role"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).where("conv_id is not null")
    turn = own.schema["turn"].dataType.simpleString()
    turn = "bigint" if turn == "void" else turn
    return _stream(own, work, f"conv_id bigint, turn {turn}, row bigint, key binary, words bigint")


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _runs(turns: DataFrame) -> DataFrame:
    """(conv_id, pid, idx, acc, prev, words): place and polynomial within the run of a range partition."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")]
    ranged = turns.repartitionByRange(_partitions(turns), *order).sortWithinPartitions(*order)

    def work(rows):
        now, idx, acc, power = None, 0, 0, 1
        for conv, pid, key, words in rows:
            if conv != now:
                now, idx, acc, power = conv, 0, 0, 1
            idx += 1
            power = power * BASE % PRIME
            prev, acc = acc, (acc + (_number(key) % (PRIME - 1) + 1) * power) % PRIME
            yield conv, pid, idx, _named(acc), _named(prev), words

    ranged = ranged.select("conv_id", F.spark_partition_id().alias("pid"), "key", "words")
    return _stream(ranged, work, "conv_id bigint, pid int, idx bigint, acc binary, prev binary, words bigint")


def _carried(ends: DataFrame) -> DataFrame:
    """For each run that goes on from earlier partitions: (c_conv, c_pid, before, sum) of what they hold.

    At most one conversation crosses each border, so this has fewer rows than there are partitions.
    """
    many = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_id")

    def work(rows):
        now, before, total = None, 0, 0
        for conv, pid, n, acc in rows:
            if conv != now:
                now, before, total = conv, 0, 0
            else:
                yield conv, pid, before, _named(total)
            total = (total + _number(acc) * pow(BASE, before, PRIME)) % PRIME
            before += n

    rows = ends.join(many, "conv_id").repartition("conv_id").sortWithinPartitions("conv_id", "pid")
    return _stream(rows.select("conv_id", "pid", "n", "acc"), work, "c_conv bigint, c_pid int, before bigint, sum binary")


def _placed(runs: DataFrame, carried: DataFrame) -> DataFrame:
    """(conv_id, idx, acc, prev, words) over whole conversations."""

    def work(rows):
        for conv, idx, acc, prev, words, before, total in rows:
            if before:
                f, s = pow(BASE, before, PRIME), _number(total)
                acc, prev = (_named((s + _number(x) * f) % PRIME) for x in (acc, prev))
                idx += before
            yield conv, idx, acc, prev, words

    # fewer rows than range partitions
    both = runs.join(F.broadcast(carried), (F.col("conv_id") == F.col("c_conv")) & (F.col("pid") == F.col("c_pid")), "left")
    both = both.select("conv_id", "idx", "acc", "prev", "words", "before", "sum")
    return _stream(both, work, "conv_id bigint, idx bigint, acc binary, prev binary, words bigint")


def _members(conversations: DataFrame, period: int | None, most: int) -> DataFrame:
    """(id, parent, depth, conv_id, words, is_end): a row for each conversation and node that it starts with."""
    runs = kept_table(_runs(kept_table(_turns(conversations), "turns")), "runs")
    ends = runs.groupBy("conv_id", "pid").agg(F.max("idx").alias("n"), F.max_by("acc", "idx").alias("acc"))
    placed = _placed(runs, kept_table(_carried(ends), "carried"))
    own = ends.groupBy("conv_id").agg(F.sum("n").alias("n"))
    if period is None:
        plan = own.selectExpr("conv_id", "n", "0 as h", "null as heads")
    else:
        head = F.sort_array(F.collect_list(F.struct("idx", "acc", "prev", "words")))  # at most ``most`` - 1 rows
        heads = placed.where(F.col("idx") < most).groupBy("conv_id").agg(head.alias("heads"))
        own = kept_table(own.join(heads, "conv_id", "left"), "heads")
        digits = F.col("conv_id").cast("string").cast("binary")
        plan = own.withColumn("h", (F.crc32(digits) % most).cast("int")).withColumnRenamed("heads", "own_heads")
        base = own.select(F.col("conv_id").alias("base"), "heads")  # lent to at most 2 * period - 1 conversations
        plan = plan.join(base, F.col("conv_id") - F.col("conv_id") % period == F.col("base"), "left")
        lent = F.filter("heads", lambda x: x.idx <= F.col("h"))
        plan = plan.withColumn("heads", F.coalesce(lent, F.filter("own_heads", lambda x: F.lit(False))))
        mine = F.filter("own_heads", lambda x: x.idx <= F.col("h"))
        plan = plan.withColumn("mine", F.try_element_at(mine, F.lit(-1)).acc)
        plan = plan.withColumn("lent", F.try_element_at("heads", F.lit(-1)).acc)
        plan = kept_table(plan.select("conv_id", "n", "h", F.size("heads").alias("hb"), "mine", "lent", "heads"), "rebuilt")

    kind = "id binary, parent binary, depth bigint, conv_id bigint, words bigint, is_end boolean"
    if period is None:
        nodes = placed.join(plan.select("conv_id", "n"), "conv_id").selectExpr(
            "acc as id", "prev as parent", "idx as depth", "conv_id", "words", "idx = n as is_end"
        )
        turnless = F.lit(False)
    else:
        powers = {k: pow(BASE, k, PRIME) for k in range(-most, 1)}

        def work(rows):
            for conv, idx, acc, prev, words, n, h, hb, mine, lent in rows:
                f, s = powers[hb - h], _number(lent) - _number(mine) * powers[hb - h]
                name, parent = (_named((s + _number(x) * f) % PRIME) for x in (acc, prev))
                yield name, parent, idx - h + hb, conv, words, idx == n

        rest = placed.join(plan.drop("heads"), "conv_id").where("idx > h")
        rest = rest.select("conv_id", "idx", "acc", "prev", "words", "n", "h", "hb", "mine", "lent")
        head = plan.select("conv_id", "n", "h", "hb", F.explode("heads").alias("x")).selectExpr(
            "x.acc as id", "x.prev as parent", "x.idx as depth", "conv_id", "x.words as words", "x.idx = hb and n <= h as is_end"
        )
        nodes = _stream(rest, work, kind).unionByName(head)
        turnless = (F.col("hb") == 0) & (F.col("n") <= F.col("h"))
    root = plan.select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        "conv_id", F.lit(0).cast("bigint").alias("words"), turnless.alias("is_end"),
    )
    return nodes.unionByName(root)


def _digests(members: DataFrame) -> DataFrame:
    """(e_id, ends_sha256) of the nodes where conversations end.

    Ids are joined into rows of LIST_BYTES by range partitions of (node, id); a
    node's digest then reads its few rows in order, as SHA-256 demands, holding one at a time.
    """

    def joined(rows):
        now, first, got, held = None, None, [], 0
        for name, conv in rows:
            if name != now or held > LIST_BYTES:
                if got:
                    yield now, first, b",".join(got)
                now, first, got, held = name, conv, [], 0
            got.append(b"%d" % conv)
            held += len(got[-1]) + 1
        if got:
            yield now, first, b",".join(got)

    def hashed(rows):
        now, h = None, None
        for name, _, data in rows:
            if name != now:
                if h is not None:
                    yield now, h.hexdigest()
                now, h = name, hashlib.sha256(data)
            else:
                h.update(b",")
                h.update(data)
        if h is not None:
            yield now, h.hexdigest()

    ends = members.where("is_end").select("id", "conv_id")
    ends = ends.repartitionByRange(_partitions(ends), "id", "conv_id").sortWithinPartitions("id", "conv_id")
    lists = _stream(ends, joined, "e_id binary, first bigint, data binary")
    return _stream(lists.repartition("e_id").sortWithinPartitions("e_id", "first"), hashed, "e_id binary, ends_sha256 string")


def _rake_and_compress(tree: DataFrame, turn: int) -> DataFrame:
    """One round.  ``tree``: (id, parent, w, l, kids, only, gone), kids the number of children and only one of them.

    Rows with ``gone`` were compressed by the last round: their child moves to
    their parent, which takes over their value.  Returns the inner nodes that remain.
    """
    gone = tree.where("gone")
    moved = gone.select(F.col("only").alias("m_id"), F.col("parent").alias("m_parent"))
    here = tree.where("not gone").join(moved, F.col("id") == F.col("m_id"), "left")
    here = here.withColumn("parent", F.coalesce("m_parent", "parent")).drop("m_id", "m_parent", "gone")
    given = here.selectExpr("parent", "w", "l", "if(kids = 0, null, id) as child")
    given = given.unionByName(gone.selectExpr("parent", "w", "l", "cast(null as binary) as child")).where("parent is not null")
    up = given.groupBy(F.col("parent").alias("p_id")).agg(
        F.sum(F.expr("if(child is null, w, 0)")).alias("dw"),
        F.sum(F.expr("if(child is null, l, 0)")).alias("dl"),
        F.count("child").alias("kids"),
        F.min("child").alias("only"),
    )
    inner = here.where("kids > 0").drop("kids", "only").join(up, F.col("id") == F.col("p_id"))
    inner = inner.select("id", "parent", (F.col("w") + F.col("dw")).alias("w"), (F.col("l") + F.col("dl")).alias("l"), "kids", "only")
    own, above, below = (F.xxhash64(x, F.lit(turn)) for x in ("id", "parent", "only"))
    free = F.col("parent").isNotNull() & (F.col("kids") == 1) & (own > above) & (own > below)
    return inner.withColumn("gone", free)


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(id, w, l) summed over the subtrees of a forest given as rows (id, parent, w, l); a root's parent is null."""
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("p_id")).agg(F.count(F.lit(1)).alias("kids"), F.min("id").alias("only"))
    start = tree.select("id", "parent", "w", "l").join(kids, F.col("id") == F.col("p_id"), "left").drop("p_id")
    start = start.withColumn("kids", F.coalesce("kids", F.lit(0))).withColumn("gone", F.lit(False))
    rounds = [kept_table(start, "tree")]
    counts = []
    while True:
        now = rounds[-1].agg(F.count_if(F.col("gone")).alias("gone"), F.count_if(~F.col("gone") & (F.col("kids") > 0)).alias("inner")).first()
        counts.append(now.gone)
        if not now.inner:
            break
        rounds.append(kept_table(_rake_and_compress(rounds[-1], len(rounds)), "tree"))
        release_shuffles(tree.sparkSession)
    known = None
    for at, gone in zip(reversed(rounds), reversed(counts), strict=True):
        raked = at.where("not gone and kids = 0").select("id", "w", "l")
        known = raked if known is None else known.unionByName(raked)
        if gone:
            below = known.select(F.col("id").alias("only"), F.col("w").alias("bw"), F.col("l").alias("bl"))
            found = at.where("gone").select("id", "w", "l", "only").join(below, "only")
            found = found.select("id", (F.col("w") + F.col("bw")).alias("w"), (F.col("l") + F.col("bl")).alias("l"))
            known = known.unionByName(kept_table(found, "expanded"))
    return known


def conversation_trie(conversations: DataFrame, period: int | None = None, most: int = 4) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    With ``period`` conversations are rebuilt first: conversation c starts with
    the first h = crc32(c) % most turns of conversation c - c % period and goes on
    with its own turns after its first h.
    """
    with temporary_tables(conversations.sparkSession):
        members = kept_table(_members(conversations, period, most), "members")
        nodes = members.groupBy("id").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("words").alias("words"),
        )
        kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("p_id")).agg(F.count(F.lit(1)).alias("n_children"))
        nodes = nodes.join(kids, F.col("id") == F.col("p_id"), "left").drop("p_id").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        nodes = kept_table(nodes, "nodes")
        own = nodes.selectExpr("id", "parent", "(n_convs - 1) * words as w", "cast(if(n_children = 0, 1, 0) as bigint) as l")
        totals = subtree_totals(own).select(F.col("id").alias("t_id"), F.col("w").alias("saved_tokens"), F.col("l").alias("n_leaves"))
        above = nodes.select(F.col("id").alias("a_id"), F.col("conv_id").alias("parent_conv_id"))
        out = nodes.join(totals, F.col("id") == F.col("t_id")).join(_digests(members), F.col("id") == F.col("e_id"), "left")
        out = out.join(above, F.col("parent") == F.col("a_id"), "left")
        out = out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
        columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
        return kept_table(out.select(*columns), "trie", for_caller=True)
