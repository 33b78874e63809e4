"""Compaction: bins by size, large files byte for byte where they were, rows unchanged."""

import hashlib
import os
import random
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from quarry.operators import compaction as C
from quarry.session import scratch_path
from quarry.sources import files


def _local(path):
    return unquote(urlparse(path).path)


def _hash(path):
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


@pytest.mark.parametrize("seed", range(3))
def test_bins_of_random_sizes(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"f{k:04}", rnd.choice([0, 1, rnd.randrange(50), rnd.randrange(400)]), rnd.choice(["a", "a", "b", None])) for k in range(200)]
    listing = spark.createDataFrame(rows, "file string, bytes long, p string")
    got = C.bins(listing, 100, ["p"], partitions=rnd.choice([1, 7])).collect()
    sizes, place = {f: n for f, n, _ in rows}, {f: p for f, _, p in rows}
    by_bin = {}
    for r in got:
        assert sizes[r.file] == r.bytes < 100 and place[r.file] == r.p
        by_bin.setdefault(r.bin, []).append(r.file)
    assert len(got) == len({r.file for r in got}) and sorted(by_bin) == list(range(len(by_bin)))
    for held in by_bin.values():
        assert len(held) > 1 and sum(sizes[f] for f in held) < 200 and len({place[f] for f in held}) == 1
    # what stays alone would not fit with its neighbours: fewer than two small files in a stretch of the target
    small = sorted((str(p), f) for f, n, p in rows if n < 100)
    alone = len(small) - len(got)
    assert len(by_bin) + alone <= sum(sum(n for _, n, q in rows if q == p and n < 100) // 100 + 1 for p in ("a", "b", None))


@pytest.mark.parametrize("keys", [[], ["p"]])
def test_small_files_are_packed_and_large_ones_stay(spark, keys):
    source = scratch_path(spark, "small")
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y=/ 1").alias("p"))
    files.write(df.where("id < 3000").coalesce(1), source, partition_by=keys)
    for k in range(12):
        files.write(df.where(f"id >= 3000 and id % 12 = {k}").coalesce(1), source, mode="append", partition_by=keys)
    before = {r.file: r.bytes for r in C.data_files(spark, source, keys).collect()}
    hashes = {f: _hash(_local(f)) for f in before}
    target = 30_000
    table = C.compact(spark, source, scratch_path(spark, "packed"), target, keys, partitions=5)
    large = {f for f, n in before.items() if n >= target}
    assert large and large <= set(table.untouched) and {f: _hash(_local(f)) for f in before} == hashes
    packed = C.data_files(spark, table.packed, keys).collect()
    assert 0 < len(packed) < (len(before) - len(table.untouched)) / 2 and all(r.bytes < 2 * target for r in packed)
    got = C.read_compacted(spark, table)
    assert sorted(got.columns) == sorted(df.columns)
    assert got.exceptAll(df.select(got.columns)).isEmpty() and df.select(got.columns).exceptAll(got).isEmpty()


def test_nothing_to_pack(spark):
    source = scratch_path(spark, "large")
    files.write(spark.range(5000).coalesce(1), source)
    table = C.compact(spark, source, scratch_path(spark, "packed"), 100, partitions=3)
    assert table.packed is None and len(table.untouched) == 1 and not os.path.exists(_local(scratch_path(spark, "packed")))
    assert C.read_compacted(spark, table).count() == 5000
    with pytest.raises(ValueError, match="target"):
        C.compact(spark, source, scratch_path(spark, "packed"), -1, partitions=3)
