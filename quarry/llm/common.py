"""Shared helpers: reading the tables, bounded Arrow batches, learning folds, word splitting."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: Rows that a worker turns into Python objects at a time; bounds its memory, not its input.
SLICE_ROWS = 256
#: Rows of an Arrow batch between the JVM and a worker (long texts: 10,000 of them are too many at once).
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to BATCH_ROWS if it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The non-empty batches in pieces of ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(
    docs: DataFrame, make: Callable, schema: str, columns: list[str | Column], binary: bool = False, many: bool = False
) -> DataFrame:
    """One output row for each input row.

    ``columns`` are passed through (as the first output columns); ``make()``
    runs once in a task and returns a function from a text (``str``, or
    ``bytes`` if ``binary``; null comes as empty) to the tuple of the further
    columns of ``schema``; with ``many``, from a list of texts to a list of tuples.
    Extra input columns are not read.
    """
    small_batches(docs.sparkSession)
    text = F.col("text").cast("binary") if binary else F.col("text").cast("string")
    passed = docs.select(*columns, text.alias("__text"))
    empty = b"" if binary else ""

    def run(batches):
        work = make()
        for piece in slices(batches):
            n = piece.num_columns - 1
            texts = [t if t is not None else empty for t in piece.column(n).to_pylist()]
            rows = work(texts) if many else [work(t) for t in texts]
            cols = [piece.column(i) for i in range(n)]
            cols += [pa.array(c, type=out_types[k]) for k, c in enumerate(zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    extra = _parse_datatype_string(schema)
    out = StructType(passed.schema.fields[:-1] + extra.fields)
    names = out.fieldNames()
    out_types = to_arrow_schema(extra).types
    return passed.mapInArrow(run, out)


def learn_fold(id_column: str, modulus: int, held: int) -> Column:
    """True for held-out rows: crc32 of the id as text leaves ``held``. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == held, F.lit(False))


_SCOPES: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that ``kept_table`` writes inside are deleted at the end (but those for the caller)."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for name in _SCOPES.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


def kept_table(df: DataFrame, tag: str, for_caller: bool = False) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the lineage, survives lost executors.

    Inside ``temporary_tables`` the table goes with it; with ``for_caller`` it
    belongs to the scope around that, if there is one.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    scopes = _SCOPES[:-1] if for_caller else _SCOPES
    if scopes:
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession, rounds: int = 1) -> None:
    """Let Spark's cleaner remove the files of shuffles that nothing refers to any more.

    It does so when the driver collects its garbage, which may be long after a
    large step's result has been written.  A query that has just ended is still held by
    its events for a moment, so a second round, a second later, frees that one too.
    """
    for k in range(rounds):
        if k:
            time.sleep(1)
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    if rounds > 1:
        time.sleep(1)


#: ASCII white space as the contracts list it: space and 0x09 to 0x0D (what bytes.split() splits on).
SPACE = b" \t\n\x0b\x0c\r"


def byte_chunks(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut only at ASCII spaces (0x20), so no word is split.

    Callers map every separator to a space first.
    """
    start, n = 0, len(data)
    if n <= size:
        yield data
        return
    while start < n:
        end = start + size
        if end < n:
            end = data.find(b" ", end)
            end = n if end < 0 else end
        yield data[start : min(end, n)]
        start = min(end, n)
