"""Incremental load: each run processes only the files that arrived since
the previous run (a job bookmark), using a file-source stream with a
checkpoint and an ``availableNow`` trigger.

The checkpoint records which files were read and which output batches were
committed, so a run that dies half-way is redone exactly once on restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Micro-batches of a run whose reports are kept (a small record for each).
_KEPT, _MOST_REPORTS = "spark.sql.streaming.numRecentProgressUpdates", 1_000_000


def run_incremental(
    spark: SparkSession,
    landing: str,
    sink: str,
    checkpoint: str,
    schema: StructType,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: tuple[str, ...] = (),
    max_files_per_trigger: int | None = None,
) -> int:
    """Process every file in ``landing`` not seen by an earlier run; append
    the rows to ``sink``.  Returns the number of rows of the micro-batches that this run
    completed, as observed while they were written: nothing is read again, so the cost of a
    run depends on what arrived and not on the sink.  A batch that an earlier run began and did not complete is
    redone, and counted, by the run that completes it."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing)
    if transform is not None:
        stream = transform(stream)
    stream = stream.observe("run", F.count(F.lit(1)).alias("rows"))
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_KEPT)
    spark.conf.set(_KEPT, str(_MOST_REPORTS))  # the query takes the settings of its start
    try:
        q = writer.start(sink)
        q.awaitTermination()
    finally:
        spark.conf.set(_KEPT, before)
    if q.exception() is not None:
        raise q.exception()
    rows = {p["batchId"]: p["observedMetrics"]["run"]["rows"] for p in q.recentProgress if "run" in p["observedMetrics"]}
    return sum(rows.values())
