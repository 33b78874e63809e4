"""Session builder and the shared scratch folder.

Everything a query writes goes below the folder the cluster names in
``spark.checkpoint.dir`` (shared storage on a cluster).  Only when that
setting is absent -- local runs and tests -- do we pick a folder ourselves.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "quarry",
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """One builder for every entry point: UI off, AQE on, ANSI on, UTC."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session; set our own only where it is unset and the master
    is local (tests).  On a cluster a folder of one machine would not do, so
    there an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.match(r"local(\[[^]]*\])?$", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the whole cluster shares")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/quarry/{tag}-{uuid.uuid4().hex[:12]}"
