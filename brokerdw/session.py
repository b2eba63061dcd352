"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the engine is tuned for; a cluster passes its own master and memory.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


# Spark then removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[8]", app: str = "brokerdw", **conf: str) -> SparkSession:
    """A local session with the recommended settings (tests and bench)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where the setting is absent a session on one machine takes a local folder, which is
    removed when Python ends; a session on a cluster raises, because its executors would
    each write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_root()
    return f"{shared.rstrip('/')}/brokerdw-{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df``; its shuffle files go when the table is complete, which cuts the lineage, and not at some later time."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


@cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="brokerdw-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root
