"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings that hold from a laptop to a large cluster: AQE sizes the reduce side from the bytes it
# sees, splits skewed partitions and merges small ones, so no fixed partition count is baked in.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app_name: str,
    time_zone: str,
    *,
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create a session. ``time_zone`` decides how wall-clock text becomes a timestamp and which day
    and hour a reading falls into, so it has no default."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    merged = DEFAULTS | {"spark.sql.session.timeZone": time_zone} | dict(settings or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch_root() -> str:
    return tempfile.mkdtemp(prefix="gustline-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder every executor can reach (``spark.checkpoint.dir``)."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        root = _local_scratch_root()
    return f"{root.rstrip('/')}/gustline/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return a scan of it.

    Used where several jobs (index fit, model fit, scoring, statistics) need the same frame: they
    read the small result instead of repeating the scan and shuffle behind it, and a lost executor
    costs a re-read rather than a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
