"""Session defaults and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long texts: an Arrow batch ends at either bound.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


SMALL_SCAN = 32


def build_session(app: str = "lorefield", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Use every core on a table that is read in fewer partitions than there are cores.

    Only scans of less than ``SMALL_SCAN`` partitions (some GB) are moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, SMALL_SCAN) else df


#: Bounds of an Arrow batch of whole texts: every task holds a batch and what is made of it.
TEXT_ROWS, TEXT_BYTES = 512, 8 << 20


def bound_batches(spark: SparkSession | None) -> None:
    """Lower a session's Arrow batches to the bounds for whole texts; smaller ones stay."""
    for name, most in (("maxRecordsPerBatch", TEXT_ROWS), ("maxBytesPerBatch", TEXT_BYTES)) if spark else ():
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key)
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_dir()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="lorefield-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created there."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
