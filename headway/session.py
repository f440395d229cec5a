"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Run-time settings the plans rely on. Joins are left to adaptive execution:
# it broadcasts a side only after its size is known, and it splits hot keys of
# shuffled joins. The last setting keeps windows and aggregations from
# inheriting a join's partitioning on a part of their keys, which would both
# concentrate a hot key and keep adaptive execution from splitting it. Tables are
# written once and kept, so their files are worth a slower codec. Rows go to Python by
# the megabyte, since a row may hold a payload of any size.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that already exists."""
    for key, value in SCALE_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: str = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    warehouse: str | None = None,
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("headway")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        # Small inputs: keep all cores busy rather than partitions large.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"headway-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting a local session gets a folder of its own; a cluster
    session is refused, because a machine-local folder would not be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = _local_folder(spark.sparkContext.applicationId)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
