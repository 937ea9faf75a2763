"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_KEY = "spark.ledgermill.scratch.dir"

SETTINGS = {
    # Financial-year edges depend on the zone, so it is always pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dedupe state of a long lateness window does not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle width for a cluster: about 128 MB per partition, two waves at least.

    Adaptive execution joins partitions that turn out small, so the width is
    chosen for the largest shuffle and not for the average one.
    """
    partitions = max(2 * cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
    return {"spark.sql.shuffle.partitions": str(partitions)}


def build_session(
    app: str = "ledgermill", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """Session with the settings the operators expect; ``extra`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Without one, a cluster is refused: its executors do not see each other's disks. A
    session on one machine gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgermill-")
        spark.conf.set(SCRATCH_KEY, base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder."""
    return os.path.join(checkpoint_base(spark), "ledgermill", f"{name}-{uuid.uuid4().hex}")


def kept_copy(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the scratch folder and read back, so that Spark knows their size."""
    copy = scratch_dir(rows.sparkSession, name)
    rows.write.parquet(copy)
    return rows.sparkSession.read.schema(rows.schema).parquet(copy)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(target)
