"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Joins keep no strategy hint except for checked
# code tables, so AQE must be free to re-plan and to split skewed join partitions.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # what goes to a Python worker at once; records may be whole texts
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_ROOT: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required: a folder on one machine is lost with it. Only a
    local session without the setting gets a fresh temporary folder, once per process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="medtable-"))
    return _LOCAL_ROOT[0]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{checkpoint_root(spark).rstrip('/')}/medtable/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Cut the lineage of an iterative job with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{checkpoint_root(spark).rstrip('/')}/medtable/checkpoints")
    return df.checkpoint()
