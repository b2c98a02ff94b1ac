"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_DIR: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidelog",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session configured like the clusters this package targets
    (AQE on, UTC session zone, UI off).  Tests and the bench use it;
    ``event_log_dir`` turns on Spark's event log there (stage metrics)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDELOG_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder on storage every executor sees, taken from ``spark.checkpoint.dir``.

    On a cluster that setting has to name a shared folder.  Only a local
    session (one machine) gets a temporary folder where it is unset, registered
    as the checkpoint dir and removed when Python ends.
    """
    global _FALLBACK_DIR
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
    if _FALLBACK_DIR is None:
        _FALLBACK_DIR = tempfile.mkdtemp(prefix="tidelog-shared-")
        atexit.register(shutil.rmtree, _FALLBACK_DIR, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(_FALLBACK_DIR)
    return _FALLBACK_DIR


def scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder under the shared dir."""
    return f"{shared_dir(spark)}/tidelog-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the application's scratch folder (one per call)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application left in its scratch folder; results that were
    not written elsewhere can no longer be read afterwards."""
    remove(spark, scratch_root(spark))


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder and what it holds, on whatever file system it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
