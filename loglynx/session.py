"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app_name: str = "loglynx") -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster the master and resources come from spark-submit; the
    settings here are only defaults for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    ensure_session(spark)
    return spark


def cluster_settings(total_input_bytes: int, executor_cores: int = 4, executors: int = 1000) -> dict:
    """Suggested settings for a large cluster run (pass to spark-submit --conf).

    Shuffle partitions start at ~1 per GB of input, clamped to 3-25x the
    cores (shuffled data is far smaller than the input after pruning,
    filtering and map-side combine; AQE coalesces small partitions and
    splits skewed ones at run time); file splits of 512 MB keep the scan
    task count manageable; RocksDB keeps streaming state off-heap and
    spills it to disk.
    """
    cores = executor_cores * executors
    parts = min(max(cores * 3, total_input_bytes // (1024 ** 3)), cores * 25)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # drop checkpoint files once unreferenced
        "spark.ui.enabled": "false",
    }


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on.

    Timestamps are compared and rendered in UTC; naive source times are
    read as UTC unless a parser is given another ``source_tz``.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, streaming state and hand-over tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared
    folder there). Only when it is unset and the master is local, as in tests,
    a folder under the system temp dir is created and registered, and removed
    when the process ends; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="loglynx-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    path = f"{root}{sep}loglynx/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path


def materialize(df):
    """Compute ``df`` once and cut its lineage: a reliable checkpoint in the shared
    checkpoint folder (survives executor loss; later branches read the files
    instead of recomputing the plan)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
