"""Session defaults and the shared work folder.

Written tables and streaming checkpoints live under the folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent (local
tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tickflow plan relies on: UTC wall clock (the test parquet is
# zone-less) and AQE so that joins against per-symbol tables are re-planned
# from measured sizes and skewed partitions are split at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tickflow", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, event log off)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local data is small: let AQE keep a few partitions instead of merging a
        # shuffle into one task (which then writes every partition folder alone)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the settings tickflow's semantics depend on (zone, dynamic overwrite)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark)
    current = sc.getCheckpointDir()
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark)
    # setCheckpointDir adds a fresh sub-folder each time: call it once only
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    """A folder of our own, in local mode only: executors elsewhere could not see it."""
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tickflow-ckpt-")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one table or query."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tickflow", f"{name}-{uuid.uuid4().hex[:12]}")
