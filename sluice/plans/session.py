"""Session helpers: build a local session for tests/bench, and find the shared
scratch folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on; a cluster's own values win where they exist.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "sluice") -> SparkSession:
    """A local session for tests and the bench (the Spark UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session; only when it is unset (local tests) is a private
    folder created and registered, so lineage cuts and scratch tables always
    land where every executor can see them.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return (spark.sparkContext.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
