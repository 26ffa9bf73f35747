"""Session helpers: a local session for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the tile workloads rely on; a cluster passes the same at submit.
RECOMMENDED_CONF = {
    # runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tile rows are large (a 120x120x6 patch of doubles is ~0.7 MB): bound
    # Arrow batches by bytes, not only by record count
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """A local-mode session tuned for small test data (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=RECOMMENDED_CONF)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return path
