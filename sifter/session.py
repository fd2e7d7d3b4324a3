"""Spark session defaults for the moderation jobs.

Cluster deployments pass their own configuration (``spark-submit --conf``);
``get_session`` only fills in keys that are still unset, so it never
overrides what a cluster operator chose.  ``checkpoint_root`` reads the
shared checkpoint folder from the session and only invents a local one when
none is configured (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults tuned for correctness-first runs; every one is only a fallback.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for the automaton UDF: big enough to amortise the
    # JVM<->Python hop, small enough that 33k-char texts stay in cache.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    # ...and bounded in bytes too, so a batch of very long texts stays small.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames that are gone are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Repeated JSON keys: last one wins, as in Go's decoder.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str | None = None, app_name: str = "sifter",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the package defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        # getOrCreate may return a session started elsewhere: only fill gaps,
        # and only SQL settings can change on a running session.
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a scratch one only if unset in local mode.

    On a cluster an unset folder is an error: a machine-local folder would
    scatter checkpoint files over the executors' disks.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares (HDFS, object store)")
    local = tempfile.mkdtemp(prefix="sifter-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def checkpoint_root(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for stream checkpoints and cut lineage)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, *parts) if parts else root


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage, fixes row numbers, and lets later reads prune columns.
    """
    path = checkpoint_root(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
