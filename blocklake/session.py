"""Session helpers: the configuration every job relies on, and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the semantics depend on (not tuning knobs).
REQUIRED_CONF = {
    # `{"a":1,"a":2}` parses last-wins instead of failing the whole blob.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Merges overwrite only the hash buckets they touched.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Narrowing casts and 64-bit arithmetic fail loudly instead of wrapping.
    "spark.sql.ansi.enabled": "true",
}

# Settings that make a long batch or stream survive skew and executor loss.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the engine's semantics need to an existing session (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_spark(master: str | None = None, app: str = "blocklake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the engine's settings; extra `conf` wins."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {**RECOMMENDED_CONF, **REQUIRED_CONF, "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false", **conf}
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    On a cluster this must already be set (a shared file system path). Only a local-mode session with
    nothing configured (tests, the local bench) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
    d = tempfile.mkdtemp(prefix="blocklake-ckpt-", dir=os.environ.get("BLOCKLAKE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint root (each run gets its own)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
