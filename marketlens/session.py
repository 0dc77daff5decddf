"""Spark session and cluster-level settings used by every job.

The library never hard-codes cluster sizing: it only fills settings that the
caller (spark-submit, spark-defaults.conf, a notebook) left unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every report relies on for correct results (same on every cluster).
REQUIRED_CONF = {
    # PostgreSQL TIMESTAMP has no zone; all date arithmetic must be zone-free.
    "spark.sql.session.timeZone": "UTC",
    # Division by zero and overflow must raise, as they do in the reference.
    "spark.sql.ansi.enabled": "true",
}

# Defaults for throughput; only applied where the deployment left them unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Dimension tables under 32 MB are broadcast; Spark checks the size from
    # plan statistics and AQE re-checks it from the real shuffle output.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}
# Static settings that can only be given before the session starts: no web UI,
# and checkpoint files are removed once the DataFrames using them are gone.
STATIC_DEFAULTS = {"spark.ui.enabled": "false", "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(master: str | None = None, app_name: str = "marketlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()  # spark-defaults.conf and spark-submit --conf
    unset = {k: v for k, v in STATIC_DEFAULTS.items() if not given.contains(k)}
    for key, value in {**unset, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark, defaults=True)
    return spark


def configure(spark: SparkSession, defaults: bool = False) -> SparkSession:
    """Apply the required settings to an existing session (idempotent).

    With ``defaults=True`` the throughput defaults are also applied, but only
    for keys the deployment did not set (spark-defaults.conf, spark-submit
    ``--conf`` or the builder).
    """
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    if defaults:
        given = spark.sparkContext.getConf()
        for key, value in DEFAULT_CONF.items():
            if not given.contains(key):
                spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used as is; a cluster session without one is an error. Only a
    local-mode session without one (a unit test) gets a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        # A machine-local folder would be lost with its executor.
        raise RuntimeError("Set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster.")
    folder = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables next to the session's checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/marketlens-scratch/{name}"
