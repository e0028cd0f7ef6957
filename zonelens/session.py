"""Session construction and shared-folder helpers.

On a cluster the session comes from the launcher; ``ensure_scale_conf`` only
fills in settings that were not given.  Scratch output (written tables that
cut lineage, streaming checkpoints) always goes below the folder named by
``spark.checkpoint.dir``; a local folder is created only when that setting
is absent and the master is local (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale; applied only where the launcher left a gap.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "zonelens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local / test session. Cluster jobs get their session from the launcher."""
    master = master or os.environ.get("ZONELENS_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("ZONELENS_DRIVER_MEM", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in SCALE_DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_scale_conf(spark)
    return spark


_APPLIED: set = set()


def was_set(spark: SparkSession, key: str) -> bool:
    """Whether a setting was given explicitly (its default value does not count)."""
    return bool(spark._jsparkSession.sessionState().conf().contains(key))


def ensure_scale_conf(spark: SparkSession) -> SparkSession:
    """Fill in the settings the caller did not give (once per application).

    All epoch-millisecond arithmetic assumes UTC, so another explicit time zone is an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _APPLIED:
        _APPLIED.add(app)
        for k, v in SCALE_DEFAULTS.items():
            if not was_set(spark, k):
                spark.conf.set(k, v)
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; the snapshot arithmetic needs UTC")
    return spark


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, through Hadoop's file system (so any store Spark reads);
    empty when there are none, an error when the store cannot be reached."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found or [])


def path_version(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(bytes, modification time) of a file or folder on any store Spark reads; None if absent.
    Tells whether a table derived from it earlier is still up to date."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written tables, from ``spark.checkpoint.dir``.

    Only a local master (tests, local runs) may go without the setting: there a
    folder is created and registered, so that later calls agree on it.  On a
    cluster the executors could not see such a folder, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="zonelens-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/zonelens/{name}-{uuid.uuid4().hex[:12]}"
