"""SparkSession construction and cluster-safe defaults."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults a cluster deployment keeps; local runs override the partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "routeweave",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE on and the UI off.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for intermediate tables: the cluster's
    ``spark.checkpoint.dir`` (or the context's checkpoint folder).  Only a
    local session without either gets a private folder: on a cluster,
    executors could not see one, so that is an error.
    Works without a SparkContext handle too (Spark Connect)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = os.path.abspath(tempfile.mkdtemp(prefix="routeweave-ckpt-"))
    sc.setCheckpointDir(path)
    return path
