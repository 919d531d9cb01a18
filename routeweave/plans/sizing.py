"""Intermediate tables in the session's shared folder."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a parquet table under the session's checkpoint
    folder (the shared folder a cluster names in ``spark.checkpoint.dir``)
    and continue from the written copy.

    This cuts lineage - a lost executor re-reads files instead of
    recomputing the upstream - and a result used by several branches of
    a plan is computed once.  One job writes the table; unlike an RDD
    checkpoint nothing is computed twice."""
    spark = df.sparkSession
    path = f"{_scope_root(spark)}/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_LOCAL = threading.local()   # scopes per driver thread (stream callbacks run in their own)


def _scopes() -> list:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def _scope_root(spark) -> str:
    from routeweave.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/routeweave-tables"
    return f"{base}/{_scopes()[-1]}" if _scopes() else base


@contextmanager
def scratch_scope(spark, name: str | None = None):
    """Group the tables ``materialize`` writes inside the block under one
    folder and delete it on exit (a service calls this per micro-batch,
    once the batch's output is written)."""
    _scopes().append(name or uuid.uuid4().hex)
    root = _scope_root(spark)
    try:
        yield root
    finally:
        _scopes().pop()
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
