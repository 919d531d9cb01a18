"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeweave.session import ensure_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read
    back: cuts the lineage, and survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/routeweave-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, n: int):
    """Arrow batches of at most ``n`` rows for the jobs run inside the block:
    for tables whose rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def planes(x) -> bytes:
    """An integer array as byte planes, high bytes first: sorted values
    compress well in a shuffle."""
    big = x.astype(x.dtype.newbyteorder(">"))
    return big.view("u1").reshape(len(x), x.dtype.itemsize).T.tobytes()


def from_planes(data: bytes, dtype: str):
    """The array that ``planes`` wrote."""
    import numpy as np

    dtype = np.dtype(dtype)
    flat = np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1).T
    return np.ascontiguousarray(flat).view(dtype.newbyteorder(">")).ravel().astype(dtype)
