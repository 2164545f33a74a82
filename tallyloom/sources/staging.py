"""Cutting lineage: intermediate tables written to the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Shuffle files of what has ended go at once, not when the driver's memory is next collected; and a batch of rows that
# crosses to Python is small beside the memory of a worker, whatever the session allows.
_WHILE_STAGING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def staging_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset and local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@contextmanager
def bounded(spark: SparkSession) -> Iterator[None]:
    """What runs in here drops its spent shuffles and takes small batches to Python."""
    before = {k: spark.conf.get(k, None) for k in _WHILE_STAGING}
    for k, v in _WHILE_STAGING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write an intermediate table and read it back; ``codec`` is for large ones that wait long.

    The plan restarts from Parquet: executors may be lost without recomputing what came
    before, statistics are exact, and later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{uuid.uuid4().hex}"
    with bounded(spark):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    staged = spark.read.parquet(path)
    staged.staged_at = path
    return staged


def release(*staged: DataFrame) -> None:
    """Give back the space of tables that ``stage`` returned and nothing will read again: they become empty."""
    for df in staged:
        spark = df.sparkSession
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.staged_at)
