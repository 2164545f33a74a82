"""Which extract files were read already: a ledger of files, and what a listing has beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.joins import drop_ids
from tallyloom.sources.tables import read_with_lineage

SCHEMA = "path string, length long, modified timestamp, batch string, recorded timestamp"
_FILE = ["path", "length", "modified"]


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """The files of a glob, with length and time of change; no content is read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def recorded(spark: SparkSession, ledger: str) -> DataFrame:
    """Files that earlier batches read; none before the first."""
    try:
        return spark.read.schema(SCHEMA).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def unread(spark: SparkSession, pattern: str, ledger: str) -> DataFrame:
    """Files of the glob that the ledger does not have as they are now: new ones, and those that changed since."""
    return drop_ids(listing(spark, pattern), recorded(spark, ledger).select(*_FILE), _FILE)


def read_unread(
    spark: SparkSession, pattern: str, ledger: str, fmt: str = "parquet", **lineage
) -> tuple[DataFrame | None, Sequence]:
    """Rows of the unread files, with file name and pull date, and the files themselves; None where there are none.

    The names of the files of one batch come to the driver, as any scan's do. Give them to ``record`` once what was
    made of the rows is stored: a batch that fails before is read again.
    """
    files = unread(spark, pattern, ledger).orderBy("path").collect()
    if not files:
        return None, []
    return read_with_lineage(spark, [f.path for f in files], fmt, **lineage), files


def record(spark: SparkSession, ledger: str, files: Sequence, batch: str) -> None:
    """Note the files of a batch as read, in one file of the ledger."""
    rows = [(f.path, f.length, f.modified, batch) for f in files]
    entry = spark.createDataFrame(rows, "path string, length long, modified timestamp, batch string")
    entry.withColumn("recorded", F.current_timestamp()).coalesce(1).write.mode("append").parquet(ledger)
