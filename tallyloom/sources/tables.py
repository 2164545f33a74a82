"""Table sets and lookups: one directory or file per table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.names import col
from tallyloom.operators.resolve import distinct_on


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: str | None = None,
    overrides: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """One table; ``overrides`` casts named columns (ZIP codes to text, for one).

    CSV is read as text when no schema is given, so nothing is inferred from the data. ``multi_line`` is for CSV
    with line breaks and doubled quotes inside quoted answers; such a file is then read by one task.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        df = reader.csv(path, header=True, enforceSchema=False, multiLine=multi_line, escape='"' if multi_line else None)
    else:
        df = reader.format(fmt).load(path)
    wanted = {c: t for c, t in (overrides or {}).items() if c in df.columns}
    return df.withColumns({c: col(c).cast(t) for c, t in wanted.items()}) if wanted else df


def read_table_set(
    spark: SparkSession,
    root: str,
    names: Sequence[str],
    fmt: str = "parquet",
    overrides: Mapping[str, str] | None = None,
    suffix: str = "",
    multi_line: bool = False,
    row_order: bool = False,
) -> dict[str, DataFrame]:
    """All screens of a submission: ``<root>/<name><suffix>`` each. ``row_order`` adds the place of every row."""
    out = {n: read_table(spark, f"{root}/{n}{suffix}", fmt, overrides=overrides, multi_line=multi_line) for n in names}
    return {n: with_row_order(df, fmt) for n, df in out.items()} if row_order else out


def with_row_order(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Source position of every row of a scan: file, then row within the file.

    Needed where the first or last row counts; stable whatever the splits. Parquet numbers its rows. For text formats
    the rows of each split are counted first; a split's rows then start at the sum over the splits before it.
    """
    path = F.col("_metadata.file_path")
    if fmt == "parquet":
        return df.select("*", path.alias("source_path"), F.col("_metadata.row_index").alias("row_ix"))
    # Within a task ids rise by one per row, and a split is read in one stretch.
    numbered = df.select(
        "*", path.alias("source_path"), F.col("_metadata.file_block_start").alias("__split"), F.monotonically_increasing_id().alias("__id")
    )
    splits = numbered.groupBy("source_path", "__split").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy("source_path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("source_path", "__split", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    placed = numbered.join(starts, ["source_path", "__split"])
    row = (F.col("__before") + F.col("__id") - F.col("__first")).alias("row_ix")
    return placed.select(*[col(c) for c in df.columns], "source_path", row)


def read_lookup(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    unique_on: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A lookup table, cut to the first row per key when ``unique_on`` is given."""
    df = read_table(spark, path, fmt)
    return distinct_on(df, unique_on, order_by) if unique_on else df


def read_with_lineage(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    date_regex: str | None = r"_(\d{8})\.",
    date_format: str = "yyyyMMdd",
    level: int = -1,
) -> DataFrame:
    """Extract files by glob, each row with its file name and the pull date in that name.

    ``level`` says which part of the path is the extract's name: -1 the file, -2 its folder.
    """
    df = read_table(spark, path, fmt)
    out = df.select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), level).alias("source_file"))
    if date_regex:
        text = F.regexp_extract("source_file", date_regex, 1)
        out = out.withColumn("pull_date", F.try_to_timestamp(text, F.lit(date_format)).cast("date"))
    return out


def literal_table(spark: SparkSession, columns: Mapping[str, str], rows: Sequence[Sequence]) -> DataFrame:
    """A small table of fixed rows, planned with its true size so that joins can broadcast it."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(columns.items(), row, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def safe_name(name: str) -> str:
    """Directory name of a table: letters, digits and underscores."""
    return re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_").lower()


def write_table_set(
    tables: Mapping[str, DataFrame],
    root: str,
    mode: str = "errorifexists",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write each table to its own directory under ``root``; returns name -> path."""
    paths = {n: f"{root}/{safe_name(n)}" for n in tables}
    if len(set(paths.values())) != len(paths):
        raise ValueError("two table names share a directory")
    for name, df in tables.items():
        writer = df.write.mode(mode)
        by = (partition_by or {}).get(name)
        (writer.partitionBy(*by) if by else writer).parquet(paths[name])
    return paths


def overwrite_periods(df: DataFrame, path: str, period: str) -> None:
    """Replace only the periods present in ``df`` in a history stored by period.

    Rows are rebalanced by period: adaptive execution splits a large period over many tasks
    and files, and merges small ones.
    """
    (
        df.hint("rebalance", col(period))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )


def drop_periods(spark: SparkSession, path: str, period: str, values: Iterable) -> None:
    """Empty whole periods of a history stored by period; absent ones are no error."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for v in values:
        name = "__HIVE_DEFAULT_PARTITION__" if v is None else escape(str(v))
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{escape(period)}={name}")
        folder.getFileSystem(conf).delete(folder, True)
