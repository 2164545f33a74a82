"""Immutable, described versions of a set of tables, with a manifest written last."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.names import col
from tallyloom.sources.tables import safe_name, write_table_set

MANIFEST_SCHEMA = (
    "name string, version string, created timestamp, status string, description string, tables array<string>, "
    "parts array<struct<period string, version string>>"
)


def _home(root: str, name: str) -> str:
    return f"{root}/{safe_name(name)}"  # names are folded, so readers need not match the case


def _append(
    spark: SparkSession, root: str, name: str, version: str, status: str, text: str, tables: Sequence[str],
    parts: Sequence[tuple[str, str]] | None = None,
) -> None:
    entry = spark.createDataFrame([(name, version, None, status, text, list(tables), parts)], MANIFEST_SCHEMA)
    entry.withColumn("created", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
        _home(root, name) + "/manifest"
    )


def manifest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Current state of every version: its newest manifest entry."""
    entries = spark.read.schema(MANIFEST_SCHEMA).parquet(_home(root, name) + "/manifest")
    newest = entries.groupBy("version").agg(
        F.max_by(F.struct("name", "created", "status", "description", "tables", "parts"), F.col("created")).alias("e"),
        F.min("created").alias("published"),
    )
    return newest.select("version", "published", "e.name", "e.status", "e.description", "e.tables", "e.parts")


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    name: str,
    version: str,
    description: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write a new version. It becomes readable when its manifest entry lands, after all tables.

    A version is never rewritten: an existing directory is an error.
    """
    spark = next(iter(tables.values())).sparkSession
    paths = write_table_set(tables, f"{_home(root, name)}/version={version}", "errorifexists", partition_by)
    _append(spark, root, name, version, "current", description, sorted(paths))
    return paths


def retire(spark: SparkSession, root: str, name: str, version: str, reason: str = "superseded") -> None:
    """Mark an older version as retired; its files stay readable by explicit version."""
    known = {r["version"]: r for r in manifest(spark, root, name).where(F.col("version") == version).limit(1).collect()}
    if version not in known:
        raise ValueError(f"unknown version {version!r} of {name!r}")
    _append(spark, root, name, version, "retired", reason, known[version]["tables"], known[version]["parts"])


def latest_version(spark: SparkSession, root: str, name: str) -> Row:
    """Manifest row of the newest version still current."""
    rows = (
        manifest(spark, root, name)
        .where(F.col("status") == "current")
        .orderBy(F.col("published").desc(), F.col("version").desc())
        .limit(1)
        .collect()
    )
    if not rows:
        raise ValueError(f"no current version of {name!r}")
    return rows[0]


def read_version(
    spark: SparkSession, root: str, name: str, table: str, version: str | None = None
) -> DataFrame:
    """A table of a pinned version, or of the latest one."""
    chosen = version or latest_version(spark, root, name)["version"]
    return spark.read.parquet(f"{_home(root, name)}/version={chosen}/{safe_name(table)}")


_PART = "__period"


def _part_name(period: str) -> Column:
    """Folder of a period, whatever its value holds: letters and digits only."""
    return F.coalesce(F.concat(F.lit("p"), F.hex(col(period).cast("string"))), F.lit("none"))


def publish_periods(
    fresh: DataFrame, replaced: DataFrame, root: str, name: str, version: str, description: str, period: str
) -> None:
    """A new version of a history: ``fresh`` in place of the periods of ``replaced``; all others by reference.

    Only the fresh rows are written, to folders of the new version. The manifest entry that lists, for each
    period, the version whose folder holds it lands last; until then readers see the version before, and a run that
    fails in between leaves nothing but unread files. A replaced period without fresh rows is not listed any more.
    The periods, a handful, come to the driver.
    """
    spark = fresh.sparkSession
    folder = f"{_home(root, name)}/version={version}"
    marked = fresh.withColumn(_PART, _part_name(period))
    marked.hint("rebalance", F.col(_PART)).write.mode("errorifexists").partitionBy(_PART).parquet(folder)
    written = {r[0] for r in spark.read.schema(marked.schema).parquet(folder).select(_PART).distinct().collect()}
    gone = {r[0] for r in replaced.select(_part_name(period)).distinct().collect()} | written
    kept = [(p["period"], p["version"]) for p in _parts(spark, root, name) if p["period"] not in gone]
    parts = sorted([*kept, *((p, version) for p in written)])
    _append(spark, root, name, version, "current", description, [], parts)


def _parts(spark: SparkSession, root: str, name: str, version: str | None = None) -> list[Row]:
    try:
        known = manifest(spark, root, name).where(F.col("parts").isNotNull())
    except AnalysisException as e:  # no version yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    wanted = known.where(F.col("version") == version) if version else known.where(F.col("status") == "current")
    rows = wanted.orderBy(F.col("published").desc(), F.col("version").desc()).limit(1).collect()
    if not rows and version:
        raise ValueError(f"unknown version {version!r} of {name!r}")
    return rows[0]["parts"] if rows else []


def read_history(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """All periods of a history as of a version, or of the latest one."""
    parts = _parts(spark, root, name, version)
    if not parts:
        raise ValueError(f"no current version of {name!r}")
    paths = [f"{_home(root, name)}/version={p['version']}/{_PART}={p['period']}" for p in parts]
    return spark.read.option("mergeSchema", "true").parquet(*paths)
