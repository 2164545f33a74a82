"""Joins: null-safe keys, checked lookups, coverage of a cover page, measure tables.

No join here is hinted. Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed partitions
of the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, cols, quote, renamed, shared_keys
from tallyloom.functions.values import check
from tallyloom.sources.staging import bounded, staging_folder

Keys = Sequence[str | tuple[str, str]]


def key_pairs(on: Keys) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "inner",
    suffixes: tuple[str, str] = ("", "_right"),
    null_match: bool = True,
) -> DataFrame:
    """Equi-join in which null keys match null keys.

    ``on`` holds names, or (left, right) pairs. The result has the left columns, then the
    right columns that are not keys; other name clashes take the suffixes. With
    ``null_match=False`` nulls match nothing, and tables bucketed on the keys need no shuffle.
    """
    pairs = key_pairs(on)
    right_keys = {r for _, r in pairs}
    left_keys = {l for l, _ in pairs}
    rest = [c for c in right.columns if c not in right_keys]
    clash = {c for c in rest if c in left.columns}
    if clash & left_keys:
        raise ValueError(f"right columns clash with join keys: {sorted(clash & left_keys)}")
    moved = {c: c + suffixes[1] if c in clash else c for c in rest}
    kept = {c: c + suffixes[0] if c in clash and how not in ("left_semi", "left_anti") else c for c in left.columns}

    probe = left if all(c == n for c, n in kept.items()) else left.selectExpr(*renamed(kept))
    keys = [f"{quote(r)} AS __key{i}" for i, (_, r) in enumerate(pairs)]
    build = right.selectExpr(*keys, *renamed(moved))
    cond = reduce(
        lambda a, b: a & b,
        [
            col(kept[l]).eqNullSafe(F.col(f"__key{i}")) if null_match else col(kept[l]) == F.col(f"__key{i}")
            for i, (l, _) in enumerate(pairs)
        ],
    )
    joined = probe.join(build, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    out = []
    merged = how in ("full", "outer", "full_outer", "right", "right_outer")
    at = {l: i for i, (l, _) in enumerate(pairs)}
    for c, n in kept.items():
        name = quote(n)
        out.append(f"coalesce({name}, __key{at[c]}) AS {name}" if merged and c in at else name)
    return joined.selectExpr(*out, *cols(moved.values()))


def join_shared(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Inner join of two screens on their derived key, clashing columns suffixed on both sides."""
    return null_safe_join(a, b, keys or shared_keys(a, b, exclude), "inner", suffixes)


def unique_rows(dim: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """The dimension unchanged, or a failed job when a key occurs twice."""
    rest = [c for c in dim.columns if c not in keys]
    packed = F.struct(*cols(rest)) if rest else F.struct(F.lit(1).alias("__one"))
    grouped = dim.groupBy(*cols(keys)).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(packed).alias("__row")
    )
    checked = grouped.where(check(F.col("__n") == 1, f"{what}: key {list(keys)} is not unique"))
    return checked.select(*cols(keys), *[F.col("__row").getField(c).alias(c) for c in rest]).select(
        *cols(dim.columns)
    )


@dataclass(frozen=True)
class Dimension:
    """A lookup that is checked and laid out: stored in buckets of its keys, which are unique."""

    df: DataFrame
    keys: tuple[str, ...]
    null_keys: bool


def lay_out(dim: DataFrame, keys: Sequence[str], what: str = "lookup", buckets: int | None = None) -> Dimension:
    """Store a lookup in buckets of its keys, and check once that they are unique.

    One shuffle writes it; the check and all joins on the keys read it where it lies. A key that occurs twice is an
    error. There are as many buckets as shuffle partitions, unless ``buckets`` says otherwise.
    """
    spark = dim.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"dim_{uuid.uuid4().hex}"
    plain = {c: f"c{i}" for i, c in enumerate(dim.columns)}  # names that any catalog takes
    by = [plain[k] for k in keys]
    stored = dim.selectExpr(*renamed(plain)).repartition(n, *by)
    with bounded(spark):
        stored.write.bucketBy(n, *by).sortBy(*by).option("path", f"{staging_folder(spark)}/{name}").format("parquet").saveAsTable(name)
    table = spark.table(name)
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in by])
    most, nulls = table.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.count_if(null)).first()
    if (most or 0) > 1:
        raise ValueError(f"{what}: key {list(keys)} is not unique")
    return Dimension(table.select(*[F.col(p).alias(c) for c, p in plain.items()]), tuple(keys), bool(nulls))


def lookup_left(
    df: DataFrame,
    dim: DataFrame | Dimension,
    on: Keys,
    unique: bool = True,
    suffixes: tuple[str, str] = ("", "_right"),
) -> DataFrame:
    """Left lookup join. ``unique`` fails the job when the lookup would multiply rows.

    A ``Dimension`` was checked when it was laid out. Where it has no null key, null keys meet nothing either way, and
    plain equality lets its buckets be read without a shuffle.
    """
    if isinstance(dim, Dimension):
        if {r for _, r in key_pairs(on)} != set(dim.keys):
            raise ValueError(f"laid out by {list(dim.keys)}, not by {[r for _, r in key_pairs(on)]}")
        return null_safe_join(df, dim.df, on, "left", suffixes, null_match=dim.null_keys)
    if unique:
        dim = unique_rows(dim, [r for _, r in key_pairs(on)])
    return null_safe_join(df, dim, on, "left", suffixes)


def keep_ids(df: DataFrame, ids: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key is in ``ids`` (null matches null)."""
    return null_safe_join(df, ids, on, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key is not in ``ids``."""
    return null_safe_join(df, ids, on, "left_anti")


def enrich_from_cover(
    tables: Mapping[str, DataFrame], cover: str, exclude: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Left-join every table to the cover page on the columns they share."""
    page = tables[cover]
    out = {}
    for name, df in tables.items():
        if name == cover:
            out[name] = df
            continue
        on = shared_keys(page, df, exclude)
        extra = [c for c in page.columns if c not in df.columns]
        out[name] = null_safe_join(df, page.select(*cols(on + extra)), on, "left")
    return out


def _gathered(frames: Sequence[DataFrame], on: Sequence[str], need_all: bool) -> DataFrame:
    measures = [[c for c in f.columns if c not in on] for f in frames]
    flat = [m for ms in measures for m in ms]
    if len(flat) != len(set(flat)):
        raise ValueError("measure names must differ between the tables")
    tagged = [f.select(*cols(f.columns), F.lit(i).alias("__src")) for i, f in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    seen = [F.count_if(F.col("__src") == i).alias(f"__n{i}") for i in range(len(frames))]
    grouped = stacked.groupBy(*cols(on)).agg(*[F.max(col(m)).alias(m) for m in flat], *seen)
    most = F.greatest(*[F.col(f"__n{i}") for i in range(len(frames))], F.lit(0))
    grouped = grouped.where(check(most <= 1, f"a measure table repeats a key of {list(on)}"))
    if need_all:
        grouped = grouped.where(reduce(lambda a, b: a & b, [F.col(f"__n{i}") == 1 for i in range(len(frames))]))
    return grouped.select(*cols(on), *cols(flat))


def outer_measures(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer join of measure tables, each unique on ``on``, in one shuffle.

    The tables are stacked and grouped once instead of joined pairwise; null keys meet.
    """
    return _gathered(frames, on, need_all=False)


def inner_measures(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Inner join of measure tables, each unique on ``on``, in one shuffle."""
    return _gathered(frames, on, need_all=True)


def align_key_types(
    left: DataFrame, right: DataFrame, on: Keys, dtype: str
) -> tuple[DataFrame, DataFrame]:
    """Cast the join keys of both sides to one type; texts that do not fit become null."""
    for l, r in key_pairs(on):
        left = left.withColumn(l, col(l).try_cast(dtype))
        right = right.withColumn(r, col(r).try_cast(dtype))
    return left, right
