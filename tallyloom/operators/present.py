"""Final shaping of small result tables: declared order, top k, bands, stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, cols
from tallyloom.sources.tables import literal_table


def level_rank(c: Column, levels: Sequence[str]) -> Column:
    """Position of a value in the declared levels, from 1; null for others."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in levels]), c), F.lit(0)).cast("int")


def order_by_levels(
    df: DataFrame,
    column: str,
    levels: Sequence[str],
    before: Sequence[str] = (),
    after: Sequence[str] = (),
    rank: str | None = None,
) -> DataFrame:
    """Sort by a declared order; values outside the levels come last. ``rank`` keeps the position."""
    at = rank or "__rank"
    ranked = df.withColumn(at, level_rank(col(column), levels))
    out = ranked.orderBy(*cols(before), col(at).asc_nulls_last(), *cols(after))
    return out if rank else out.drop(at)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a report. Give a total order: ties are cut by it."""
    return df.orderBy(*order_by).limit(k)


def stack(
    frames: Sequence[DataFrame], casts: Mapping[str, str] | None = None
) -> DataFrame:
    """Union by name; absent columns are null and the named columns are cast first."""
    def ready(df: DataFrame) -> DataFrame:
        wanted = {c: t for c, t in (casts or {}).items() if c in df.columns}
        return df.withColumns({c: col(c).try_cast(t) for c, t in wanted.items()}) if wanted else df

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [ready(f) for f in frames])


def align_columns(df: DataFrame, like: DataFrame | Sequence[str]) -> DataFrame:
    """Select the columns of another table, in its order; absent ones are typed nulls."""
    if isinstance(like, DataFrame):
        fields = [(f.name, f.dataType) for f in like.schema.fields]
    else:
        fields = [(n, None) for n in like]
    return df.select(
        *[
            col(n) if n in df.columns else F.lit(None).cast(t if t is not None else "string").alias(n)
            for n, t in fields
        ]
    )


def with_constants(df: DataFrame, values: Mapping[str, object], dtype: str = "string") -> DataFrame:
    """Constant columns; None gives a typed null placeholder."""
    return df.withColumns(
        {n: F.lit(None).cast(dtype) if v is None else F.lit(v) for n, v in values.items()}
    )


def with_band_rows(
    df: DataFrame, block: str, label: str, blocks: Sequence | Mapping, position: str = "band_row"
) -> DataFrame:
    """Put a heading row before each block. ``position`` is 0 for headings, 1 for rows."""
    named = dict(blocks) if isinstance(blocks, Mapping) else {b: str(b) for b in blocks}
    heads = literal_table(
        df.sparkSession, {block: dict(df.dtypes)[block], label: "string"}, list(named.items())
    )
    return df.withColumn(position, F.lit(1)).unionByName(
        heads.withColumn(position, F.lit(0)), allowMissingColumns=True
    )
