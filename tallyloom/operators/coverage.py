"""What was expected against what came: grids, missing members, contingency tables.

Declared axes are exploded. Observed axes are measured and cut into tiles, arrays of bounded length; the other
side is copied once per tile, so that a short axis costs no copy and no task holds a long one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, cols
from tallyloom.operators.joins import drop_ids, key_pairs, lookup_left, null_safe_join
from tallyloom.sources.staging import stage

#: Axis rows in a tile, and base rows that meet a tile in one task where there are several tiles.
TILE_ROWS, CHUNK_ROWS = 1024, 16_384


def tiles_of(axis: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """``__tile, __values``: the rows of an axis as arrays of about ``rows`` structs, and the number of tiles."""
    measured = stage(axis)
    n = max(1, -(-measured.count() // rows))
    if n == 1:
        number = F.lit(0)
    else:
        number = F.pmod(F.xxhash64(*cols(axis.columns)), F.lit(n)).cast("int")
    packed = measured.select(number.alias("__tile"), F.struct(*cols(axis.columns)).alias("__value"))
    return stage(packed.groupBy("__tile").agg(F.collect_list("__value").alias("__values"))), n


def meet_tiles(base: DataFrame, axis: DataFrame, tile_rows: int = TILE_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Every row of ``base`` with every tile of ``axis``, as an array ``__values``.

    Both sides are counted. An axis of one tile meets the rows where they lie. Of a longer one, the base is copied once
    per tile and cut into chunks, each of which meets one tile per task; tiles are copied once per chunk.
    """
    tiles, n = tiles_of(axis, tile_rows)
    chunks = 1
    if n > 1:
        base = stage(base)
        chunks = max(1, -(-base.count() // chunk_rows))
    chunk = F.pmod(F.xxhash64(*cols(base.columns)), F.lit(chunks)).cast("int")
    left = base.withColumn("__chunk", chunk)
    if n > 1:
        left = left.withColumn("__tile", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    right = tiles.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    met = left.join(right, ["__chunk", "__tile"]) if n > 1 else left.join(right.drop("__tile"), "__chunk")
    return met.select(*cols(base.columns), "__values")


def every_pair(base: DataFrame, axis: DataFrame, **sizes: int) -> DataFrame:
    """Every row of ``base`` with every row of ``axis``, by tiles."""
    return meet_tiles(base, axis, **sizes).select(*cols(base.columns), F.inline("__values"))


def expand_grid(base: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """Every row of ``base`` for every combination of declared values, by axis."""
    out = base
    for name, values in axes.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return out


def expand_observed(base: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Every row of ``base`` for every value of ``column`` seen in ``source``."""
    return every_pair(base, source.select(col(column)).distinct())


def complete_against(
    df: DataFrame,
    expected: DataFrame,
    on: Sequence[str | tuple[str, str]],
    flag: str = "Missing",
    seen: DataFrame | None = None,
) -> DataFrame:
    """Every expected combination with its rows, or one flagged row; unexpected rows drop out.

    ``expected`` is unique on its keys. ``seen`` may be given where another frame has the same keys as ``df`` at less
    cost. Found rows stream past the small grid; missing cells
    come from an anti-join against the folded keys. An outer join would put all rows of a hot
    cell into one task.
    """
    pairs = key_pairs(on)
    left_keys, grid_keys = [l for l, _ in pairs], [r for _, r in pairs]
    found = null_safe_join(df, expected, pairs, "inner").withColumn(flag, F.lit(False))
    came = (df if seen is None else seen).select(*cols(left_keys)).distinct()
    absent = drop_ids(expected, came, [(r, l) for l, r in pairs])
    renamed = absent.select(
        *[col(r).alias(l) for l, r in pairs], *cols(c for c in expected.columns if c not in grid_keys)
    ).withColumn(flag, F.lit(True))
    return found.unionByName(renamed, allowMissingColumns=True)


def unexpected(df: DataFrame, expected: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """The rows ``complete_against`` drops."""
    return drop_ids(df, expected, on)


def missing_members(
    df: DataFrame, roster: Sequence | DataFrame, period: str, member: str
) -> DataFrame:
    """Roster members without a row, per observed period."""
    present = df.select(col(period), col(member)).distinct()
    if isinstance(roster, DataFrame):
        members = roster.select(col(member)).distinct()
        present = stage(present)
        expected = expand_observed(members, present, period).select(col(period), col(member))
    else:
        expected = expand_grid(present.select(col(period)).distinct(), {member: list(roster)})
    return drop_ids(expected, present, [period, member])


def complete(
    df: DataFrame, axes: Mapping[str, Sequence], fill: Mapping[str, object], unique: bool = False
) -> DataFrame:
    """Add the missing combinations of declared axes; rows outside the axes stay. Nulls are filled.

    ``unique`` says that ``df`` has at most one row per combination, as counts do: the grid is then stacked
    under it and both are folded once, and the input is computed once.
    """
    names = list(axes)
    first, *others = names
    spark = df.sparkSession
    types = dict(df.dtypes)
    base = spark.range(1).select(
        F.explode(F.array(*[F.lit(v).cast(types[first]) for v in axes[first]])).alias(first)
    )
    grid = expand_grid(base, {n: axes[n] for n in others}) if others else base
    grid = grid.select(*[col(n).cast(types[n]).alias(n) for n in names])
    if unique:
        rest = [c for c in df.columns if c not in names]
        stacked = df.withColumn("__own", F.struct(*cols(rest))).select(*cols(names), "__own").unionByName(
            grid, allowMissingColumns=True
        )
        folded = stacked.groupBy(*cols(names)).agg(F.any_value("__own", ignoreNulls=True).alias("__own"))
        out = folded.select(*[F.col("__own").getField(c).alias(c) if c in rest else col(c) for c in df.columns])
    else:
        missing = drop_ids(grid, df.select(*cols(names)).distinct(), names)
        out = df.unionByName(missing, allowMissingColumns=True)
    return out.withColumns({c: F.coalesce(col(c), F.lit(v).cast(types[c])) for c, v in fill.items()})


def contingency(df: DataFrame, axes: Sequence[str], alias: str = "count") -> DataFrame:
    """Counts over the full product of the observed values, 0 where nothing was seen.

    Rows with a null axis are not counted. Axes are taken from the folded counts, which are
    written once, not from the rows.
    """
    counts = stage(df.na.drop("any", subset=list(axes)).groupBy(*cols(axes)).agg(F.count(F.lit(1)).alias(alias)))
    grid = counts.select(col(axes[0])).distinct()
    for name in axes[1:]:
        grid = expand_observed(grid, counts, name)
    return lookup_left(grid, counts, axes, unique=False).withColumn(
        alias, F.coalesce(col(alias), F.lit(0))
    )
