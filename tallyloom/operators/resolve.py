"""Which row of a group counts: latest revision, first or last row, top n.

Nothing here sends a whole group to one task. Top-n queries are written as ``row_number``
with a bound, which Spark cuts inside each map task before the shuffle
(``WindowGroupLimit``); ties are found by a semi-join on the winning values, whose skewed
partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.aggregates import total_of
from tallyloom.functions.names import col, cols
from tallyloom.operators.joins import null_safe_join

Order = Sequence[str | Column]


def _order(order_by: Order) -> list[Column]:
    return [col(o).asc_nulls_last() if isinstance(o, str) else o for o in order_by]


def _drop_null_keys(df: DataFrame, by: Sequence[str], null_keys: str) -> DataFrame:
    if null_keys not in ("keep", "drop"):
        raise ValueError("null_keys is 'keep' or 'drop'")
    return df.na.drop("any", subset=[c for c in by]) if null_keys == "drop" else df


def top_n_per_group(df: DataFrame, by: Sequence[str], order_by: Order, n: int = 1) -> DataFrame:
    """The first ``n`` rows of every group in the given order (make it total)."""
    w = Window.partitionBy(*cols(by)).orderBy(*_order(order_by))
    ranked = df.select("*", F.row_number().over(w).alias("__rank"))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Order) -> DataFrame:
    """One full row per key: the first in the given order."""
    return top_n_per_group(df, keys, order_by, 1)


def distinct_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One full row per key: the last in ascending order of ``order_by``."""
    return top_n_per_group(df, keys, [col(o).desc_nulls_last() for o in order_by], 1)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of a projection."""
    return (df.select(*cols(columns)) if columns else df).distinct()


def keep_max(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    ties: str = "keep",
    order_by: Order = (),
    null_keys: str = "drop",
) -> DataFrame:
    """Rows holding the largest ``column`` of their group; a null value never wins.

    ``ties='first'`` keeps one row, by ``order_by``. ``null_keys`` says whether rows with a
    null in ``by`` form groups or are left out.
    """
    present = _drop_null_keys(df, by, null_keys).where(col(column).isNotNull())
    if ties == "first":
        return top_n_per_group(present, by, [col(column).desc(), *_order(order_by)], 1)
    best = present.groupBy(*cols(by)).agg(F.max(col(column)).alias("__best"))
    return null_safe_join(present, best, [*by, (column, "__best")], "left_semi")


def resolve_hierarchy(
    df: DataFrame,
    by: Sequence[str],
    levels: Sequence[tuple[str, str]],
    ties: str = "keep",
    order_by: Order = (),
    null_keys: str = "keep",
) -> DataFrame:
    """Best row per group by several levels in turn, each ``max`` or ``min``.

    A level whose column the frame lacks is skipped. Nulls come last at every level. Rows
    that tie on all levels are kept, or cut to one with ``ties='first'``.
    """
    present = [(c, d) for c, d in levels if c in df.columns]
    base = _drop_null_keys(df, by, null_keys)
    if not present:
        return base
    order = [col(c).desc_nulls_last() if d == "max" else col(c).asc_nulls_last() for c, d in present]
    if ties == "first":
        return top_n_per_group(base, by, [*order, *_order(order_by)], 1)
    keys = [*by, *[c for c, _ in present]]
    best = top_n_per_group(base.select(*cols(keys)), by, order, 1)
    return null_safe_join(base, best, keys, "left_semi")


def resolve_subset(
    df: DataFrame,
    chosen: Column,
    by: Sequence[str],
    column: str,
    passthrough: Column,
    ties: str = "keep",
    order_by: Order = (),
    null_keys: str = "drop",
) -> DataFrame:
    """Resolve the ``chosen`` rows to their group maximum, let ``passthrough`` rows by, drop the rest.

    ``chosen`` and ``passthrough`` exclude each other. Kept ties need no union: the winners
    are marked by a left join, so the frame is read once for both parts.
    """
    if ties == "first":
        resolved = keep_max(df.where(chosen), by, column, ties, order_by, null_keys)
        return resolved.unionByName(df.where(passthrough))
    candidates = _drop_null_keys(df.where(chosen), by, null_keys).where(col(column).isNotNull())
    best = candidates.groupBy(*cols(by)).agg(F.max(col(column)).alias("__best"), F.lit(True).alias("__won"))
    marked = null_safe_join(df.where(chosen | passthrough), best, [*by, (column, "__best")], "left")
    return marked.where(passthrough | F.col("__won")).drop("__won")


def total_and_distinct(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    order_by: Sequence[str] = (),
    total: str = "funding",
    keep: Sequence[str] | None = None,
    nulls: str = "zero",
) -> DataFrame:
    """One row per key with the group total and the other columns of its first row.

    Both come from one aggregation with a map-side combine. ``keep`` limits the other columns
    (``()`` for none), so that the scan reads no more than needed.
    """
    rest = [c for c in (df.columns if keep is None else keep) if c not in keys and c != total]
    aggs = [total_of(amount, nulls).alias(total)]
    if rest:
        # Null first-row values must survive, so the ordering struct puts nulls last itself.
        order = F.struct(
            *[x for i, o in enumerate(order_by)
              for x in (col(o).isNull().alias(f"n{i}"), col(o).alias(f"v{i}"))]
        )
        aggs.append(F.min_by(F.struct(*cols(rest)), order).alias("__row"))
    out = df.groupBy(*cols(keys)).agg(*aggs)
    return out.select(*cols(keys), *[F.col("__row").getField(c).alias(c) for c in rest], col(total))
