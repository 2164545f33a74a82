"""Merging a new extract into the history it supersedes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col
from tallyloom.operators.joins import drop_ids
from tallyloom.operators.resolve import top_n_per_group


def merge_history(
    history: DataFrame | None,
    new: DataFrame,
    period: str,
    periods: DataFrame | Sequence,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    normalise: dict[str, Column] | None = None,
) -> DataFrame:
    """Replace whole periods: history without them, plus the new rows, last row per key.

    ``periods`` are those of the raw extract, as a list (Spark then prunes the partitions of a
    history stored by period) or as a frame. New rows come after history, then ``order_by``.
    ``normalise`` rewrites columns before rows are compared. No history is a first run.
    """
    fresh = new.withColumn("__part", F.lit(1))
    if history is None:
        merged = fresh
    else:
        if isinstance(periods, DataFrame):
            kept = drop_ids(history, periods.select(col(period)).distinct(), [period])
        else:
            kept = history.where(~F.coalesce(col(period).isin(list(periods)), F.lit(False)))
        merged = kept.withColumn("__part", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    if normalise:
        merged = merged.withColumns(normalise)
    order = [F.col("__part").desc(), *[col(o).desc_nulls_last() for o in order_by]]
    return top_n_per_group(merged, key, order, 1).drop("__part")
