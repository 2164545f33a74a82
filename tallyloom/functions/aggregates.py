"""Aggregate expressions with an explicit treatment of nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.names import col


def total_of(amount: str, nulls: str = "zero") -> Column:
    """Sum expression: ``zero`` skips nulls and gives 0 for none; ``propagate`` lets a null win."""
    if nulls == "zero":
        return F.coalesce(F.sum(col(amount)), F.lit(0))
    if nulls == "propagate":
        return F.when(F.count(col(amount)) == F.count(F.lit(1)), F.sum(col(amount)))
    raise ValueError("nulls is 'zero' or 'propagate'")


def mean_of(c: Column) -> Column:
    """Mean as total over count, so that decimals keep their digits until the last step."""
    return F.sum(c).cast("double") / F.count(c)
