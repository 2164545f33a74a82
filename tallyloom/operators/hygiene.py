"""Cleaning of raw tables: sentinels, whitespace, statuses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, names_like, quote
from tallyloom.functions.values import WHITESPACE, not_in, null_if_in, recode


def clean_strings(
    df: DataFrame,
    sentinels: Sequence[str] = ("nan", ""),
    columns: Sequence[str] | None = None,
    trim: bool = True,
    trim_first: bool = False,
) -> DataFrame:
    """Sentinels to null, then trim, over all string columns in one projection.

    The order matters: a sentinel inside blanks survives as text unless ``trim_first``.
    """
    chosen = set(columns if columns is not None else [n for n, t in df.dtypes if t == "string"])

    blank = "'" + "".join(f"\\u{ord(w):04x}" for w in WHITESPACE) + "'"
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in sentinels)

    def cleaned(name: str) -> str:
        # Written as SQL text: wide forms have hundreds of columns, and texts plan faster.
        c = quote(name)
        c = f"btrim({c}, {blank})" if trim_first else c
        c = f"CASE WHEN NOT coalesce({c} IN ({listed}), false) THEN {c} END" if sentinels else c
        c = f"btrim({c}, {blank})" if trim and not trim_first else c
        return f"{c} AS {quote(name)}"

    return df.selectExpr(*[cleaned(n) if n in chosen else quote(n) for n in df.columns])


def null_values_like(
    df: DataFrame, any_of: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Null out values, in any case, in the columns whose name holds a fragment."""
    chosen = set(names_like(df.columns, any_of))
    return df.select(
        *[null_if_in(col(n), values, ignore_case=True).alias(n) if n in chosen else col(n) for n in df.columns]
    )


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows with one of the values; rows with null stay."""
    return df.where(not_in(col(column), values))


def drop_nulls(df: DataFrame, subset: Sequence[str], how: str = "any") -> DataFrame:
    """Drop rows with any (or all) of the columns null."""
    return df.na.drop(how, subset=list(subset))


def nonzero(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is neither null nor zero."""
    return df.where(col(column).isNotNull() & (col(column) != F.lit(0)))


def recode_columns(df: DataFrame, mappings: Mapping[str, Mapping]) -> DataFrame:
    return df.withColumns({c: recode(col(c), m) for c, m in mappings.items() if c in df.columns})
