"""HTML entity unescaping: the only step without a built-in Spark expression."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyloom.functions.names import col


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def html_unescape(c: Column) -> Column:
    """Decode entities. Only texts holding an ampersand cross to Python; the rest travel as null."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def unescape_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Unescape the given (default: all) string columns in one Arrow exchange."""
    chosen = set(columns if columns is not None else [n for n, t in df.dtypes if t == "string"])
    return df.select(*[html_unescape(col(n)).alias(n) if n in chosen else col(n) for n in df.columns])
