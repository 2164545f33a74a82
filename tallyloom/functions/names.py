"""Helpers for column names, including names holding dots, commas and brackets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Back-quote a name so that Spark reads it as one identifier."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a column by its exact name."""
    return F.col(quote(name))


def cols(names: Iterable[str]) -> list[str]:
    """Quoted names, for the calls that take names: cheaper to plan than column objects."""
    return [quote(n) for n in names]


def renamed(names: Mapping[str, str]) -> list[str]:
    """``selectExpr`` texts that give every column its (possibly same) new name."""
    return [f"{quote(c)} AS {quote(n)}" for c, n in names.items()]


def names_like(
    columns: Sequence[str], any_of: Sequence[str] = (), none_of: Sequence[str] = ()
) -> list[str]:
    """Names holding at least one of ``any_of`` (when given) and none of ``none_of``."""
    return [
        c
        for c in columns
        if (not any_of or any(s in c for s in any_of)) and not any(s in c for s in none_of)
    ]


def folded_clashes(columns: Sequence[str]) -> list[str]:
    """Names that differ only by case, which Spark and Parquet cannot tell apart."""
    seen: dict[str, str] = {}
    clashes = []
    for c in columns:
        if c.lower() in seen:
            clashes.append(c)
        seen.setdefault(c.lower(), c)
    return clashes


def prefix_keys(df: DataFrame, n: int, exclude: Sequence[str] = (), start: int = 0) -> list[str]:
    """Key columns by position: ``columns[start:n]`` without ``exclude``."""
    return [c for c in df.columns[start:n] if c not in exclude]


def shared_keys(a: DataFrame, b: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns both frames have, in the order of ``a``, without ``exclude``."""
    other = set(b.columns)
    return [c for c in a.columns if c in other and c not in exclude]


def present(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """The names that are among the columns, in their own order."""
    return [n for n in names if n in columns]
