"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` cuts at exactly the characters of ``SPACES``."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4 (null id: as an empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2
