"""Scalar column expressions: cleaning, recoding, parsing and presentation.

All of them are built-in Spark expressions, so they stay inside whole-stage code
generation. The one exception, HTML unescaping, lives in ``functions.html``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of leading and trailing whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_in(c: Column, sentinels: Sequence[str], ignore_case: bool = False) -> Column:
    """Replace sentinel texts by null."""
    probe = F.lower(c.cast("string")) if ignore_case else c
    values = [s.lower() for s in sentinels] if ignore_case else list(sentinels)
    return F.when(~F.coalesce(probe.isin(values), F.lit(False)), c)


def normalise_id(c: Column) -> Column:
    """``[1 236003113 A1]`` -> ``1236003113A1``: drop the brackets and the two blanks."""
    n = F.length(c)
    tail_from = F.greatest(n - 3, F.lit(0))
    return F.concat(
        F.substring(c, 2, 1),
        F.substring(c, F.lit(4), F.greatest(n - 7, F.lit(0))),
        F.substring(c, tail_from + 1, F.greatest(n - 1 - tail_from, F.lit(0))),
    )


def unify_alias(c: Column, aliases: Sequence[str], canonical: str) -> Column:
    """Upper-case, then map every alias to one spelling."""
    upper = F.upper(c)
    return F.when(upper.isin(list(aliases)), F.lit(canonical)).otherwise(upper)


def recode(c: Column, mapping: Mapping, default: str = "keep") -> Column:
    """Recode values; ``default`` is ``keep`` (pass through) or ``null``."""
    if not mapping:
        return c if default == "keep" else F.lit(None).cast("string")
    items = list(mapping.items())
    out = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    for key, value in items[1:]:
        out = out.when(c == F.lit(key), F.lit(value))
    return out.otherwise(c) if default == "keep" else out


def overwrite_when(c: Column, rules: Sequence[tuple[Column, object]]) -> Column:
    """First rule whose condition holds gives the value; otherwise the column stays."""
    if not rules:
        return c
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, value in rules[1:]:
        out = out.when(cond, F.lit(value))
    return out.otherwise(c)


def hit_label(hit: Column, label: str, otherwise: Column) -> Column:
    """Label a row by whether a lookup matched (its value is not null)."""
    return F.when(hit.isNotNull(), F.lit(label)).otherwise(otherwise)


def join_labels(
    first: Column, second: Column, sep: str = " and ", empty: str = "None", compat: bool = False
) -> Column:
    """Join two optional labels. ``compat`` keeps the leading separator of a lone second one."""
    a, b = F.coalesce(first, F.lit("")), F.coalesce(second, F.lit(""))
    both = F.concat(a, F.lit(sep), b)
    lone_second = both if compat else b
    return (
        F.when((a == "") & (b == ""), F.lit(empty))
        .when(b == "", a)
        .when(a == "", lone_second)
        .otherwise(both)
    )


def filled(c: Column) -> Column:
    """1 unless the value is null or the text ``0``."""
    text = c.cast("string")
    return F.when(text.isNull() | (text == "0"), F.lit(0)).otherwise(F.lit(1))


def binary_category(c: Column, match: str, yes: str, no: str) -> Column:
    """``yes`` when the text equals ``match`` in any case, else ``no`` (null too)."""
    return F.when(F.upper(c) == match.upper(), F.lit(yes)).otherwise(F.lit(no))


def classify_contains(
    c: Column, rules: Sequence[tuple[str, str]], default: str | None = None
) -> Column:
    """Label of the first fragment the text holds."""
    out = F.when(F.contains(c, F.lit(rules[0][0])), F.lit(rules[0][1]))
    for fragment, label in rules[1:]:
        out = out.when(F.contains(c, F.lit(fragment)), F.lit(label))
    return out.otherwise(F.lit(default)) if default is not None else out


def classify_text(text: str | None, rules: Sequence[tuple[str, str]], default: str) -> str:
    """The same rule for a column label known while the plan is built."""
    return next((label for fragment, label in rules if fragment in (text or "")), default)


def parse_amount(c: Column, dash_is_zero: bool = True) -> Column:
    """First number in a money text (``$1,234.50`` -> 1234.50); a lone dash is zero."""
    digits = F.regexp_extract(c, r"(-?[0-9][0-9,]*\.?[0-9]*|-?\.[0-9]+)", 1)
    number = F.replace(digits, F.lit(","), F.lit("")).try_cast("decimal(18,2)")
    return F.when(c == "-", F.lit(0).cast("decimal(18,2)")).otherwise(number) if dash_is_zero else number


def to_number(c: Column, dtype: str = "double") -> Column:
    """Number, or null where the text is not one."""
    return c.try_cast(dtype)


def parse_date(c: Column, fmt: str = "MM/dd/yyyy") -> Column:
    """Date from text, null where it does not parse."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def without_text(c: Column, fragment: str) -> Column:
    """Remove a literal fragment wherever it occurs."""
    return F.replace(c, F.lit(fragment), F.lit(""))


def period_label(c: Column, periods: Sequence[int] | None = None, prefix: str = "FY") -> Column:
    """2023 -> ``FY23``; years outside ``periods`` (when given) stay plain text."""
    text = c.cast("string")
    label = F.concat(F.lit(prefix), F.right(text, F.lit(2)))
    if periods is None:
        return label
    return F.when(c.isin([int(p) for p in periods]), label).otherwise(text)


def period_name(period: int, prefix: str = "FY") -> str:
    return f"{prefix}{str(period)[-2:]}"


def money_text(c: Column, digits: int = 0) -> Column:
    """``$1,234``; presentation only, keep the number beside it."""
    sign = F.when(c < 0, F.lit("-$")).otherwise(F.lit("$"))
    return F.concat(sign, F.format_number(F.abs(c), digits))


def count_text(c: Column) -> Column:
    return F.format_number(c, 0)


def range_text(low: Column, high: Column, digits: int = 0, sep: str = " - ") -> Column:
    return F.concat(money_text(low, digits), F.lit(sep), money_text(high, digits))


def tri_state(count: Column, submitted: Column, absent: str = "Did Not Submit") -> Column:
    """The count; ``0`` when submitted without one; ``absent`` when neither is known."""
    return (
        F.when(count.isNull() & submitted.isNull(), F.lit(absent))
        .when(count.isNull(), F.lit("0"))
        .otherwise(count.cast("string"))
    )


def count_equal(columns: Sequence[Column], value: object) -> Column:
    """How many of the columns hold ``value``."""
    return reduce(
        lambda a, b: a + b, [F.coalesce((c == F.lit(value)).cast("int"), F.lit(0)) for c in columns]
    )


def more_than(columns: Sequence[Column], value: object, k: int = 1) -> Column:
    """``Yes`` when more than ``k`` of the columns hold ``value``."""
    return F.when(count_equal(columns, value) > k, F.lit("Yes")).otherwise(F.lit("No"))


def status_label(c: Column, missing: str, merge: Mapping[str, str] | None = None) -> Column:
    """Name the missing status and merge statuses that count as one."""
    return recode(F.coalesce(c, F.lit(missing)), merge or {})


def threshold_label(c: Column, label: str, otherwise: str = "", above: float = 0) -> Column:
    return F.when(c > F.lit(above), F.lit(label)).otherwise(F.lit(otherwise))


def not_in(c: Column, values: Sequence) -> Column:
    """Row filter that excludes values but keeps nulls."""
    return ~F.coalesce(c.isin(list(values)), F.lit(False))


def check(ok: Column, message: str) -> Column:
    """Row filter that fails the job where ``ok`` is not true."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
