"""Aggregations: sums, counts of distinct entities, totals rows, pivots to totals, attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.aggregates import mean_of, total_of
from tallyloom.functions.names import col, cols
from tallyloom.functions.values import filled
from tallyloom.operators.joins import lookup_left, null_safe_join
from tallyloom.operators.resolve import top_n_per_group
from tallyloom.sources.staging import stage


def count_by(df: DataFrame, by: Sequence[str], alias: str = "n") -> DataFrame:
    return df.groupBy(*cols(by)).agg(F.count(F.lit(1)).alias(alias))


def sum_by(
    df: DataFrame, by: Sequence[str], amount: str, alias: str | None = None, nulls: str = "zero"
) -> DataFrame:
    return df.groupBy(*cols(by)).agg(total_of(amount, nulls).alias(alias or amount))


def stats_by(
    df: DataFrame, by: Sequence[str], value: str, stats: Mapping[str, str]
) -> DataFrame:
    """Per-group ``mean``, ``min``, ``max``, ``sum`` or ``count`` under the given names."""
    makers = {"mean": mean_of, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    return df.groupBy(*cols(by)).agg(*[makers[s](col(value)).alias(a) for a, s in stats.items()])


def agg_of_agg(
    df: DataFrame,
    entity: Sequence[str],
    by: Sequence[str],
    value: str,
    stats: Mapping[str, str],
    first: str = "sum",
) -> DataFrame:
    """Aggregate per entity (``sum`` or ``count``), then over the entities of a group."""
    keys = list(dict.fromkeys([*by, *entity]))
    inner = F.count(col(value)) if first == "count" else total_of(value)
    return stats_by(df.groupBy(*cols(keys)).agg(inner.alias("__inner")), by, "__inner", stats)


def count_distinct_entities(
    df: DataFrame, entity: Sequence[str], by: Sequence[str], alias: str = "n"
) -> DataFrame:
    """Entities per group; an entity with null parts counts like any other."""
    keys = list(dict.fromkeys([*by, *entity]))
    return count_by(df.select(*cols(keys)).distinct(), by, alias)


def share_by(
    df: DataFrame,
    flag: Column,
    by: Sequence[str],
    number: str = "number",
    hits: str = "hits",
    share: str = "percent",
) -> DataFrame:
    """Share of rows for which ``flag`` holds."""
    n, k = F.count(F.lit(1)), F.sum(F.when(flag, 1).otherwise(0))
    return df.groupBy(*cols(by)).agg(n.alias(number), k.alias(hits), (k / n).alias(share))


def paired_totals(df: DataFrame, names: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    """Row totals over ``<prefix> <name>`` columns: one per name, one per prefix; zero is null."""
    def total(parts: Sequence[str]) -> Column:
        added = reduce(lambda a, b: a + b, [F.coalesce(col(p), F.lit(0)) for p in parts])
        return F.when(added != 0, added)

    made = {f"{p} Total": total([f"{p} {n}" for n in names]) for p in prefixes}
    made.update({n: total([f"{p} {n}" for p in prefixes]) for n in names})
    return df.withColumns(made)


def category_totals(
    rows: DataFrame,
    facts: DataFrame,
    by: Sequence[str],
    category: str,
    amount: str,
    names: Mapping[str, str],
) -> DataFrame:
    """Sum facts per group and category, one column each (absent is 0), joined back to ``rows``.

    Groups without any fact keep null totals. Facts with a null group key are left out.
    """
    usable = facts.na.drop("any", subset=list(by))
    sums = usable.groupBy(*cols(by)).agg(
        *[F.coalesce(F.sum(F.when(col(category) == v, col(amount))), F.lit(0)).alias(n)
          for v, n in names.items()]
    )
    return lookup_left(rows, sums, by, unique=False)


def completeness(
    df: DataFrame,
    metrics: Sequence[str],
    keys: Sequence[str],
    flag: str = "completeness",
    empty: str = "Empty",
    complete: str = "Complete",
) -> DataFrame:
    """``empty`` when every metric of every row of the key is null or ``0``, else ``complete``."""
    any_filled = F.greatest(*[filled(col(m)) for m in metrics]) if len(metrics) > 1 else filled(col(metrics[0]))
    flags = df.groupBy(*cols(keys)).agg(
        F.when(F.max(any_filled) == 0, F.lit(empty)).otherwise(F.lit(complete)).alias(flag)
    )
    return null_safe_join(df, flags, keys, "left")


def with_totals(
    df: DataFrame,
    block: Sequence[str],
    label: str,
    values: Sequence[str],
    name: str | Column = "Total",
) -> DataFrame:
    """Append one total row per block. ``name`` may be an expression over the block columns.

    One grouping-sets aggregation over the (already small) table; rows are unique per label.
    """
    sums = [F.sum(col(v)).alias(v) for v in values]
    total = F.lit(name) if isinstance(name, str) else name
    detail = [*cols(block), col(label)]
    out = df.groupingSets([detail, [*cols(block)]], *detail).agg(
        *sums, F.grouping(col(label)).alias("__total")
    )
    return out.select(
        *cols(block),
        F.when(F.col("__total") == 1, total).otherwise(col(label)).alias(label),
        *cols(values),
        (F.col("__total") == 1).alias("is_total"),
    )


def counts_with_distinct_total(
    df: DataFrame,
    entity: Sequence[str],
    block: Sequence[str],
    label: str,
    category: str,
    names: Mapping[str, str],
    total: str,
    total_name: str | Column = "Total",
) -> DataFrame:
    """Entities per label and category, the distinct entities per label, and total rows per block.

    An entity counts once per category it occurs in and once in ``total``, which is therefore
    not the sum of its row. Category flags are folded per entity first, so categories and
    distinct total come from the same shuffle.
    """
    keys = list(dict.fromkeys([*block, label, *entity]))
    flags = [F.max(F.when(col(category) == v, 1).otherwise(0)).alias(n) for v, n in names.items()]
    per_entity = df.groupBy(*cols(keys)).agg(*flags).withColumn(total, F.lit(1))
    counts = per_entity.groupBy(*cols([*block, label])).agg(
        *[F.sum(col(n)).alias(n) for n in [*names.values(), total]]
    )
    return with_totals(counts, block, label, [*names.values(), total], total_name)


def with_distinct_total(
    counts: DataFrame,
    df: DataFrame,
    entity: Sequence[str],
    by: Sequence[str],
    alias: str = "distinct_total",
) -> DataFrame:
    """Add the distinct entities per group as a column of a finished count table."""
    return lookup_left(counts, count_distinct_entities(df, entity, by, alias), by, unique=False)


def latest_attribute(
    df: DataFrame,
    key: str,
    period: str,
    value: str,
    order_by: Sequence[str] = (),
    floor: int | None = None,
) -> DataFrame:
    """Value of the newest period per key (first row of it); null when that is before ``floor``."""
    newest = top_n_per_group(
        df.select(*cols(dict.fromkeys([key, period, value, *order_by]))).where(col(period).isNotNull()),
        [key],
        [col(period).desc(), *order_by],
        1,
    )
    chosen = col(value) if floor is None else F.when(col(period) >= floor, col(value))
    return newest.select(col(key), chosen.alias(value))


def canonical_attribute(
    source: DataFrame, key: str, value: str, order_by: Sequence[str]
) -> DataFrame:
    """First non-null value per key in source order; null keys have none."""
    order = F.struct(*cols(order_by))
    usable = source.where(col(key).isNotNull())
    return usable.groupBy(col(key)).agg(
        F.min_by(F.when(col(value).isNotNull(), col(value)), F.when(col(value).isNotNull(), order)).alias(value)
    )


def canonicalise(
    tables: Mapping[str, DataFrame], key: str, value: str, source: str, order_by: Sequence[str]
) -> dict[str, DataFrame]:
    """Write the canonical value back to every table that has both columns."""
    names = canonical_attribute(tables[source], key, value, order_by)
    out = {}
    for name, df in tables.items():
        if value in df.columns and key in df.columns:
            df = null_safe_join(df.drop(value), names, [key], "left")
        out[name] = df
    return out


def concat_distinct(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    sep: str = ", ",
    order_by: Sequence[str] = (),
    alias: str | None = None,
    null_text: str | None = None,
) -> DataFrame:
    """Distinct values per group as one text, in order of first appearance (else by value).

    Repeats are folded before anything is gathered, so a list holds each value once.
    ``null_text`` renders null as a value of its own; by default null is left out.
    """
    values = df.where(col(column).isNotNull()) if null_text is None else df.withColumn(
        column, F.coalesce(col(column).cast("string"), F.lit(null_text)))
    first = F.min(F.struct(*cols(order_by))) if order_by else F.lit(0)
    folded = values.groupBy(*cols(by), col(column)).agg(first.alias("__at"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("__at"), col(column).alias("__v"))))
    return folded.groupBy(*cols(by)).agg(
        F.array_join(F.transform(ordered, lambda s: s["__v"]), sep).alias(alias or column)
    )


def set_count(df: DataFrame, columns: Sequence[str], alias: str = "sum") -> DataFrame:
    """The distinct values of a projection with their number on every row.

    The distinct values are written once, and their number is read off what was written.
    """
    members = stage(df.select(*cols(columns)).distinct())
    return members.withColumn(alias, F.lit(members.count()).cast("long"))
