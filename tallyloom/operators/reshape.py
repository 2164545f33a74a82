"""Wide to long, long to wide, and the crosswalk that names both.

Reshapes that only rearrange one row are written as an exploded array of structs: a narrow
step without a shuffle. Column lists are pruned from the crosswalk when the plan is built,
so that unmatched columns are never read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, cols, quote, renamed
from tallyloom.functions.values import check, classify_text, strip, without_text
from tallyloom.operators.joins import lookup_left, null_safe_join
from tallyloom.operators.resolve import distinct_on


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """Wide to long; all values become text first, as mixed types cannot share a column."""
    chosen = [c for c in df.columns if c not in ids] if values is None else list(values)
    text = df.selectExpr(*cols(ids), *[f"CAST({quote(c)} AS STRING) AS {quote(c)}" for c in chosen])
    return text.unpivot(cols(ids), cols(chosen), variable, value)


def _about(xw: DataFrame, name: str, columns: Sequence[str], fold: bool) -> DataFrame:
    """Crosswalk rows about the given columns, with the ``__name`` they are known by."""
    key = F.upper(col(name)) if fold else col(name)
    return xw.withColumn("__name", key).where(F.col("__name").isin([c.upper() for c in columns] if fold else list(columns)))


def matching_values(xw: DataFrame, name: str, columns: Sequence[str], value: str, fold: bool = False) -> list:
    """The distinct values the crosswalk has for the given columns, sorted; they name columns of the output."""
    rows = _about(xw, name, columns, fold).where(col(value).isNotNull()).select(col(value).alias("v")).distinct().collect()
    return sorted(r.v for r in rows)


def matching_labels(
    xw: DataFrame, name: str, columns: Sequence[str], label: str, fold: bool = False, order_by: Sequence[str] = ()
) -> dict[str, str]:
    """One label per known column, so as many as the table is wide: the last in ``order_by``.

    Without an order, entries that give one column different labels are an error.
    """
    found = _about(xw, name, columns, fold).where(col(label).isNotNull()).groupBy("__name")
    if order_by:
        rows = found.agg(F.max_by(col(label), F.struct(*cols(order_by))).alias("last"), F.lit(1).alias("n")).collect()
    else:
        rows = found.agg(F.max(col(label)).alias("last"), F.count_distinct(col(label)).alias("n")).collect()
    doubled = sorted(r["__name"] for r in rows if r.n > 1)
    if doubled:
        raise ValueError(f"different labels for {doubled}; give the crosswalk an order")
    return {r["__name"]: r["last"] for r in rows}


def rename_by_crosswalk(
    df: DataFrame, xw: DataFrame, raw: str = "Meta Name Description", label: str = "Label", order_by: Sequence[str] = ()
) -> DataFrame:
    """Rename the columns the crosswalk knows; leave the others. Doubled names take the last in ``order_by``."""
    return rename_columns(df, matching_labels(xw, raw, df.columns, label, order_by=order_by))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Simultaneous renames: ``{a: b, b: c}`` moves both, unlike renames one after another."""
    return df.selectExpr(*renamed({c: mapping.get(c, c) for c in df.columns}))


def rename_by_substring(df: DataFrame, replacements: Mapping[str, Sequence[str]] | None) -> DataFrame:
    """Rename columns that hold a fragment but are not exactly it, in column order.

    More columns than new names: the later ones keep theirs. None is a no-op.
    """
    names = list(df.columns)
    for fragment, new in (replacements or {}).items():
        hits = [i for i, c in enumerate(names) if fragment in c and c != fragment]
        for i, n in zip(hits, new):
            names[i] = n
    return df.toDF(*names)


def crosswalk_long(
    df: DataFrame,
    ids: Sequence[str],
    xw: DataFrame,
    name: str = "Meta Name Description",
    element: str = "Element",
    attributes: Sequence[str] = (),
    extra: Sequence[str] = (),
    value: str = "value",
    position: str | None = None,
) -> DataFrame:
    """Long table of the columns the crosswalk knows, with their element and attributes.

    ``extra`` columns are not in the crosswalk and are their own element. Names match in any
    case. Rows without an element are dropped; a name listed twice gives a row per entry.
    ``position`` names a column for the place of the value's column in ``df``.
    """
    candidates = [c for c in df.columns if c not in ids]
    known = {n.upper() for n in matching_values(xw, name, candidates, name, fold=True)}
    own = {e.upper() for e in extra}
    chosen = [c for c in candidates if c.upper() in known or c.upper() in own]
    long = to_long(df, ids, chosen, "variable", value)
    placed = []
    if position:
        at = F.array_position(F.array(*[F.lit(c) for c in chosen]), F.col("variable"))
        long, placed = long.withColumn(position, at.cast("int")), [position]
    long = long.withColumn("variable", F.upper("variable"))
    wanted = sorted({c.upper() for c in chosen})
    dim = xw.select(
        F.upper(col(name)).alias("__name"), *[col(a) for a in [element, *attributes]]
    ).where(F.col("__name").isin(wanted))
    joined = lookup_left(long, dim, [("variable", "__name")], unique=False)
    named = F.when(F.col("variable").isin(sorted(own)), F.col("variable")).otherwise(col(element)) if own else col(element)
    return (
        joined.withColumn(element, named)
        .where(col(element).isNotNull())
        .select(*cols(ids), *cols(attributes), col(element), col(value), *cols(placed))
    )


def unpivot_families(
    df: DataFrame,
    ids: Sequence[str],
    families: Mapping[str, Mapping[str, str]],
    category: str,
) -> DataFrame:
    """Metric families to a category x measure table.

    ``families`` gives, per measure, the column of each category. Categories that some family
    lacks are left out (the measures are inner-joined). Narrow: no shuffle.
    """
    kinds = [k for k in next(iter(families.values())) if all(k in f for f in families.values())]
    rows = [
        F.struct(
            F.lit(kind).alias(category),
            *[col(f[kind]).cast("string").alias(measure) for measure, f in families.items()],
        )
        for kind in kinds
    ]
    exploded = df.select(*cols(ids), F.explode(F.array(*rows)).alias("__row"))
    return exploded.select(
        *cols(ids), *[F.col("__row").getField(f).alias(f) for f in [category, *families]]
    )


def survey_families(
    columns: Sequence[str],
    labels: Mapping[str, str | None],
    families: Mapping[str, tuple[str, Sequence[str], bool]],
    classify: Sequence[tuple[str, str]],
    default: str,
) -> dict[str, dict[str, str]]:
    """Sort columns into families by fragments of their names and into categories by their label.

    ``families`` maps a measure to (fragment, marker fragments, whether a marker must occur).
    """
    out: dict[str, dict[str, str]] = {}
    for measure, (fragment, markers, marked) in families.items():
        found: dict[str, str] = {}
        for c in columns:
            upper = c.upper()
            if fragment in upper and any(m in upper for m in markers) == marked:
                kind = classify_text(labels.get(upper), classify, default)
                if kind in found:
                    raise ValueError(f"{measure}: two columns for {kind}: {found[kind]!r} and {c!r}")
                found[kind] = c
        out[measure] = found
    return out


def prefix_families_long(
    df: DataFrame,
    ids: Sequence[str],
    families: Mapping[str, str],
    area: str = "Priority Area",
    explode: str | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``<prefix><area>`` columns to one row per area with a column per family.

    An area that only some families have gets nulls for the others. ``explode`` names a family
    of ``|``-separated texts to split into rows. With ``order_by`` the first row per ids is
    taken; without it ids are taken to be unique.
    """
    found: dict[str, dict[str, str]] = {}
    areas: list[str] = []
    for family, prefix in families.items():
        for c in df.columns:
            if prefix in c:
                a = c.replace(prefix, "")
                found.setdefault(family, {}).setdefault(a, c)
                if a not in areas:
                    areas.append(a)
    base = distinct_on(df, ids, order_by) if order_by is not None else df
    rows = [
        F.struct(
            F.lit(a).alias(area),
            *[
                (col(found[f][a]).cast("string") if a in found.get(f, {}) else F.lit(None).cast("string")).alias(f)
                for f in families
            ],
        )
        for a in areas
    ]
    long = base.select(*cols(ids), F.explode(F.array(*rows)).alias("__row")).select(
        *cols(ids), *[F.col("__row").getField(n).alias(n) for n in [area, *families]]
    )
    return explode_delimited(long, explode) if explode else long


def questions_long(
    df: DataFrame,
    ids: Sequence[str],
    questions: Sequence[str],
    question: str = "Narrative Question",
    response: str = "Response",
    dedup: str = "response",
    order_by: Sequence[str] = (),
    unique_ids: bool = False,
) -> DataFrame:
    """Question columns to (question, response) rows.

    ``dedup='response'`` keeps, per ids, the first question of equal responses (nulls are
    equal); ``'question'`` keeps one row per question; ``'none'`` keeps all. Where ids are
    known to be unique per row, ``unique_ids`` settles repeats inside the row: no text is
    shuffled.
    """
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("__at"), F.lit(q).alias(question), col(q).cast("string").alias(response))
            for i, q in enumerate(questions)
        ]
    )
    if unique_ids:
        if dedup == "response":
            # Structs, unlike plain values, compare as equal when both hold null.
            answers = F.transform(rows, lambda r: F.struct(r[response]))
            rows = F.filter(
                rows, lambda r: F.array_position(answers, F.struct(r[response])) == r["__at"] + 1
            )
        return df.select(*cols(ids), F.inline(rows)).select(*cols(ids), col(question), col(response))
    order = [c for c in order_by if c not in ids]
    long = df.select(*cols(ids), *cols(order), F.inline(rows))
    if dedup == "response":
        long = distinct_on(long, [*ids, response], ["__at", *order])
    elif dedup == "question":
        long = distinct_on(long, [*ids, question], ["__at", *order])
    return long.select(*cols(ids), col(question), col(response))


def explode_delimited(df: DataFrame, column: str, sep: str = "|") -> DataFrame:
    """One row per trimmed part of a delimited text; null stays one null row."""
    # Parts are trimmed inside the array, so that each is trimmed once however often it is used.
    literal = "\\" + sep if len(sep) == 1 and not sep.isalnum() else "\\Q" + sep + "\\E"
    parts = F.transform(F.split(col(column), literal), strip)
    return df.select(*[F.explode_outer(parts).alias(c) if c == column else col(c) for c in df.columns])


def pivot_strict(
    df: DataFrame,
    ids: Sequence[str],
    label: str,
    value: str,
    labels: Sequence[str],
) -> DataFrame:
    """Long to wide by declared labels; a repeated (ids, label) fails the job.

    Rows are placed by ids once: a key holds at most one row per label, and both groupings
    below then work inside that placement.
    """
    cells = (
        df.where(col(label).isin(list(labels)))
        .repartition(*cols(ids))
        .groupBy(*cols(ids), col(label))
        .agg(F.max(col(value)).alias("__v"), F.count(F.lit(1)).alias("__n"))
        .where(check(F.col("__n") == 1, f"pivot: {label} occurs twice for one key of {list(ids)}"))
    )
    return cells.groupBy(*cols(ids)).pivot(label, list(labels)).agg(F.first("__v"))


def pivot_fill(
    df: DataFrame,
    ids: Sequence[str],
    column: str,
    levels: Sequence | Mapping,
    value: str | None = None,
    fill: object = 0,
    how: str = "count",
) -> DataFrame:
    """Cells per declared level: ``count``, ``sum``, or the single ``value``; absent cells are filled.

    An existing cell whose value is null stays null. ``levels`` may map levels to new names.
    """
    named = dict(levels) if isinstance(levels, Mapping) else {v: str(v) for v in levels}

    def cell(level: object) -> Column:
        at = col(column) == F.lit(level)
        n = F.count_if(at)
        if how == "count":
            return n
        if how == "sum":
            return F.when(n == 0, F.lit(fill)).otherwise(F.sum(F.when(at, col(value))))
        return F.when(n == 0, F.lit(fill)).otherwise(F.max(F.when(at, col(value))))

    return df.groupBy(*cols(ids)).agg(*[cell(v).alias(n) for v, n in named.items()])


def transpose_metrics(
    df: DataFrame,
    period: str,
    metrics: Sequence[str],
    periods: Sequence | Mapping,
    name: str = "metric",
    as_text: bool = False,
) -> DataFrame:
    """Metrics become rows and periods become columns."""
    source = df
    if as_text:
        source = df.select(col(period), *[col(m).cast("string").alias(m) for m in metrics])
    long = source.select(col(period), *cols(metrics)).unpivot(col(period), cols(metrics), name, "__v")
    named = dict(periods) if isinstance(periods, Mapping) else {p: str(p) for p in periods}
    return long.groupBy(col(name)).agg(
        *[F.max(F.when(col(period) == F.lit(p), F.col("__v"))).alias(n) for p, n in named.items()]
    )


def cast_columns(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """Cast several columns; texts that do not fit become null."""
    chosen = set(columns)
    return df.select(*[col(c).try_cast(dtype).alias(c) if c in chosen else col(c) for c in df.columns])


def without_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.withColumn(column, without_text(col(column), prefix))


def override_cells(
    df: DataFrame, overrides: DataFrame, on: Sequence[str], column: str
) -> DataFrame:
    """Replace computed cells by a keyed table of corrections."""
    fixes = overrides.select(*cols(on), col(column).alias("__fix"))
    joined = null_safe_join(df, fixes, on, "left")
    return joined.withColumn(column, F.coalesce(F.col("__fix"), col(column))).drop("__fix")
