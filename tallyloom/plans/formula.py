"""States and tribes: screens of an extract to resolved, long, wide and metadata tables.

One plan serves every form year; what differs is in ``forms.StateForm``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.html import html_unescape, unescape_columns
from tallyloom.functions.names import col, cols, prefix_keys, present
from tallyloom.functions.values import binary_category, normalise_id, parse_date, unify_alias
from tallyloom.operators import coverage, hygiene, joins, resolve, rollup
from tallyloom.operators.history import merge_history
from tallyloom.operators.reshape import (
    crosswalk_long, matching_labels, matching_values, pivot_strict, rename_by_substring, rename_columns, survey_families, unpivot_families,
)
from tallyloom.plans import forms
from tallyloom.plans.forms import StateForm
from tallyloom.sources.publish import publish, publish_periods
from tallyloom.sources.staging import stage
from tallyloom.sources.tables import drop_periods, overwrite_periods

NAME_ALIASES = ["GRANTEE NAME", "GRANTEE_NAME", "GRANTEENAME"]  # fixed values
# What decides which submission counts.
RESOLVING = ["CodeTxt", "Fy", "RptEin", "ProgAcronym", "RevSeqNumber", "SubmitDate", "GranteeTypeTxt", "PostalCode"]
#: Number of a joined submission, by which the resolved ones are found again.
NUMBER = "__submission"


def clean_screens(
    screens: Mapping[str, DataFrame],
    row_order: Sequence[str] = forms.ROW_ORDER,
    territories: bool = True,
    kept: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Sentinels to null, one grantee name per id, trimmed text; territories count as states.

    ``kept`` holds ids for some screens, as they are once cleaned: rows without one go before names are looked up.
    """
    out = {}
    for name, df in screens.items():
        if territories:
            df = hygiene.recode_columns(df, {"GranteeTypeTxt": {"Territory": "State"}})
        out[name] = hygiene.clean_strings(df, trim=False)
        if kept and name in kept:
            out[name] = _keep_cleaned(out[name], kept[name])
    named = rollup.canonicalise(
        {**out, "__cover": screens["Screen-1"]}, "RptEin", "GranteeName", "__cover", present(screens["Screen-1"].columns, row_order)
    )
    return {n: hygiene.clean_strings(named[n], sentinels=()) for n in screens}


def _keep_cleaned(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ids, once trimmed, are among ``ids``."""
    keys = {c: f"__id{i}" for i, c in enumerate(ids.columns)}
    texts = [k for c, k in keys.items() if dict(df.dtypes)[c] == "string"]
    trimmed = hygiene.clean_strings(df.withColumns({k: col(c) for c, k in keys.items()}), sentinels=(), columns=texts)
    return joins.keep_ids(trimmed, ids, [(k, c) for c, k in keys.items()]).drop(*keys.values())


def submission_keys(cover: DataFrame, form: StateForm) -> list[str]:
    """Named keys, or the leading columns of the cover page."""
    return list(form.keys) or prefix_keys(cover, form.n_key_columns, ["Screen-Name", *form.row_order])


def join_screens(cover: DataFrame, metrics: DataFrame, form: StateForm) -> DataFrame:
    """Cover page and metrics as one wide row per submission, with a plain id."""
    spare = [*form.row_order, "Screen-Name"]
    wide = joins.join_shared(
        cover.drop("Screen-Name"), metrics.drop(*spare), submission_keys(cover, form)
    )
    return rename_by_substring(_dated(wide), form.repairs)


def _dated(df: DataFrame) -> DataFrame:
    """The submit date parsed, and a plain id."""
    if dict(df.dtypes)["SubmitDate"] == "string":
        day = F.coalesce(parse_date(col("SubmitDate")), parse_date(F.left(col("SubmitDate"), F.lit(10)), "yyyy-MM-dd"))
    else:
        day = col("SubmitDate").cast("date")
    return df.withColumns({"SubmitDate": day, "EIN": normalise_id(col("RptEin"))})


def _identity(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns of a screen that tell submissions apart or decide between them."""
    return [c for c in df.columns if c in keys or c in RESOLVING]


def submission_index(cover: DataFrame, metrics: DataFrame, form: StateForm) -> DataFrame:
    """One narrow row per submission that has both screens: its keys and what decides which counts. No metric is read."""
    keys = submission_keys(cover, form)
    ids = joins.join_shared(cover.select(*cols(_identity(cover, keys))), metrics.select(*cols(_identity(metrics, keys))), keys)
    return _dated(ids)


def joined_submissions(cover: DataFrame, metrics: DataFrame, form: StateForm) -> DataFrame:
    """Wide rows of the submissions that were not returned, numbered: each screen is read, named and moved once.

    Numbers hold for what was written, so write the table before it is read.
    """
    valid = hygiene.exclude_values(cover, "CodeTxt", [forms.RETURNED])
    if "CodeTxt" in submission_keys(cover, form):  # then metrics of returned submissions meet nothing
        metrics = hygiene.exclude_values(metrics, "CodeTxt", [forms.RETURNED])
    return join_screens(valid, metrics, form).withColumn(NUMBER, F.monotonically_increasing_id())


def deciding_columns(joined: DataFrame) -> DataFrame:
    """Number and what decides which submission counts; no metric is read."""
    return joined.select(*cols([NUMBER, *present(joined.columns, [*RESOLVING, "EIN"])]))


def counted_submissions(joined: DataFrame, kept: DataFrame) -> DataFrame:
    """Wide rows of the resolved submissions only. ``kept``: the resolved deciding columns; ties that were kept stay."""
    kind = col("GranteeTypeTxt")
    return joins.keep_ids(joined.where((kind == "State") | (kind == "Tribe")), kept.select(NUMBER), [NUMBER]).drop(NUMBER)


def resolve_submissions(wide: DataFrame) -> DataFrame:
    """The submission that counts: not returned, latest revision, latest per state; tribes as they are.

    Null keys form groups of their own. A missing submit date is the earliest.
    """
    valid = hygiene.exclude_values(wide, "CodeTxt", [forms.RETURNED])
    latest = resolve.keep_max(valid, ["Fy", "EIN", "ProgAcronym"], "RevSeqNumber", null_keys="keep")
    dated = latest.withColumn("__day", F.coalesce(col("SubmitDate"), F.lit("0001-01-01").cast("date")))
    kind = col("GranteeTypeTxt")
    return resolve.resolve_subset(
        dated, kind == "State", ["PostalCode", "Fy", "ProgAcronym"], "__day", kind == "Tribe", null_keys="keep"
    ).drop("__day")


def original_format(wide: DataFrame, text_columns: Sequence[str] | None = None) -> DataFrame:
    """Resolved submissions with entities decoded. Decoding comes last: it touches survivors only."""
    keys = ["CodeTxt", "Fy", "EIN", "ProgAcronym", "GranteeTypeTxt", "PostalCode"]
    decodable = [n for n, t in wide.dtypes if t == "string" and n not in keys]
    return unescape_columns(resolve_submissions(wide), text_columns or decodable)


def decoded(wide: DataFrame) -> DataFrame:
    """Entities decoded in all texts but the keys of the outputs."""
    keys = ["CodeTxt", "Fy", "EIN", "ProgAcronym", "GranteeTypeTxt", "PostalCode"]
    return unescape_columns(wide, [n for n, t in wide.dtypes if t == "string" and n not in keys])


def service_outcomes(resolved: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Survey type by measure, one row per submission and survey type."""
    name, label = "Meta Name Description", "Label"
    chosen = crosswalk.where(col("Group_Description") == "Service Outcome").select(col(name), col(label))
    labels = matching_labels(chosen, name, resolved.columns, label, fold=True)
    columns = [c for c in resolved.columns if c.upper() in labels]
    families = survey_families(columns, labels, forms.OUTCOME_FAMILIES, forms.SURVEY_TYPES, "Total")
    return rename_columns(unpivot_families(resolved, forms.ID_COLUMNS, families, "Survey Type"), forms.ID_NAMES)


def state_receipts(resolved: DataFrame) -> DataFrame:
    """Ids of the resolved state submissions, which are few; written on their own, joins know how few."""
    return resolved.where(col("GranteeTypeTxt") == "State").select(col("Rpt-Receipt-Id")).distinct()


def subaward_rows(
    screen: DataFrame, categories: DataFrame, receipts: DataFrame, row_order: Sequence[str] = forms.ROW_ORDER
) -> DataFrame:
    """Sub-awards of the resolved state submissions, with their population categories.

    The semi-join comes first, so that dropped rows are neither decoded nor looked up. Write the result before it is
    filtered: a filter on a decoded column would pass below the semi-join and have every row decoded.
    """
    kept = unescape_columns(joins.keep_ids(screen, receipts, ["Rpt-Receipt-Id"]))
    renamed = rename_columns(kept, forms.SUBAWARD_RENAMES)
    order = present(categories.columns, row_order)
    dim = resolve.distinct_on(categories, ["SubAwdCultSpecf"], order or [c for c in categories.columns if c != "SubAwdCultSpecf"])
    out = joins.lookup_left(
        renamed, dim.drop(*order).withColumn("__served", col("SubAwdCultSpecf")), [(forms.SERVED, "__served")]
    )
    return hygiene.clean_strings(out, sentinels=["nan"], trim=False)


def with_fund_totals(resolved: DataFrame, subawards: DataFrame) -> DataFrame:
    """Shelter and other sub-award totals per year, state and program, on every submission."""
    facts = subawards.where(col("GranteeTypeTxt") == "State").select(
        col("Fy"), col("PostalCode"), col("ProgAcronym"), col(forms.AMOUNT),
        binary_category(col(forms.TYPE_RAW), "Shelter", "Shelter", "Non-Shelter").alias("ShelterType"),
    )
    return rollup.category_totals(
        resolved, facts, ["Fy", "PostalCode", "ProgAcronym"], "ShelterType", forms.AMOUNT,
        {"Non-Shelter": forms.NONSHELTER_TOTAL, "Shelter": forms.SHELTER_TOTAL},
    )


#: Position of an element's column in the wide submission, where a long table keeps its order.
COLUMN_IX = "column_ix"


def long_table(
    resolved: DataFrame, subawards: DataFrame, lookup: DataFrame, form: StateForm, ordered: bool = False
) -> DataFrame:
    """One row per submission and element; fund totals exist for states only.

    ``ordered`` adds the place of every row: the position of its column, then the place of its submission.
    """
    extra = [forms.SHELTER_TOTAL, forms.NONSHELTER_TOTAL]
    wide = rename_columns(with_fund_totals(resolved, subawards), form.question_names)
    order = present(wide.columns, form.row_order) if ordered else []
    long = crosswalk_long(
        wide, [*forms.ID_COLUMNS, *order], lookup.withColumn("Element", F.upper("Element")),
        attributes=forms.LOOKUP_ATTRIBUTES, extra=extra, value="Value", position=COLUMN_IX if ordered else None,
    )
    kept = long.where(~(col("Element").isin(extra) & (col("GranteeTypeTxt") != "State")))
    return rename_columns(kept, forms.ID_NAMES)


def merge_long_history(
    history: DataFrame | None, long: DataFrame, cover: DataFrame, by_program: bool = True, order_by: Sequence[str] = ("Value",)
) -> DataFrame:
    """History without the years of the extract, plus the extract. ``by_program=False`` merges programs.

    Of rows with one key the last counts: by position where the long table was built with its order, else by
    ``order_by``.
    """
    key = ["Grant Type", "State", "Year", "EIN", "Element"] + (["Program Acronym"] if by_program else [])
    places = present(long.columns, [COLUMN_IX, *forms.ROW_ORDER])
    merged = merge_history(
        history, long, "Year", cover.select(col("Fy").alias("Year")), key, places or order_by,
        {"Element": unify_alias(col("Element"), NAME_ALIASES, "GRANTEENAME")},
    )
    return merged.drop(*places)


def wide_table(
    long: DataFrame, crosswalk: DataFrame, resolved: DataFrame, labels: Sequence[str], form: StateForm
) -> DataFrame:
    """One row per submission and one column per label, client totals and the newest grantee name."""
    dim = crosswalk.select(F.upper("Element").alias("__element"), col("Label")).where(col("Label").isNotNull())
    named = joins.null_safe_join(long, dim, [("Element", "__element")], "inner")
    wide = pivot_strict(named, forms.OUT_IDS, "Label", "Value", labels)
    counted = [f"{p} {g}" for p in forms.CLIENT_PREFIXES for g in forms.CLIENT_GROUPS]
    absent = {c: F.lit(None).cast("double") for c in counted if c not in wide.columns}
    numeric = {c: col(c).try_cast("double") for c in counted if c in wide.columns}
    wide = rollup.paired_totals(wide.withColumns({**absent, **numeric}), forms.CLIENT_GROUPS, forms.CLIENT_PREFIXES)
    names = rollup.latest_attribute(resolved, "EIN", "Fy", "GranteeName", present(resolved.columns, form.row_order), form.name_floor)
    names = names.select(col("EIN"), html_unescape(col("GranteeName")).alias("Grantee Name"))
    return joins.null_safe_join(wide, names, ["EIN"], "left")


def labelled_elements(
    lookup: DataFrame, crosswalk: DataFrame, columns: Sequence[str], form: StateForm
) -> tuple[list[str], list[str]]:
    """Elements that the long table of these columns has, and the labels of its wide table."""
    extra = [forms.SHELTER_TOTAL, forms.NONSHELTER_TOTAL]
    wanted = [*columns, *extra, *form.question_names.values()]
    elements = matching_values(lookup, "Meta Name Description", wanted, "Element", fold=True) + extra
    return elements, matching_values(crosswalk, "Element", elements, "Label", fold=True)


def reporting_submissions(kept: DataFrame, lookup: DataFrame, crosswalk: DataFrame, columns: Sequence[str], form: StateForm) -> DataFrame:
    """Ids of the wide table's rows, from the resolved index: neither the long nor the wide table is built.

    Every resolved submission has a row for each element, fund totals those of states; it is in the wide table when
    one of its elements has a label.
    """
    extra = {forms.SHELTER_TOTAL, forms.NONSHELTER_TOTAL}
    named = [form.question_names.get(c, c) for c in columns if c not in forms.ID_COLUMNS]
    elements = matching_values(lookup, "Meta Name Description", named, "Element", fold=True)
    labelled = crosswalk.where(col("Label").isNotNull())
    named = matching_values(labelled, "Element", [*elements, *extra], "Element", fold=True)
    ids = rename_columns(kept.select(*cols(forms.ID_COLUMNS)).distinct(), forms.ID_NAMES)
    if any(e.upper() not in extra for e in named):
        return ids
    return ids.where(col("Grant Type") == "State") if named else ids.limit(0)


def reporting_counts(wide: DataFrame) -> DataFrame:
    """Distinct reporting states and tribes per year."""
    ids = wide.select(col("Year"), col("Grant Type"), col("EIN")).distinct()
    return ids.groupBy("Year").agg(
        F.count_if(col("Grant Type") == "State").alias("Number of states reporting"),
        F.count_if(col("Grant Type") == "Tribe").alias("Number of tribes reporting"),
    )


def missing_states(wide: DataFrame, roster: Sequence[str]) -> DataFrame:
    """States of the roster without a submission, per reported year."""
    expected = coverage.expand_grid(wide.select(col("Year")).distinct(), {"State": list(roster)})
    present = wide.where(col("Grant Type") == "State").select(col("Year"), col("State")).distinct()
    return joins.drop_ids(expected, present, ["Year", "State"])


def status_counts(submissions: DataFrame) -> DataFrame:
    """Submissions per year, type, status and program, 0 where none."""
    return coverage.contingency(submissions, ["Fy", "GranteeTypeTxt", "CodeTxt", "ProgAcronym"])


def run(
    screens: Mapping[str, DataFrame],
    lookups: Mapping[str, DataFrame],
    form: StateForm,
    root: str,
    version: str,
    description: str,
    history_path: str | None = None,
    by_program: bool = True,
    history: str | None = None,
    roster: Sequence[str] = forms.STATE_ROSTER,
    stage_with: Callable[[DataFrame], DataFrame] = stage,
) -> dict[str, str]:
    """The whole job: clean, resolve, derive, publish one version, update the history.

    Both screens are joined once, without what was returned, and resolved on the few columns that decide. What feeds
    many tables is written once and read back. ``history`` names a history under
    ``root`` that is published as a version of its own; ``history_path`` is a plain folder by year, replaced in place.
    """
    clean = clean_screens(screens, form.row_order)
    cover, metrics = clean["Screen-1"], clean["Screen-3"]
    joined = stage_with(joined_submissions(cover, metrics, form))
    kept = stage_with(resolve_submissions(deciding_columns(joined)))
    resolved = stage_with(decoded(counted_submissions(joined, kept)))
    receipts = stage_with(state_receipts(resolved))
    awards = clean_screens(screens, form.row_order, kept={"Screen-2": receipts})["Screen-2"]
    subawards = stage_with(subaward_rows(awards, lookups["cultspec_subawardee"], receipts, form.row_order))
    placed = stage_with(long_table(resolved, subawards, lookups["lookup"], form, ordered=True))
    long = placed.drop(COLUMN_IX, *form.row_order)
    xw = lookups["crosswalk"].where(
        col("Meta Name Description").isNotNull() | col("Note").isNotNull()
    )
    _, labels = labelled_elements(lookups["lookup"], xw, resolved.columns, form)
    reporting = reporting_submissions(kept, lookups["lookup"], xw, resolved.columns, form)
    tables = {
        "OriginalFormat": resolved,
        "ServiceOutcome": service_outcomes(resolved, xw),
        "Subawardee": subawards,
        "LongFormat": long,
        "WideFormat": wide_table(long, xw, resolved, labels, form),
        "ReportingCounts": reporting_counts(reporting),
        "MissingStates": missing_states(reporting, roster),
        "StatusCounts": status_counts(submission_index(cover, metrics, form)),
    }
    paths = publish(tables, root, "states_tribes", version, description)
    if history_path:
        store_history(placed, clean["Screen-1"], history_path, by_program)
        paths["History"] = history_path
    if history:
        publish_history(placed, clean["Screen-1"], root, history, version, description, by_program)
    return paths


def publish_history(
    long: DataFrame, cover: DataFrame, root: str, name: str, version: str, description: str, by_program: bool = True
) -> None:
    """The history as a new version: the years of the raw extract are replaced, all others stay by reference, in one step."""
    fresh = merge_long_history(None, long, cover, by_program)
    publish_periods(fresh, cover.select(col("Fy").alias("Year")), root, name, version, description, "Year")


def store_history(long: DataFrame, cover: DataFrame, path: str, by_program: bool = True) -> None:
    """Replace the years of the raw extract in a plain folder by year; years none of whose rows were kept become empty.

    Two steps, during which readers may see either; ``publish_history`` has one. The years of an extract, a handful,
    come to the driver.
    """
    fresh = merge_long_history(None, long, cover, by_program)
    years = cover.select(col("Fy").alias("Year")).distinct()
    # Merging keeps a row of every year, so that the long table tells them and is not merged twice.
    gone = joins.drop_ids(years, long.select("Year").distinct(), ["Year"])
    overwrite_periods(fresh, path, "Year")
    drop_periods(long.sparkSession, path, "Year", [r.Year for r in gone.collect()])
