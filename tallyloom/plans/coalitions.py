"""Coalitions: seven screens to section tables with missing submissions flagged, and two long tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, cols, names_like, present
from tallyloom.functions.values import parse_date, recode
from tallyloom.operators import coverage, hygiene, joins, resolve
from tallyloom.operators.reshape import (
    cast_columns, prefix_families_long, questions_long, rename_by_crosswalk, rename_columns,
)
from tallyloom.plans import forms
from tallyloom.plans.formula import clean_screens
from tallyloom.plans.forms import CoalitionForm
from tallyloom.sources.publish import publish
from tallyloom.sources.staging import stage
from tallyloom.sources.tables import literal_table

GRID = ["State", "Year", "Program Abbr"]
COVER, NARRATIVE, ACTIVITIES = "Screen-1", "Screen-4", "Screen-5"


def expected_submissions(
    spark, form: CoalitionForm, states: Sequence[str] | DataFrame = forms.COALITION_STATES
) -> DataFrame:
    """Every state with every (year, program) pair of the form. ``states``: declared, or a table with ``State``."""
    periods = literal_table(spark, {"Year": "string", "Program Abbr": "string"}, form.periods)
    if isinstance(states, DataFrame):
        pair = F.array(*[F.struct(F.lit(y).alias("Year"), F.lit(p).alias("Program Abbr")) for y, p in form.periods])
        return states.select(col("State")).distinct().select("State", F.inline(pair))
    return coverage.expand_grid(periods, {"State": list(states)}).select("State", "Year", "Program Abbr")


def id_columns(cover: DataFrame, form: CoalitionForm, first: int = 1, last: int = 41) -> list[str]:
    """Identifier columns: a leading block of the cover page, renamed, without what varies."""
    varying = [*forms.ITERATIONS, "RevSeqNumber", "SubmitDate", *form.row_order]
    return [
        form.renames.get(c, c) for c in cover.columns[first:last] if c not in varying and c != "EIN"
    ]


def _grid_values() -> dict[str, Column]:
    """Program and year as the expected submissions have them."""
    return {"Program Abbr": recode(col("Program Abbr"), forms.COALITION_PROGRAMS), "Year": col("Year").cast("string")}


def _expected_rows(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of expected submissions, columns as they are."""
    marks = {c: f"__{i}" for i, c in enumerate(_grid_values())}
    marked = df.withColumns({marks[c]: v for c, v in _grid_values().items()})
    return joins.keep_ids(marked, expected, [(marks.get(g, g), g) for g in GRID]).drop(*marks.values())


def _as_is(df: DataFrame) -> DataFrame:
    return df


def standardise(
    screens: Mapping[str, DataFrame],
    ids: Sequence[str],
    names: DataFrame,
    form: CoalitionForm,
    stage_with: Callable[[DataFrame], DataFrame] = _as_is,
    expected: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """One submission per id on every screen, coalition names from the list, cover columns everywhere.

    ``stage_with`` writes the screens; the cover page first, since every other screen reads it. With ``expected``,
    rows that no section will hold go first, where the ids tell them.
    """
    out: dict[str, DataFrame] = {}
    for screen, raw in screens.items():
        df = rename_columns(raw.drop("EIN"), form.renames)
        if "SubmitDate" in df.columns and dict(df.dtypes)["SubmitDate"] == "string":
            df = df.withColumn("SubmitDate", parse_date(col("SubmitDate")))
        if expected is not None and set(GRID) <= set(ids):
            df = _expected_rows(df, expected)
        levels = [("RevSeqNumber", "max"), ("SubmitDate", "max"), ("Row-Iteration", "min")]
        df = resolve.resolve_hierarchy(df, list(ids), levels)
        df = joins.lookup_left(df, names, ["State"])
        out[screen] = df.drop(*[c for c in df.columns if "granteename" in c.replace(" ", "").lower()])
    out[COVER] = stage_with(out[COVER])
    enriched = joins.enrich_from_cover(out, COVER, exclude=[*forms.ITERATIONS, *form.row_order])
    return {s: df if s == COVER else stage_with(df) for s, df in enriched.items()}


def section_keys(screens: Mapping[str, DataFrame], ids: Sequence[str], form: CoalitionForm) -> list[str]:
    """Identifiers of every section: the ids, and the cover columns that some raw screen lacks."""
    named = {s: [form.renames.get(c, c) for c in df.columns if c != "EIN"] for s, df in screens.items()}
    shared_by_all = set(named[COVER]).intersection(*named.values())
    varying = {*forms.ITERATIONS, *form.row_order}
    added = [
        c for c in named[COVER]
        if c not in shared_by_all and c not in ids and c not in varying and "granteename" not in c.replace(" ", "").lower()
    ]
    return [*ids, *added]


def section_table(
    df: DataFrame, screen: str, keys: Sequence[str], crosswalk: DataFrame, expected: DataFrame, names: DataFrame, form: CoalitionForm
) -> DataFrame:
    """A labelled section against the expected submissions, one row per key, ``Missing`` where none came."""
    df = rename_by_crosswalk(df, crosswalk)
    if screen == ACTIVITIES:
        df = hygiene.null_values_like(df, ["Involvement"], ["none", "select"])
        df = cast_columns(df, names_like(df.columns, ["Trained"]), "double")
    df = df.withColumns(_grid_values())
    own = [k for k in keys if k in df.columns]
    one = resolve.distinct_on(df, own, present(df.columns, form.row_order))
    # The rows themselves tell which submissions came, so that their first ones are looked for once.
    seen = df if set(GRID) <= set(own) else None
    found = coverage.complete_against(one.drop("CoalitionName"), expected, GRID, seen=seen)
    return joins.lookup_left(found, names, ["State"])


def narrative_columns(columns: Sequence[str], form: CoalitionForm) -> list[str]:
    """Columns of the numbered questions this form year asks."""
    return [c for c in columns if re.match(rf"[1-{form.questions}]\. ", c)]


def sections(
    screens: Mapping[str, DataFrame],
    keys: Sequence[str],
    crosswalk: DataFrame,
    expected: DataFrame,
    names: DataFrame,
    form: CoalitionForm,
    stage_with: Callable[[DataFrame], DataFrame] = _as_is,
) -> dict[str, DataFrame]:
    """All sections; the narrative answers also join the summary of activities."""
    repaired = {
        s: rename_columns(df, forms.ACTIVITY_REPAIRS) if s == ACTIVITIES else df for s, df in screens.items()
    }
    out = {
        s: stage_with(section_table(df, s, keys, crosswalk, expected, names, form)) for s, df in repaired.items()
    }
    on = [*keys, "Missing", "CoalitionName"]
    answers = out[NARRATIVE].select(*cols([*on, *narrative_columns(out[NARRATIVE].columns, form)]))
    out[ACTIVITIES] = stage_with(joins.lookup_left(out[ACTIVITIES], answers, on, unique=False))
    return out


def long_id_columns(keys: Sequence[str]) -> list[str]:
    """Identifier columns of the two long tables."""
    return list(dict.fromkeys([*keys, "Missing", "CoalitionName", "Rpt-Receipt-Id"]))


def narrative_long(section: DataFrame, ids: Sequence[str], form: CoalitionForm, dedup: str = "response") -> DataFrame:
    """(question, response) rows; equal responses of a submission keep the first question."""
    return questions_long(
        section, ids, narrative_columns(section.columns, form), dedup=dedup, unique_ids=True
    )


def activities_long(section: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per priority area and type of activity. A section holds its ids once."""
    return prefix_families_long(section, ids, forms.ACTIVITY_FAMILIES, explode="Types of Activities")


def run(
    screens: Mapping[str, DataFrame],
    crosswalk: DataFrame,
    names: DataFrame,
    form: CoalitionForm,
    root: str,
    version: str,
    description: str,
    ids: Sequence[str] | None = None,
    states: Sequence[str] = forms.COALITION_STATES,
    stage_with: Callable[[DataFrame], DataFrame] = stage,
) -> dict[str, str]:
    """The whole job: clean, standardise, complete, reshape, publish one version."""
    ids = list(ids) if ids is not None else id_columns(screens[COVER], form)
    clean = clean_screens({s: screens[s] for s in forms.SECTIONS}, form.row_order, territories=False)
    expected = expected_submissions(names.sparkSession, form, states)
    standard = standardise(clean, ids, names, form, stage_with, expected)
    keys = section_keys(clean, ids, form)
    done = sections(standard, keys, crosswalk, expected, names, form, stage_with)
    long_ids = long_id_columns(keys)
    tables = {forms.SECTIONS[s]: df for s, df in done.items()}
    tables["Section IV Narr Long Format"] = narrative_long(done[NARRATIVE], long_ids, form)
    tables["Section V SoA Long Format"] = activities_long(done[ACTIVITIES], long_ids)
    return publish(tables, root, "coalitions", version, description)
