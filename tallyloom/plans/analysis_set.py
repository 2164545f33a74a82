"""Cleaned tables to the published analysis sets the briefings read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, present
from tallyloom.functions.values import join_labels, parse_date, recode
from tallyloom.operators import joins, resolve, rollup
from tallyloom.operators.reshape import cast_columns, rename_columns
from tallyloom.plans import forms
from tallyloom.sources.publish import publish

STATUS_KEYS = ["Program Acronym", "EIN", "Grantee Name", "Grant Type", "State", "Year"]


def analysis_wide(
    wide: DataFrame,
    original: DataFrame,
    metrics: Sequence[str],
    numeric: Sequence[str],
    year: int,
    programs: Mapping[str, str],
    unique_status: bool = False,
) -> DataFrame:
    """Wide rows of one year with review status, completeness, numeric metrics and program names.

    The year is filtered first; it is a key of every later step. Several statuses of one
    submission give several rows unless ``unique_status`` forbids it.
    """
    rows = cast_columns(wide.where(col("Year") == year), metrics, "string")
    status = original.where(col("Fy") == year).select(
        col("ProgAcronym").alias("Program Acronym"), col("EIN"), col("GranteeName").alias("Grantee Name"),
        col("GranteeTypeTxt").alias("Grant Type"), col("PostalCode").alias("State"), col("Fy").alias("Year"), col("CodeTxt"),
    ).distinct()
    rows = joins.lookup_left(rows, status, STATUS_KEYS, unique=unique_status)
    flagged = rollup.completeness(
        rows, metrics, ["EIN", "Grant Type", "Year", "Program Acronym", "State"], "ppr_completeness"
    )
    out = cast_columns(flagged, numeric, "double")
    return out.withColumn("Program Acronym", recode(col("Program Acronym"), programs))


def analysis_subawards(
    subawards: DataFrame, year: int, programs: Mapping[str, str], compat_labels: bool = False
) -> DataFrame:
    """Sub-awards of one year with population label and flag, program names and short headers."""
    label = join_labels(col("CultSpec2"), col("CultSpec3"), compat=compat_labels)
    out = subawards.where(col("Fy") == year).withColumns(
        {
            "cult_cat": label,
            "csus": label != "None",
            "CultSpec2": F.coalesce(col("CultSpec2"), F.lit("")),
            "CultSpec3": F.coalesce(col("CultSpec3"), F.lit("")),
            "ProgAcronym": recode(col("ProgAcronym"), programs),
        }
    )
    return rename_columns(out, {forms.AREA_RAW: forms.AREA, forms.TYPE_RAW: forms.TYPE})


def publish_analysis_set(
    tables: Mapping[str, DataFrame], root: str, version: str, sources: Sequence[str]
) -> dict[str, str]:
    """The tables of both years as one version, described by the files they came from."""
    return publish(tables, root, "data_for_R", version, ", ".join(sources))


def latest_record(screen: DataFrame, row_order: Sequence[str] = forms.ROW_ORDER) -> DataFrame:
    """The row with the latest submit date per year, grantee and program."""
    day = col("SubmitDate")
    if dict(screen.dtypes)["SubmitDate"] == "string":
        day = parse_date(day)
    return resolve.top_n_per_group(
        screen, ["Fy", "RptEin", "ProgAcronym"], [day.desc_nulls_last(), *[col(o) for o in present(screen.columns, row_order)]], 1
    )


COALITION_TABLES = {
    "funding_data": "Screen-2", "event_data": "Screen-7", "tta_data": "Screen-6", "org_data": "Screen-3",
}


def coalition_set(
    screens: Mapping[str, DataFrame], priority_areas: DataFrame, suffix: str = "", row_order: Sequence[str] = forms.ROW_ORDER
) -> dict[str, DataFrame]:
    """Latest records of four screens and the priority areas, for one form year."""
    out = {n + suffix: latest_record(screens[s], row_order) for n, s in COALITION_TABLES.items()}
    out["pa_data" + suffix] = priority_areas
    return out


def publish_coalition_set(
    tables: Mapping[str, DataFrame], root: str, version: str, sources: Sequence[str]
) -> dict[str, str]:
    return publish(tables, root, "data_for_R_coalitions", version, ", ".join(sources))
