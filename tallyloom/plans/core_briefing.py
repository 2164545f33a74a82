"""Core briefing: the sub-award base table and one function per reported table or figure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.aggregates import mean_of
from tallyloom.functions.names import col, cols
from tallyloom.functions.values import (
    classify_contains, hit_label, money_text, period_label, period_name, range_text, recode, status_label, threshold_label,
)
from tallyloom.operators import coverage, hygiene, joins, present, resolve, rollup
from tallyloom.operators.reshape import pivot_fill, transpose_metrics
from tallyloom.plans import forms
from tallyloom.plans.forms import AMOUNT, AREA, CITY, CULT, NAME, STATE, TYPE, YEAR

ENTITY = [NAME, CITY, STATE]


@dataclass(frozen=True)
class CoreBriefing:
    """Years, levels and programs the tables are about."""

    years: tuple[int, ...] = (2023, 2024)
    regions: tuple[str, ...] = tuple(forms.REGIONS)
    types: Mapping[str, str] = field(default_factory=lambda: forms.TYPE_LEVELS)
    areas: Mapping[str, str] = field(default_factory=lambda: forms.AREA_LEVELS)
    program: str = forms.CORE

    @property
    def labels(self) -> dict[int, str]:
        return {y: period_name(y) for y in self.years}

    def year_label(self, c: Column) -> Column:
        return period_label(c, self.years)


# Spellings of sub-award names that mean one organisation.
NAME_REPAIRS = {
    "Hogar Ruth": "Hogar Ruth para Mujeres Maltratadas",
    "Hogar la Piedad": "Hogar la Piedad- Fundesco",
    "Institute for Individual, group and Organizational Development,AFANA":
        "Institute for Individual group and Organizational Development, AFANA",
    "Instituto del Hogar Celia & Harris Bunker": "Instituto del Hogar Celia & Harris Bunker, Inc.",
    "La casa de Todos": "La Casa de Todos",
    "Oficina para la promocion y el desarrollo Humano, Inc.": "Oficina para la promoción y el Desarrollo Humano, Inc",
    "School of Medicine": "School of Medicine of Ponce",
    "Municipio de Caguas": "Municipio Autonomo de Caguas",
    "Municipio de Cidra": "Municipio Autonomo de Cidra",
    "Municipio de Coamo": "Municipio Autonomo de Coamo",
}


def core_subawards(
    parts: Sequence[DataFrame], b: CoreBriefing, order_by: Sequence[str] = (), keep: Sequence[str] | None = ()
) -> DataFrame:
    """Named, funded sub-awards of the program, with one funding total per entity, type, area and category.

    ``keep`` carries other columns of the first row (None for all); the tables need none.
    """
    rows = present.stack(parts).where(
        (col("ProgAcronym") == b.program) & col(YEAR).isin(list(b.years)) & col(NAME).isNotNull()
    )
    return resolve.total_and_distinct(
        hygiene.nonzero(rows, AMOUNT), [YEAR, *ENTITY, TYPE, AREA, CULT], AMOUNT, order_by, "funding", keep
    )


def region_lookup(regions: DataFrame) -> DataFrame:
    return regions.select(col("State Abb").alias(STATE), col("HHS Region").alias("Region"))


def statewide_coalitions(coalitions: DataFrame) -> DataFrame:
    return coalitions.where(col("statewide_dv")).select("data_name", "coalition", "state")


def placed_subawards(core: DataFrame, regions: DataFrame, coalitions: DataFrame) -> DataFrame:
    """Sub-awards with their region; those to a coalition get its name and that type.

    Both lookups are checked and laid out once, so that the joins shuffle the sub-awards alone.
    """
    names = statewide_coalitions(coalitions).select(col("data_name"), col("coalition"))
    out = joins.lookup_left(core, joins.lay_out(region_lookup(regions), [STATE], "regions"), [STATE])
    out = joins.lookup_left(out, joins.lay_out(names, ["data_name"], "coalitions"), [(NAME, "data_name")])
    return out.withColumn(TYPE, hit_label(col("coalition"), "Coalition", col(TYPE)))


def by_type(placed: DataFrame) -> DataFrame:
    """Funding per entity and type. Region and coalition follow from state and name."""
    return rollup.sum_by(placed, [YEAR, *ENTITY, TYPE, "Region", "coalition"], "funding", "funding")


def subawardees_per_year(core: DataFrame, b: CoreBriefing) -> DataFrame:
    out = rollup.count_distinct_entities(core, ENTITY, [YEAR], "Total Subawardees")
    return out.select(b.year_label(col(YEAR)).alias("Fiscal Year"), col("Total Subawardees"))


def funding_summary(core: DataFrame, funding: DataFrame, allotments: Mapping[str, int], b: CoreBriefing) -> DataFrame:
    """Allotted and sub-awarded funds, metrics as rows and years as columns, as money text.

    ``allotments`` maps the name of a grant program to its year.
    """
    granted, awarded = "Total Funding to Grant Recipients", "Total Grant Recipient Funding to Subawardees"
    grants = funding.where(col("Grant Program").isin(list(allotments))).withColumn(
        YEAR, classify_contains(col("Grant Program"), [(p, str(y)) for p, y in allotments.items()]).cast("int")
    )
    tables = [rollup.sum_by(core, [YEAR], "funding", awarded), rollup.sum_by(grants, [YEAR], "Amount", granted)]
    both = joins.lookup_left(tables[0], tables[1], [YEAR])
    text = both.select(col(YEAR), money_text(col(granted)).alias(granted), money_text(col(awarded)).alias(awarded))
    return transpose_metrics(text, YEAR, [granted, awarded], b.labels, "Funding Metric")


def _regional_table(placed: DataFrame, category: str, names: Mapping[str, str], b: CoreBriefing) -> DataFrame:
    total_name = F.concat(b.year_label(col(YEAR)), F.lit(" - Total"))
    out = rollup.counts_with_distinct_total(
        placed, ENTITY, [YEAR], "Region", category, names, "Regional Total*", total_name
    )
    levels = list(b.regions)
    return (
        out.withColumn("__at", F.when(col("is_total"), F.lit(0)).otherwise(present.level_rank(col("Region"), levels)))
        .orderBy(col(YEAR), col("__at").asc_nulls_last())
        .drop("__at", "is_total")
    )


def region_by_type(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    """Sub-awardees per region and type with yearly totals; the last column counts each once."""
    return _regional_table(placed, TYPE, b.types, b)


def region_by_area(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    """Sub-awardees per region and area designation, as ``region_by_type``."""
    return _regional_table(placed, AREA, b.areas, b)


def type_totals(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    """Figure data: sub-awardees per year and type."""
    known = placed.where(col(TYPE).isin(list(b.types)))
    out = rollup.count_distinct_entities(known, ENTITY, [YEAR, TYPE], "totals")
    return out.select(
        b.year_label(col(YEAR)).alias(YEAR), recode(col(TYPE), b.types).alias("shelter_type"), col("totals")
    )


def _type_by_year_text(df: DataFrame, value: str, b: CoreBriefing) -> DataFrame:
    """Types as rows in declared order, years as columns of money text; absent stays null."""
    text = df.withColumns({value: money_text(col(value)), TYPE: recode(col(TYPE), b.types)})
    wide = pivot_fill(text, [TYPE], YEAR, b.labels, value, fill=None, how="value")
    return present.order_by_levels(wide, TYPE, list(b.types.values()))


def funding_by_type(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    """Numeric: total sub-awarded per type and year."""
    return rollup.sum_by(by_type(placed), [TYPE, YEAR], "funding", "Total Subawards")


def funding_by_type_table(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    return _type_by_year_text(funding_by_type(placed, b), "Total Subawards", b)


def mean_award(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    """Mean total per entity and year."""
    return rollup.agg_of_agg(placed, ENTITY, [YEAR], "funding", {"average_award": "mean"})


def mean_award_by_type(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    return rollup.stats_by(by_type(placed), [TYPE, YEAR], "funding", {"Average Award": "mean"})


def mean_award_by_type_table(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    return _type_by_year_text(mean_award_by_type(placed, b), "Average Award", b)


def award_range(placed: DataFrame, b: CoreBriefing, digits: int = 0) -> DataFrame:
    """Smallest and largest award per type under a heading for each year."""
    stats = rollup.stats_by(by_type(placed), [TYPE, YEAR], "funding", {"low": "min", "high": "max"})
    rows = stats.select(
        col(YEAR), recode(col(TYPE), b.types).alias(TYPE), range_text(col("low"), col("high"), digits).alias("Range of Funding")
    )
    banded = present.with_band_rows(rows, YEAR, TYPE, b.labels)
    return present.order_by_levels(
        banded, TYPE, list(b.types.values()), before=[YEAR, "band_row"]
    ).select(col(YEAR), col(TYPE), col("Range of Funding"))


def region_counts(placed: DataFrame, kind: str, b: CoreBriefing) -> DataFrame:
    """Figure data: sub-awardees of one type per region and year."""
    chosen = placed.where(col(TYPE) == kind)
    out = rollup.count_distinct_entities(chosen, ENTITY, ["Region", YEAR], "Total Subawardees")
    out = present.order_by_levels(out, "Region", list(b.regions), after=[YEAR])
    return out.select(col("Region"), b.year_label(col(YEAR)).alias(YEAR), col("Total Subawardees"))


def state_counts(placed: DataFrame, kind: str) -> DataFrame:
    """Sub-awardees and mean award of one type per state and year."""
    chosen = by_type(placed.where(col(TYPE) == kind))
    return chosen.groupBy(*cols([STATE, TYPE, YEAR])).agg(
        F.count(F.lit(1)).alias("Total Subawardees"), mean_of(col("funding")).alias("average_award")
    )


def state_extremes(placed: DataFrame, kind: str, k: int = 10, largest: bool = True) -> DataFrame:
    """States and years with the most (or fewest) sub-awardees of a type."""
    n = col("Total Subawardees")
    return present.top_k(state_counts(placed, kind), [n.desc() if largest else n.asc(), col(STATE), col(YEAR)], k)


def state_mean_extremes(placed: DataFrame, kind: str, k: int = 5, largest: bool = True) -> DataFrame:
    """States with the highest (or lowest) yearly mean of sub-awardees of a type."""
    means = rollup.stats_by(state_counts(placed, kind), [STATE], "Total Subawardees", {"avg_sub": "mean"})
    n = col("avg_sub")
    return present.top_k(means, [n.desc() if largest else n.asc(), col(STATE)], k)


def served_groups(placed: DataFrame) -> DataFrame:
    """Entities serving a population category, with their funding for it."""
    chosen = placed.where(col(CULT) != "")
    return rollup.sum_by(chosen, [YEAR, *ENTITY, "Region"], "funding", "funding")


def served_totals(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    out = served_groups(placed).groupBy(col(YEAR)).agg(
        F.count(F.lit(1)).alias("Number of CS/US Subawardees"), F.sum("funding").alias("__sum")
    )
    return out.select(
        b.year_label(col(YEAR)).alias("Fiscal Year"), col("Number of CS/US Subawardees"),
        money_text(col("__sum")).alias("Funding Amount"),
    )


def served_states(placed: DataFrame) -> DataFrame:
    """States with such an entity, and their number on every row."""
    return rollup.set_count(placed.where(col(CULT) != ""), [STATE], "sum")


def served_share(placed: DataFrame) -> DataFrame:
    """Share of sub-awards serving a category, by state, highest first."""
    out = rollup.share_by(placed, col(CULT) != "", [STATE], "number", "num_cult", "percent")
    return out.orderBy(col("percent").desc(), col(STATE))


def served_by_region(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    out = rollup.count_by(served_groups(placed), ["Region", YEAR], "Total Subawardees")
    out = present.order_by_levels(out, "Region", list(b.regions), after=[YEAR])
    return out.select(col("Region"), b.year_label(col(YEAR)).alias(YEAR), col("Total Subawardees"))


def funded_matrix(placed: DataFrame, b: CoreBriefing, repairs: Mapping[str, str] = NAME_REPAIRS) -> DataFrame:
    """Which such entities were funded in which year; blank where nothing is known."""
    cells = served_groups(placed).select(
        recode(col(NAME), repairs).alias("Subawardee"), col(CITY).alias("City"), col(STATE).alias("State"), col(YEAR),
        threshold_label(col("funding"), "Funded").alias("Funded"),
    )
    wide = pivot_fill(cells, ["Subawardee", "City", "State"], YEAR, b.labels, "Funded", fill="", how="value")
    return wide.orderBy("State", "Subawardee", "City")


def coalition_amounts(placed: DataFrame, b: CoreBriefing) -> DataFrame:
    """Funding of each coalition per year as money text, ``$0`` where none."""
    title = "FVPSA State/Territory Funded Statewide Domestic Violence Coalition"
    sums = rollup.sum_by(placed.where(col(TYPE) == "Coalition"), ["coalition", YEAR], "funding")
    text = sums.select(col("coalition").alias(title), col(YEAR), money_text(col("funding")).alias("funding"))
    return pivot_fill(text, [title], YEAR, b.labels, "funding", fill="$0", how="value").orderBy(col(title))


def submission_status(coalitions: DataFrame, wide: DataFrame, b: CoreBriefing) -> DataFrame:
    """Completeness of every expected state and year, or that nothing was submitted."""
    states = statewide_coalitions(coalitions).select(col("state").alias("State")).distinct()
    expected = coverage.expand_grid(states, {"Year": list(b.years)})
    core = wide.where(
        (col("Program Acronym") == b.program) & (col("Grant Type") == "State") & col("Year").isin(list(b.years))
    ).select(col("State"), col("Year"), col("ppr_completeness"))
    out = joins.lookup_left(expected, core, ["State", "Year"], unique=False)
    return out.select(
        col("State"), col("Year").cast("string").alias("Year"),
        status_label(col("ppr_completeness"), "Did not submit").alias("ppr_completeness"),
    )
