"""ARP briefing: the sub-award base table by funding stream and one function per reported table or figure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.names import col, cols
from tallyloom.functions.values import (
    count_text, money_text, more_than, not_in, overwrite_when, parse_amount, recode, status_label, tri_state,
)
from tallyloom.operators import coverage, hygiene, joins, present, rollup
from tallyloom.operators.reshape import explode_delimited, override_cells, pivot_fill
from tallyloom.plans import forms
from tallyloom.sources.publish import publish
from tallyloom.sources.staging import stage

# Funding types of the form and their streams.
STREAM_OF_TYPE = {
    "ARP Sexual Assault Supplemental": "SA",
    "ARP DV Supplemental": "DV",
    "ARP COVID-19 Testing Supplemental": "Covid",
    "FVPSA Core Annual Funding": "Core",
    "Disaster Assistance Supplemental": "Disaster",
}
# Streams of rows without a funding type, by program.
UNSPECIFIED = {
    "ARP Unspecified": [forms.ARP, forms.TESTING, "FSC6", forms.ASSAULT],
    "Disaster Unspecified": ["FVDR"],
    "Core Unspecified": [forms.CORE],
    "CARES Unspecified": [forms.CARES],
}
# Titles of the streams.
STREAM_TITLES = {
    "Covid": "ARP COVID-19 Testing, Vaccines, and Mobile Health Units",
    "SA": "ARP Grants to Support Survivors of Sexual Assault",
    "DV": "ARP Supplemental Funding",
    "ARP Unspecified": "ARP Unspecified",
}
STREAM_COLUMNS = {"DV": "Supplemental", "SA": "Sexual Assault", "Covid": "COVID-19", "ARP Unspecified": "ARP Unspecified"}
STREAM_LABELS = {"Covid": "ARP COVID-19", "SA": "ARP SA", "DV": "ARP Supplemental", "ARP Unspecified": "ARP Unspecified"}
GRANT_TYPES = {
    "COVID-19 Testing Vaccines & Mobile Health": STREAM_TITLES["Covid"],
    "Sexual Assault Supplemental": STREAM_TITLES["SA"],
    "ARP Domestic Violence Supplemental": STREAM_TITLES["DV"],
}
NO_CATEGORY = ["None", "Other", "", "***Other"]
EXTERNAL, EXTERNAL_LABEL, EXTERNAL_TITLE = "CultSpec", "ARP Culturally Specific", "ARP Culturally Specific"

ENTITY = ["state", "name", "city"]
BASE = [
    "year", "state", "stream", "source", "name", "city", "shelter", "urban", "underserved", "oldc_match_shelter",
    "oldc_match_urban", "match_available", "state_dv", "ProgAcronym",
]


@dataclass(frozen=True)
class ArpBriefing:
    """Years, regions and programs the tables are about."""

    years: tuple[int, ...] = (2023, 2024)
    regions: tuple[str, ...] = tuple(forms.REGIONS)
    # The unspecified stream exists only in the years whose form allows it.
    unspecified_from: int = 2024
    types: Mapping[str, str] = field(default_factory=lambda: forms.TYPE_LEVELS)
    areas: Mapping[str, str] = field(default_factory=lambda: forms.AREA_LEVELS)
    programs: tuple[str, ...] = (forms.ARP, forms.TESTING, forms.ASSAULT, forms.CARES)
    # In this year only the first program was expected.
    single_program_year: int = 2023

    def streams(self, year: int) -> list[str]:
        return [s for s in STREAM_LABELS if s != "ARP Unspecified" or year >= self.unspecified_from]


def _coalition_names(coalitions: DataFrame) -> DataFrame:
    return coalitions.select("name", "name_formal", col("state_dv").cast("string").alias("state_dv"))


def _with_coalition(df: DataFrame, coalitions: DataFrame) -> DataFrame:
    """Formal names and the coalition type for rows whose name is a known coalition."""
    out = joins.lookup_left(df, _coalition_names(coalitions), ["name"])
    return out.withColumns(
        {
            "shelter": F.when(col("state_dv").isNotNull(), F.lit("Coalition")).otherwise(col("shelter")),
            "name": F.coalesce(col("name_formal"), col("name")),
        }
    ).drop("name_formal")


def spreadsheet_rows(rows: DataFrame, coalitions: DataFrame, categories: DataFrame, year: int) -> DataFrame:
    """Sub-awards sent in as spreadsheets for one year, with the population category from the lookup."""
    chosen = rows.where(col("year") == year).drop("cultspec")
    named = _with_coalition(chosen, coalitions).withColumn("state_dv", F.coalesce(col("state_dv"), F.lit("N/A")))
    dim = categories.select(col("SubAwdCultSpecf"), col("CultSpec2").alias("__category")).distinct()
    out = joins.lookup_left(named, dim, [("underserved", "SubAwdCultSpecf")], unique=False)
    out = out.withColumns({"underserved": col("__category"), "ProgAcronym": F.lit(forms.ARP)})
    return out.select(*cols(BASE))


def form_rows(subawards: DataFrame, coalitions: DataFrame, source: str = "oldc_24") -> DataFrame:
    """Sub-awards of the form, one row per funding stream."""
    rows = subawards.select(
        col(forms.YEAR).alias("year"), col(forms.STATE).alias("state"), col(forms.CITY).alias("city"),
        col(forms.NAME).alias("name"), col(forms.AREA).alias("urban"), col(forms.FUNDING_TYPE).alias("funding_type"),
        col(forms.TYPE).alias("shelter"), col(forms.CULT).alias("underserved"), "ProgAcronym",
    )
    named = _with_coalition(rows, coalitions)
    split = explode_delimited(named, "funding_type", "|")
    unknown = col("funding_type").isNull()
    rules = [(unknown & col("ProgAcronym").isin(p), stream) for stream, p in UNSPECIFIED.items()]
    stream = overwrite_when(recode(col("funding_type"), STREAM_OF_TYPE, default="null"), rules)
    blanks = {"oldc_match_shelter": None, "oldc_match_urban": None, "match_available": None}
    out = present.with_constants(split.withColumns({"stream": stream, "source": F.lit(source)}), blanks)
    return out.select(*cols(BASE))


def arp_subawards(parts: Sequence[DataFrame]) -> DataFrame:
    """Distinct named sub-awards of the ARP streams."""
    rows = present.stack(parts, {"year": "int"})
    return rows.where(col("stream").isin(list(STREAM_LABELS)) & col("name").isNotNull()).distinct()


def stream_entities(arp: DataFrame) -> DataFrame:
    """Each sub-awardee once per year and stream."""
    return arp.select("year", *ENTITY, "stream").distinct()


def stream_counts(arp: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """Sub-awardees per year and stream; read from a stored cube where there is one, as in the tables below."""
    if cube is not None:
        return cube.where(col("level") == BY_STREAM).select("year", "stream", "n")
    return rollup.count_by(stream_entities(arp), ["year", "stream"])


# Sub-award types that figures count.
KINDS = ["Shelter", "Non-shelter", "Coalition"]
# What a row of the cube counts: entities of a year and stream, also by region or by state (grouping ids).
BY_STREAM, BY_REGION, BY_STATE = 3, 1, 2


def entity_cube(arp: DataFrame, regions: DataFrame) -> DataFrame:
    """All counts the tables need, in one pass: ``level, year, stream, HHS Region, state, n`` and a column per type.

    ``n`` counts entities; a type's column counts entities of that type, each once per population category. Rows are
    folded per entity first, and the levels are grouping sets of the folded rows.
    """
    facts = arp.select("year", "stream", *ENTITY, "shelter", "underserved").distinct()
    kinds = [F.count_if(col("shelter") == k).alias(k) for k in KINDS]
    placed = with_region(facts.groupBy("year", "stream", *ENTITY).agg(*kinds), regions)
    sets = [["year", "stream"], ["year", "stream", "HHS Region"], ["year", "stream", "state"]]
    axes = ["year", "stream", "HHS Region", "state"]
    counts = placed.groupingSets([cols(s) for s in sets], *cols(axes)).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), *[F.sum(col(k)).alias(k) for k in KINDS]
    )
    return counts.select("level", *cols(axes), "n", *cols(KINDS))


def expected_subaward_reports(arp: DataFrame, regions: DataFrame, b: ArpBriefing) -> DataFrame:
    """Every state, year and seen program, and whether ARP sub-awards were listed under it."""
    # Read as the axis of programs and by the lookup; the sub-awards are read once.
    submitted = stage(arp.select(
        col("year").alias("Year"), col("state").alias("State Abb"), "ProgAcronym"
    ).distinct())
    grid = coverage.expand_grid(regions, {"Year": list(b.years)})
    grid = coverage.expand_observed(grid, submitted, "ProgAcronym").where(
        ~((col("Year") == b.single_program_year) & (col("ProgAcronym") != b.programs[0]))
    )
    out = joins.lookup_left(
        grid, submitted.withColumn("has_arp_subawardees", F.lit("Yes")), ["State Abb", "Year", "ProgAcronym"]
    )
    return out.withColumn("has_arp_subawardees", F.coalesce(col("has_arp_subawardees"), F.lit("No")))


def subaward_report_counts(expected: DataFrame) -> DataFrame:
    kept = hygiene.exclude_values(expected, "ProgAcronym", [forms.CORE])
    return rollup.count_by(kept, ["Year", "ProgAcronym", "has_arp_subawardees"])


def state_reports(wide: DataFrame, b: ArpBriefing) -> DataFrame:
    """Submissions of states under the briefing's programs."""
    named = wide.withColumn("Program Acronym", recode(col("Program Acronym"), {"FTC6": forms.TESTING}))
    return named.where(
        col("Year").isin(list(b.years)) & (col("Grant Type") == "State") & col("Program Acronym").isin(list(b.programs))
    )


def expected_status(expected: DataFrame, reports: DataFrame) -> DataFrame:
    """Expected reports with review status and completeness; empty reports count as complete."""
    status = reports.select(
        "State", "Year", col("Program Acronym").alias("__program"), "CodeTxt", "ppr_completeness"
    )
    out = joins.lookup_left(
        expected, status, [("State Abb", "State"), "Year", ("ProgAcronym", "__program")], unique=False
    )
    return out.withColumn(
        "ppr_completeness", status_label(col("ppr_completeness"), "Did Not Submit", {"Empty": "Complete"})
    )


def status_counts(status: DataFrame) -> DataFrame:
    kept = hygiene.exclude_values(status, "ProgAcronym", [forms.CARES, forms.CORE])
    return rollup.count_by(kept, ["Year", "ProgAcronym", "ppr_completeness"])


def states_under_program(arp: DataFrame, program: str = forms.CORE) -> DataFrame:
    """States that listed ARP sub-awards under another program."""
    return arp.where(col("ProgAcronym") == program).select("state").distinct()


def award_summary(arp: DataFrame, funding: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """Total funds per stream above the number of sub-awardees per year, as text."""
    titles = list(dict.fromkeys(STREAM_TITLES.values()))
    grants = funding.where((col("Grantee Type") == "State") & col("Grant Program Type").isin(list(GRANT_TYPES)))
    sums = rollup.sum_by(grants, ["Grant Program Type"], "Amount")
    money = sums.select(
        F.lit("Total funding to grant recipients").alias("Funding Metric"),
        recode(col("Grant Program Type"), GRANT_TYPES).alias("stream"), money_text(col("Amount")).alias("text"),
    )
    counts = stream_counts(arp, cube).select(
        F.concat(F.lit("Number of subawardees, FY"), col("year").cast("string")).alias("Funding Metric"),
        recode(col("stream"), STREAM_TITLES).alias("stream"), count_text(col("n")).alias("text"),
    )
    both = present.stack([money, counts])
    return pivot_fill(both, ["Funding Metric"], "stream", titles, "text", fill=None, how="value")


def _regions(regions: DataFrame) -> DataFrame:
    return regions.select(col("State Abb"), col("HHS Region"))


def with_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    return joins.lookup_left(df, _regions(regions), [("state", "State Abb")])


def _by_region(df: DataFrame, b: ArpBriefing, before: Sequence[str]) -> DataFrame:
    return present.order_by_levels(df, "HHS Region", [*b.regions, "Total"], before=before)


def region_by_stream(arp: DataFrame, regions: DataFrame, b: ArpBriefing, cube: DataFrame | None = None) -> DataFrame:
    """Sub-awardees per region and stream, each year closed by its total."""
    if cube is not None:
        cells = [F.sum(F.when(col("stream") == s, col("n")).otherwise(0)).alias(t) for s, t in STREAM_COLUMNS.items()]
        counts = cube.where(col("level") == BY_REGION).groupBy(*cols(["year", "HHS Region"])).agg(*cells)
    else:
        placed = with_region(stream_entities(arp), regions)
        counts = pivot_fill(placed, ["year", "HHS Region"], "stream", STREAM_COLUMNS)
    out = rollup.with_totals(counts, ["year"], "HHS Region", list(STREAM_COLUMNS.values()))
    return _by_region(out.drop("is_total"), b, ["year"])


def service_types(arp: DataFrame) -> DataFrame:
    """Sub-awardees by type and population, with the areas of each joined as one text."""
    return rollup.concat_distinct(
        arp, ["year", "stream", *ENTITY, "shelter", "underserved"], "urban", ", ", null_text="NA"
    )


def area_types(arp: DataFrame) -> DataFrame:
    """Sub-awardees by area and population, with the types of each joined as one text."""
    return rollup.concat_distinct(
        arp, ["year", "stream", *ENTITY, "urban", "underserved"], "shelter", ", ", null_text="NA"
    )


def _stream_table(
    arp: DataFrame, regions: DataFrame, category: str, names: Mapping[str, str], b: ArpBriefing
) -> DataFrame:
    """Per year and stream: regions by category, each entity once in the last column, totals on top."""
    title = recode(col("stream"), STREAM_TITLES)
    out = rollup.counts_with_distinct_total(
        with_region(arp, regions), ENTITY, ["year", "stream"], "HHS Region", category, names, "Region Total*", title
    )
    levels = [*STREAM_TITLES.values(), *b.regions]
    out = out.withColumn("__stream", present.level_rank(col("stream"), list(STREAM_TITLES)))
    ordered = present.order_by_levels(out, "HHS Region", levels, before=["year", "__stream"])
    return ordered.select(
        col("year").alias("Fiscal Year"), col("stream"), col("HHS Region").alias("Region"),
        *cols(names.values()), col("Region Total*"),
    )


def region_by_service(arp: DataFrame, regions: DataFrame, b: ArpBriefing) -> DataFrame:
    return _stream_table(arp, regions, "shelter", b.types, b)


def region_by_area(arp: DataFrame, regions: DataFrame, b: ArpBriefing) -> DataFrame:
    return _stream_table(arp, regions, "urban", b.areas, b)


def _in_year_streams(b: ArpBriefing) -> Column:
    """Streams each year can show in a figure."""
    rule = F.lit(False)
    for y in b.years:
        rule = rule | ((col("year") == y) & col("stream").isin(b.streams(y)))
    return rule


def type_counts(arp: DataFrame, regions: DataFrame, kind: str, b: ArpBriefing, cube: DataFrame | None = None) -> DataFrame:
    """Figure data: sub-awardees of one type per year, stream and region."""
    cube = entity_cube(arp, regions) if cube is None else cube
    counts = cube.where((col("level") == BY_REGION) & (col(kind) > 0) & _in_year_streams(b)).select(
        col("year"), recode(col("stream"), STREAM_LABELS).alias("stream"), col("HHS Region"), col(kind).alias("n")
    )
    return present.order_by_levels(counts, "HHS Region", list(b.regions), before=["year"], after=["stream"])


def coalition_counts(arp: DataFrame, regions: DataFrame, b: ArpBriefing, cube: DataFrame | None = None) -> DataFrame:
    """Figure data: coalitions per stream and region, 0 where none, for the streams of each year."""
    # Completed once per set of streams.
    cube = stage(entity_cube(arp, regions)) if cube is None else cube
    counts = type_counts(arp, regions, "Coalition", b, cube)
    years_of: dict[tuple[str, ...], list[int]] = {}
    for y in b.years:
        years_of.setdefault(tuple(STREAM_LABELS[s] for s in b.streams(y)), []).append(y)
    parts = [
        coverage.complete(
            counts.where(col("year").isin(years)),
            {"year": years, "stream": list(streams), "HHS Region": list(b.regions)},
            {"n": 0},
            unique=True,
        )
        for streams, years in years_of.items()
    ]
    return present.stack(parts)


def served_entities(arp: DataFrame, external: DataFrame, by_stream: bool = True, compat: bool = False) -> DataFrame:
    """Sub-awardees with their population categories as one text, plus the external list.

    A missing category is none at all; ``compat`` counts it as a category ``NA``.
    """
    by = ["year", "state", *(["stream"] if by_stream else []), "name", "city"]
    own = rollup.concat_distinct(
        arp, by, "underserved", "***", alias="cultspec", null_text="NA" if compat else None
    )
    listed = external.select(
        col("year").cast("int").alias("year"), "state", col("subawardee").alias("name"),
        F.lit(None).cast("string").alias("city"), F.lit("General").alias("cultspec"),
        *([F.lit(EXTERNAL).alias("stream")] if by_stream else []),
    )
    both = own.unionByName(listed.select(*cols(own.columns)))
    return both.where(not_in(col("cultspec"), NO_CATEGORY))


def served_by_stream(served: DataFrame) -> DataFrame:
    counts = rollup.count_by(served, ["year", "stream"], "Number of CS/US Subawardees")
    levels = ["Covid", "SA", "DV", "ARP Unspecified", EXTERNAL]
    ordered = present.order_by_levels(counts, "stream", levels, after=["year"])
    return ordered.select(
        col("year").alias("Fiscal Year"),
        recode(col("stream"), {**STREAM_TITLES, EXTERNAL: EXTERNAL_TITLE}).alias("Funding Source"),
        col("Number of CS/US Subawardees"),
    )


def served_unique(served: DataFrame) -> DataFrame:
    """The same per year only; ``served`` is built with ``by_stream=False``."""
    out = rollup.count_by(served, ["year"], "Number of CS/US Subawardees")
    return out.withColumnRenamed("year", "Fiscal Year").orderBy("Fiscal Year")


def served_by_region(served: DataFrame, regions: DataFrame, b: ArpBriefing) -> DataFrame:
    """Figure data: the same per region, stream and year, 0 where none."""
    labels = {**STREAM_LABELS, EXTERNAL: EXTERNAL_LABEL}
    counts = rollup.count_by(with_region(served, regions), ["year", "stream", "HHS Region"])
    counts = counts.withColumn("stream", recode(col("stream"), labels))
    axes = {"year": list(b.years), "stream": list(labels.values()), "HHS Region": list(b.regions)}
    inside = counts.where(
        col("year").isin(axes["year"]) & col("stream").isin(axes["stream"]) & col("HHS Region").isin(axes["HHS Region"])
    )
    return coverage.complete(inside, axes, {"n": 0}, unique=True)


def submission_matrix(
    arp: DataFrame, status: DataFrame, regions: DataFrame, overrides: DataFrame | None, b: ArpBriefing,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Sub-awardees per state, year and stream; 0 or that nothing was submitted where none.

    ``overrides`` holds corrections as (state, year, stream, n).
    """
    arp_programs = [forms.ARP, forms.TESTING, "ARP Unspecified", forms.ASSAULT]
    submitted = (
        status.where(col("ProgAcronym").isin(arp_programs) & (col("ppr_completeness") == "Complete"))
        .select(col("State Abb").alias("state"), col("Year").alias("year")).distinct()
        .withColumn("submitted_arp_ppr", F.lit("Yes"))
    )
    if cube is not None:
        counts = cube.where(col("level") == BY_STATE).select("year", "state", "stream", "n")
    else:
        counts = rollup.count_by(stream_entities(arp), ["year", "state", "stream"])
    grid = coverage.expand_grid(
        regions.select(col("State Abb").alias("state")), {"year": list(b.years), "stream": list(STREAM_TITLES)}
    )
    cells = joins.lookup_left(grid, counts, ["state", "year", "stream"])
    cells = joins.lookup_left(cells, submitted, ["state", "year"])
    cells = cells.withColumn("n", tri_state(col("n"), col("submitted_arp_ppr"))).drop("submitted_arp_ppr")
    if overrides is not None:
        cells = override_cells(cells, overrides, ["state", "year", "stream"], "n")
    named = cells.select(
        col("state").alias("State"), F.concat(F.lit("FY"), col("year").cast("string")).alias("FiscalYear"), "stream", "n"
    )
    wide = pivot_fill(named, ["State", "FiscalYear"], "stream", STREAM_TITLES, "n", fill=None, how="value")
    return wide.orderBy("FiscalYear", "State")


def _funded(df: DataFrame, ids: Sequence[str], levels: Mapping[str, str]) -> DataFrame:
    marked = df.withColumn("__status", F.lit("Funded"))
    return pivot_fill(marked, ids, "stream", levels, "__status", fill="Not Funded", how="value")


def coalition_matrix(arp: DataFrame, b: ArpBriefing) -> DataFrame:
    """Which coalitions each stream funded, per year."""
    rows = arp.where((col("shelter") == "Coalition") & col("year").isin(list(b.years))).select(
        col("name").alias("FVPSA ARP State/Territory Funded Statewide Coalition"), col("state").alias("State"),
        col("year").alias("Year"), "stream",
    )
    ids = rows.columns[:3]
    return _funded(rows, ids, STREAM_TITLES).orderBy("State", col(ids[0]), "Year")


def served_matrix(served: DataFrame) -> DataFrame:
    """Which streams funded each sub-awardee serving a population, and whether more than one did."""
    rows = served.where(col("stream") != EXTERNAL).select(
        col("state").alias("State"), col("city").alias("City"), "year", col("name").alias("Subawardee"), "stream"
    )
    names = {"Covid": "ARP Covid-19", "SA": "ARP SA", "DV": "ARP Supplemental", "ARP Unspecified": "ARP Unspecified"}
    wide = _funded(rows, ["State", "City", "year", "Subawardee"], names)
    flagged = wide.withColumn("Multi-Stream Funded", more_than([col(c) for c in names.values()], "Funded"))
    return flagged.orderBy("State", "Subawardee", "City", "year")


def organisation_amounts(external: DataFrame) -> DataFrame:
    """Listed organisations with their amounts and a total row, as money text."""
    rows = external.select(
        col("subawardee").alias("Organization"), col("state").alias("Location"), parse_amount(col("amount")).alias("__n")
    )
    total = rows.agg(F.sum("__n").cast("decimal(18,2)").alias("__n")).select(
        F.lit("Total funding").alias("Organization"), F.lit("").alias("Location"), col("__n")
    )
    both = rows.unionByName(total)
    return both.select("Organization", "Location", money_text(col("__n")).alias("Funding Amount"))


def run(
    parts: Sequence[DataFrame],
    lookups: Mapping[str, DataFrame],
    b: ArpBriefing,
    root: str,
    version: str,
    description: str,
    overrides: DataFrame | None = None,
) -> dict[str, str]:
    """The whole briefing as one version: the sub-awards are derived once, and counted once.

    ``lookups`` holds ``regions``, ``funding``, ``external`` and ``wide`` (the submissions, for their status).
    """
    base = stage(arp_subawards(parts))
    regions, external = lookups["regions"], lookups["external"]
    cube = stage(entity_cube(base, regions))
    expected = stage(expected_subaward_reports(base, regions, b))
    status = stage(expected_status(expected, state_reports(lookups["wide"], b)))
    served = stage(served_entities(base, external))
    tables = {
        "StreamCounts": stream_counts(base, cube),
        "ExpectedReports": expected,
        "ReportCounts": subaward_report_counts(expected),
        "Status": status,
        "StatusCounts": status_counts(status),
        "StatesUnderCore": states_under_program(base),
        "AwardSummary": award_summary(base, lookups["funding"], cube),
        "RegionByStream": region_by_stream(base, regions, b, cube),
        "RegionByService": region_by_service(base, regions, b),
        "RegionByArea": region_by_area(base, regions, b),
        "ShelterCounts": type_counts(base, regions, "Shelter", b, cube),
        "NonShelterCounts": type_counts(base, regions, "Non-shelter", b, cube),
        "CoalitionCounts": coalition_counts(base, regions, b, cube),
        "ServedByStream": served_by_stream(served),
        "ServedUnique": served_unique(served_entities(base, external, by_stream=False)),
        "ServedByRegion": served_by_region(served, regions, b),
        "SubmissionMatrix": submission_matrix(base, status, regions, overrides, b, cube),
        "CoalitionMatrix": coalition_matrix(base, b),
        "ServedMatrix": served_matrix(served),
        "OrganisationAmounts": organisation_amounts(external),
    }
    return publish(tables, root, "arp_briefing", version, description)
