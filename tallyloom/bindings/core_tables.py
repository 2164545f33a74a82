"""Core briefing tables on submissions derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.domain import REGIONS, YEARS, ctes, derived
from tallyloom.bindings.registry import doubles, query
from tallyloom.plans import core_briefing as core
from tallyloom.plans.forms import AREA, CITY, CULT, NAME, STATE, TYPE, YEAR

BRIEFING = core.CoreBriefing(years=YEARS, regions=REGIONS)

BASE = f"""
  WITH {ctes("subawards", "regions", "coalitions")},
  core AS (
    SELECT fy, name, city, state, kind, area, cult2, sum(amount) AS funding FROM subawards
    WHERE program = 'Core FVPSA' AND name IS NOT NULL AND amount <> 0 GROUP BY ALL),
  placed AS (
    SELECT core.* EXCLUDE (kind), CASE WHEN c.coalition IS NOT NULL THEN 'Coalition' ELSE kind END AS kind, region, c.coalition
    FROM core LEFT JOIN regions ON state_abb = state
    LEFT JOIN (SELECT data_name, coalition FROM coalitions WHERE statewide_dv) c ON c.data_name = core.name),
  typed AS (SELECT fy, name, city, state, kind, region, coalition, sum(funding) AS funding FROM placed GROUP BY ALL)
"""
FY = "'FY' || right(CAST(fy AS VARCHAR), 2)"
WHOLE = "'$' || format('{:,.0f}', CAST(%s AS DOUBLE))"
SPREAD = ", ".join(f"max(v) FILTER (fy = {y}) AS \"FY{str(y)[-2:]}\"" for y in YEARS)
LABEL = "CASE kind WHEN 'Select' THEN 'Unspecified' ELSE kind END"


def core_rows(spark, d):
    return core.core_subawards([derived(spark, d, "subawards")], BRIEFING)


def placed(spark, d):
    return core.placed_subawards(core_rows(spark, d), derived(spark, d, "regions"), derived(spark, d, "coalitions"))


@query(
    "core_subawards",
    BASE + f"""SELECT fy AS "{YEAR}", name AS "{NAME}", city AS "{CITY}", state AS "{STATE}", kind AS "{TYPE}", area AS "{AREA}",
      cult2 AS "{CULT}", CAST(funding AS DOUBLE) AS funding FROM core""",
)
def core_subawards(spark, d):
    return doubles(core_rows(spark, d), "funding")


@query(
    "core_placed_subawards",
    BASE + f"""SELECT fy AS "{YEAR}", name AS "{NAME}", city AS "{CITY}", state AS "{STATE}", kind AS "{TYPE}", area AS "{AREA}",
      cult2 AS "{CULT}", CAST(funding AS DOUBLE) AS funding, region AS "Region", coalition FROM placed""",
)
def core_placed_subawards(spark, d):
    return doubles(placed(spark, d), "funding")


@query(
    "core_subawardees_per_year",
    BASE + f"""SELECT {FY} AS "Fiscal Year", count(*) AS "Total Subawardees" FROM (SELECT DISTINCT fy, name, city, state FROM core) GROUP BY fy""",
)
def subawardees_per_year(spark, d):
    return core.subawardees_per_year(core_rows(spark, d), BRIEFING)


@query(
    "core_funding_summary",
    BASE + f""", {ctes("funding")}, m AS (
      SELECT fy, 'Total Grant Recipient Funding to Subawardees' AS metric, {WHOLE % "sum(funding)"} AS v FROM core GROUP BY fy
      UNION ALL SELECT CAST(right(grant_program, 4) AS INT), 'Total Funding to Grant Recipients',
        CASE WHEN sum(amount) < 0 THEN '-' ELSE '' END || {WHOLE % "abs(sum(amount))"} FROM funding GROUP BY grant_program)
    SELECT metric AS "Funding Metric", {SPREAD} FROM m GROUP BY 1""",
)
def funding_summary(spark, d):
    allotments = {f"ALLOTMENTS FFY {y}": y for y in YEARS}
    return core.funding_summary(core_rows(spark, d), derived(spark, d, "funding"), allotments, BRIEFING)


def _regional(column: str, names: dict[str, str]) -> str:
    cells = ", ".join(f"count(DISTINCT (name, city, state)) FILTER ({column} = '{v}') AS \"{n}\"" for v, n in names.items())
    sums = ", ".join(f'CAST(sum("{n}") AS BIGINT)' for n in [*names.values(), "Regional Total*"])
    shown = ", ".join(f'"{n}"' for n in [*names.values(), "Regional Total*"])
    return BASE + f""", t AS (
      SELECT fy, region AS "Region", {cells}, count(DISTINCT (name, city, state)) AS "Regional Total*" FROM placed GROUP BY ALL)
    SELECT fy AS "{YEAR}", "Region", {shown} FROM t
    UNION ALL SELECT fy, {FY} || ' - Total', {sums} FROM t GROUP BY fy"""


@query("core_region_by_type", _regional("kind", dict(BRIEFING.types)))
def region_by_type(spark, d):
    return core.region_by_type(placed(spark, d), BRIEFING)


@query("core_region_by_area", _regional("area", dict(BRIEFING.areas)))
def region_by_area(spark, d):
    return core.region_by_area(placed(spark, d), BRIEFING)


@query(
    "core_type_totals",
    BASE + f"""SELECT {FY} AS "{YEAR}", {LABEL} AS shelter_type, count(*) AS totals FROM typed GROUP BY fy, kind""",
)
def type_totals(spark, d):
    return core.type_totals(placed(spark, d), BRIEFING)


@query(
    "core_funding_by_type",
    BASE + f"""SELECT kind AS "{TYPE}", fy AS "{YEAR}", CAST(sum(funding) AS DOUBLE) AS "Total Subawards" FROM typed GROUP BY ALL""",
)
def funding_by_type(spark, d):
    return doubles(core.funding_by_type(placed(spark, d), BRIEFING), "Total Subawards")


@query(
    "core_funding_by_type_table",
    BASE + f""", m AS (SELECT fy, {LABEL} AS t, {WHOLE % "sum(funding)"} AS v FROM typed GROUP BY fy, kind)
    SELECT t AS "{TYPE}", {SPREAD} FROM m GROUP BY 1""",
)
def funding_by_type_table(spark, d):
    return core.funding_by_type_table(placed(spark, d), BRIEFING)


@query(
    "core_mean_award",
    BASE + f"""SELECT fy AS "{YEAR}", CAST(sum(f) AS DOUBLE) / count(*) AS average_award FROM (
      SELECT fy, name, city, state, sum(funding) AS f FROM placed GROUP BY ALL) GROUP BY 1""",
)
def mean_award(spark, d):
    return core.mean_award(placed(spark, d), BRIEFING)


@query(
    "core_mean_award_by_type",
    BASE + f"""SELECT kind AS "{TYPE}", fy AS "{YEAR}", CAST(sum(funding) AS DOUBLE) / count(*) AS "Average Award" FROM typed GROUP BY ALL""",
)
def mean_award_by_type(spark, d):
    return core.mean_award_by_type(placed(spark, d), BRIEFING)


@query(
    "core_mean_award_by_type_table",
    BASE + f""", m AS (SELECT fy, {LABEL} AS t, '$' || format('{{:,.0f}}', CAST(sum(funding) AS DOUBLE) / count(*)) AS v FROM typed GROUP BY fy, kind)
    SELECT t AS "{TYPE}", {SPREAD} FROM m GROUP BY 1""",
)
def mean_award_by_type_table(spark, d):
    return core.mean_award_by_type_table(placed(spark, d), BRIEFING)


@query(
    "core_award_range",
    BASE + f"""SELECT fy AS "{YEAR}", {LABEL} AS "{TYPE}", {WHOLE % "min(funding)"} || ' - ' || {WHOLE % "max(funding)"} AS "Range of Funding"
      FROM typed GROUP BY fy, kind
    UNION ALL SELECT DISTINCT fy, {FY}, NULL FROM typed""",
)
def award_range(spark, d):
    return core.award_range(placed(spark, d), BRIEFING)


def _region_counts(kind: str) -> str:
    return BASE + f"""SELECT region AS "Region", {FY} AS "{YEAR}", count(*) AS "Total Subawardees" FROM typed
      WHERE kind = '{kind}' GROUP BY region, fy"""


@query("core_shelter_by_region", _region_counts("Shelter"))
def shelter_by_region(spark, d):
    return core.region_counts(placed(spark, d), "Shelter", BRIEFING)


@query("core_nonshelter_by_region", _region_counts("Non-shelter"))
def nonshelter_by_region(spark, d):
    return core.region_counts(placed(spark, d), "Non-shelter", BRIEFING)


@query("core_coalition_by_region", _region_counts("Coalition"))
def coalition_by_region(spark, d):
    return core.region_counts(placed(spark, d), "Coalition", BRIEFING)


def _extremes(kind: str, direction: str) -> str:
    return BASE + f"""SELECT state AS "{STATE}", kind AS "{TYPE}", fy AS "{YEAR}", count(*) AS "Total Subawardees",
        CAST(sum(funding) AS DOUBLE) / count(*) AS average_award
      FROM typed WHERE kind = '{kind}' GROUP BY state, kind, fy ORDER BY count(*) {direction}, state, fy LIMIT 10"""


def _mean_extremes(kind: str, direction: str) -> str:
    return BASE + f"""SELECT state AS "{STATE}", CAST(sum(n) AS DOUBLE) / count(*) AS avg_sub FROM (
        SELECT state, fy, count(*) AS n FROM typed WHERE kind = '{kind}' GROUP BY ALL)
      GROUP BY 1 ORDER BY avg_sub {direction}, 1 LIMIT 5"""


def _register_extremes() -> None:
    for kind, key in (("Shelter", "shelter"), ("Non-shelter", "nonshelter")):
        for largest, end, direction in ((True, "top", "DESC"), (False, "bottom", "ASC")):
            query(f"core_{key}_{end}_states", _extremes(kind, direction))(
                lambda spark, d, kind=kind, largest=largest: core.state_extremes(placed(spark, d), kind, 10, largest)
            )
            query(f"core_{key}_{end}_means", _mean_extremes(kind, direction))(
                lambda spark, d, kind=kind, largest=largest: core.state_mean_extremes(placed(spark, d), kind, 5, largest)
            )


_register_extremes()

SERVED = BASE + ", served AS (SELECT fy, name, city, state, region, sum(funding) AS funding FROM placed WHERE cult2 <> '' GROUP BY ALL) "


@query(
    "core_served_totals",
    SERVED + f"""SELECT {FY} AS "Fiscal Year", count(*) AS "Number of CS/US Subawardees", {WHOLE % "sum(funding)"} AS "Funding Amount"
      FROM served GROUP BY fy""",
)
def served_totals(spark, d):
    return core.served_totals(placed(spark, d), BRIEFING)


@query(
    "core_served_states",
    SERVED + f"""SELECT state AS "{STATE}", (SELECT count(DISTINCT state) FROM served) AS "sum" FROM served GROUP BY state""",
)
def served_states(spark, d):
    return core.served_states(placed(spark, d))


@query(
    "core_served_share",
    BASE + f"""SELECT state AS "{STATE}", count(*) AS number, count(*) FILTER (cult2 <> '') AS num_cult,
      CAST(count(*) FILTER (cult2 <> '') AS DOUBLE) / count(*) AS percent FROM placed GROUP BY state""",
)
def served_share(spark, d):
    return core.served_share(placed(spark, d))


@query(
    "core_served_by_region",
    SERVED + f"""SELECT region AS "Region", {FY} AS "{YEAR}", count(*) AS "Total Subawardees" FROM served GROUP BY region, fy""",
)
def served_by_region(spark, d):
    return core.served_by_region(placed(spark, d), BRIEFING)


@query(
    "core_funded_matrix",
    SERVED + f""", m AS (SELECT CASE name WHEN 'Customer#000000001' THEN 'Customer#000000002' ELSE name END AS "Subawardee",
        city AS "City", state AS "State", fy, 'Funded' AS v FROM served)
    SELECT "Subawardee", "City", "State", {", ".join(f"coalesce(max(v) FILTER (fy = {y}), '') AS " + f'"FY{str(y)[-2:]}"' for y in YEARS)}
    FROM m GROUP BY ALL""",
)
def funded_matrix(spark, d):
    return core.funded_matrix(placed(spark, d), BRIEFING, {"Customer#000000001": "Customer#000000002"})


@query(
    "core_coalition_amounts",
    BASE + f""", m AS (SELECT coalition, fy, {WHOLE % "sum(funding)"} AS v FROM typed WHERE kind = 'Coalition' GROUP BY ALL)
    SELECT coalition AS "FVPSA State/Territory Funded Statewide Domestic Violence Coalition",
      {", ".join(f"coalesce(max(v) FILTER (fy = {y}), '$0') AS " + f'"FY{str(y)[-2:]}"' for y in YEARS)} FROM m GROUP BY 1""",
)
def coalition_amounts(spark, d):
    return core.coalition_amounts(placed(spark, d), BRIEFING)


@query(
    "core_submission_status",
    f"""WITH {ctes("coalitions", "reports")}
    SELECT s.state AS "State", CAST(y AS VARCHAR) AS "Year", coalesce(completeness, 'Did not submit') AS ppr_completeness
    FROM (SELECT DISTINCT state FROM coalitions WHERE statewide_dv) s, unnest({list(YEARS)}) AS a(y)
    LEFT JOIN reports r ON r.state = s.state AND r.fy = y AND r.program = 'Core FVPSA'""",
)
def submission_status(spark, d):
    reports = derived(spark, d, "reports").withColumn("Grant Type", F.lit("State"))
    return core.submission_status(derived(spark, d, "coalitions"), reports, BRIEFING)
