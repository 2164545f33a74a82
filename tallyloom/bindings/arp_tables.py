"""ARP briefing tables on submissions derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.domain import HEADERS, REGIONS, TEXTS, YEARS, ctes, derived
from tallyloom.bindings.registry import query
from tallyloom.plans import arp_briefing as arp
from tallyloom.sources.staging import stage
from tallyloom.sources.tables import literal_table

SHEET_YEAR, FORM_YEARS = YEARS[0], YEARS[1:]
BRIEFING = arp.ArpBriefing(
    years=YEARS, regions=REGIONS, unspecified_from=FORM_YEARS[0], single_program_year=SHEET_YEAR,
)
TITLES = arp.STREAM_TITLES
STREAMS = list(TITLES)


def titled(column: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {cases} ELSE {column} END"


def spread(mapping: dict[str, str], value: str, fill: str | None = None) -> str:
    def cell(k: str) -> str:
        inner = f"max({value}) FILTER (stream = '{k}')"
        return inner if fill is None else f"coalesce({inner}, '{fill}')"

    return ", ".join(f'{cell(k)} AS "{v}"' for k, v in mapping.items())


BASE = f"""
  WITH {ctes("subawards", "regions", "reports", "spreadsheets", "arp_coalitions", "external", "categories", "funding")},
  sheet AS (
    SELECT fy AS year, s.state, stream, source, CASE WHEN name_formal IS NOT NULL THEN name_formal ELSE s.name END AS name, city,
      CASE WHEN state_dv IS NOT NULL THEN 'Coalition' ELSE kind END AS shelter, area AS urban, cult2 AS underserved,
      coalesce(CAST(state_dv AS VARCHAR), 'N/A') AS state_dv, 'ARP Act' AS program
    FROM spreadsheets s LEFT JOIN arp_coalitions c ON c.name = s.name
    LEFT JOIN (SELECT DISTINCT * FROM categories) k ON k.served = s.served WHERE fy = {SHEET_YEAR}),
  parts AS (
    SELECT * FROM subawards, unnest(string_split(funding_type, '|')) AS t(part) WHERE funding_type IS NOT NULL
    UNION ALL SELECT *, NULL FROM subawards WHERE funding_type IS NULL),
  form AS (
    SELECT fy AS year, p.state, CASE
        WHEN part IS NULL AND arp_program IN ('ARP Act', 'ARP COVID-19 Testing Supplemental', 'ARP Support Survivors of Sexual Assualt') THEN 'ARP Unspecified'
        WHEN part IS NULL AND arp_program = 'Core FVPSA' THEN 'Core Unspecified'
        WHEN part IS NULL AND arp_program = 'CARES Act' THEN 'CARES Unspecified'
        ELSE CASE trim(part) WHEN 'ARP Sexual Assault Supplemental' THEN 'SA' WHEN 'ARP DV Supplemental' THEN 'DV'
          WHEN 'ARP COVID-19 Testing Supplemental' THEN 'Covid' WHEN 'FVPSA Core Annual Funding' THEN 'Core'
          WHEN 'Disaster Assistance Supplemental' THEN 'Disaster' END END AS stream,
      'oldc_24' AS source, CASE WHEN name_formal IS NOT NULL THEN name_formal ELSE p.name END AS name, city,
      CASE WHEN state_dv IS NOT NULL THEN 'Coalition' ELSE kind END AS shelter, area AS urban, cult2 AS underserved,
      CAST(state_dv AS VARCHAR) AS state_dv, arp_program AS program
    FROM parts p LEFT JOIN arp_coalitions c ON c.name = p.name WHERE fy > {SHEET_YEAR}),
  arp AS (
    SELECT DISTINCT * FROM (SELECT * FROM sheet UNION ALL SELECT * FROM form)
    WHERE stream IN ('DV', 'SA', 'Covid', 'ARP Unspecified') AND name IS NOT NULL),
  ents AS (SELECT DISTINCT year, state, stream, name, city FROM arp),
  years AS (SELECT CAST(y AS INT) AS year FROM unnest({list(YEARS)}) AS a(y)),
  expected AS (
    SELECT r.state_abb, r.region, y.year, p.program, CASE WHEN s.state IS NULL THEN 'No' ELSE 'Yes' END AS has
    FROM regions r, years y, (SELECT DISTINCT program FROM arp) p
    LEFT JOIN (SELECT DISTINCT year, state, program FROM arp) s ON s.state = r.state_abb AND s.year = y.year AND s.program = p.program
    WHERE NOT (y.year = {SHEET_YEAR} AND p.program <> 'ARP Act')),
  status AS (
    SELECT e.*, code, CASE WHEN completeness IS NULL THEN 'Did Not Submit' WHEN completeness = 'Empty' THEN 'Complete' ELSE completeness END AS completeness
    FROM expected e LEFT JOIN (SELECT * FROM reports WHERE program <> 'Core FVPSA') r
      ON r.state = e.state_abb AND r.fy = e.year AND r.program = e.program)
"""
SERVED = BASE + """, served AS (
    SELECT * FROM (
      SELECT year, state, stream, name, city, string_agg(u, '***' ORDER BY u) AS cultspec
      FROM (SELECT DISTINCT year, state, stream, name, city, underserved AS u FROM arp WHERE underserved IS NOT NULL) GROUP BY ALL
      UNION ALL SELECT fy, state, 'CultSpec', subawardee, NULL, 'General' FROM external)
    WHERE cultspec NOT IN ('None', 'Other', '', '***Other')) """


def arp_rows(spark, d):
    sheet = arp.spreadsheet_rows(
        derived(spark, d, "spreadsheets").selectExpr(
            "*", "'x' AS cultspec", "CAST(NULL AS STRING) AS oldc_match_shelter", "CAST(NULL AS STRING) AS oldc_match_urban",
            "CAST(NULL AS STRING) AS match_available",
        ),
        derived(spark, d, "arp_coalitions"), derived(spark, d, "categories"), SHEET_YEAR,
    )
    text = TEXTS["subawards"] + f" WHERE year(o_orderdate) > {SHEET_YEAR}"
    headers = {**HEADERS["subawards"], "arp_program": "ProgAcronym"}
    headers.pop("program")
    rows = derived(spark, d, "subawards", text, headers)
    form = arp.form_rows(rows, derived(spark, d, "arp_coalitions"))
    return arp.arp_subawards([sheet, form])


def regions(spark, d):
    return derived(spark, d, "regions")


def reports(spark, d):
    return arp.state_reports(derived(spark, d, "reports").withColumn("Grant Type", F.lit("State")), BRIEFING)


def served(spark, d, by_stream: bool = True):
    return arp.served_entities(arp_rows(spark, d), derived(spark, d, "external"), by_stream)


@query("arp_subawards", BASE + "SELECT year, state, stream, source, name, city, shelter, urban, underserved, state_dv, program AS \"ProgAcronym\" FROM arp")
def arp_subawards(spark, d):
    return arp_rows(spark, d).drop("oldc_match_shelter", "oldc_match_urban", "match_available")


@query("arp_stream_counts", BASE + "SELECT year, stream, count(*) AS n FROM ents GROUP BY ALL")
def stream_counts(spark, d):
    return arp.stream_counts(arp_rows(spark, d))


@query(
    "arp_expected_subaward_reports",
    BASE + 'SELECT state_abb AS "State Abb", region AS "HHS Region", year AS "Year", program AS "ProgAcronym", has AS has_arp_subawardees FROM expected',
)
def expected_subaward_reports(spark, d):
    return arp.expected_subaward_reports(arp_rows(spark, d), regions(spark, d), BRIEFING)


def status_of(spark, d, rows):
    return arp.expected_status(arp.expected_subaward_reports(rows, regions(spark, d), BRIEFING), stage(reports(spark, d)))


@query(
    "arp_subaward_report_counts",
    BASE + """SELECT year AS "Year", program AS "ProgAcronym", has AS has_arp_subawardees, count(*) AS n FROM expected
      WHERE program <> 'Core FVPSA' GROUP BY ALL""",
)
def subaward_report_counts(spark, d):
    return arp.subaward_report_counts(expected_subaward_reports(spark, d))


@query(
    "arp_expected_status",
    BASE + """SELECT state_abb AS "State Abb", region AS "HHS Region", year AS "Year", program AS "ProgAcronym", has AS has_arp_subawardees,
      code AS "CodeTxt", completeness AS ppr_completeness FROM status""",
)
def expected_status(spark, d):
    return status_of(spark, d, arp_rows(spark, d))


@query(
    "arp_status_counts",
    BASE + """SELECT year AS "Year", program AS "ProgAcronym", completeness AS ppr_completeness, count(*) AS n FROM status
      WHERE program NOT IN ('CARES Act', 'Core FVPSA') GROUP BY ALL""",
)
def status_counts(spark, d):
    return arp.status_counts(expected_status(spark, d))


@query("arp_states_under_core", BASE + "SELECT DISTINCT state FROM arp WHERE program = 'Core FVPSA'")
def states_under_core(spark, d):
    return arp.states_under_program(arp_rows(spark, d))


@query(
    "arp_award_summary",
    BASE + f""", m AS (
      SELECT 'Total funding to grant recipients' AS metric, CASE grant_type WHEN 'Sexual Assault Supplemental' THEN 'SA'
          WHEN 'ARP Domestic Violence Supplemental' THEN 'DV' ELSE 'Covid' END AS stream, '$' || format('{{:,.0f}}', CAST(sum(amount) AS DOUBLE)) AS v
        FROM funding WHERE grantee_type = 'State' AND grant_type <> 'Other' GROUP BY grant_type
      UNION ALL SELECT 'Number of subawardees, FY' || CAST(year AS VARCHAR), stream, format('{{:,}}', count(*)) FROM ents GROUP BY year, stream)
    SELECT metric AS "Funding Metric", {spread(TITLES, "v")} FROM m GROUP BY 1""",
)
def award_summary(spark, d):
    return arp.award_summary(arp_rows(spark, d), derived(spark, d, "funding"))


@query(
    "arp_region_by_stream",
    BASE + f""", t AS (SELECT year, region, {", ".join(f"count(*) FILTER (stream = '{k}') AS " + f'"{v}"' for k, v in arp.STREAM_COLUMNS.items())}
      FROM ents LEFT JOIN regions ON state_abb = state GROUP BY ALL)
    SELECT year, region AS "HHS Region", {", ".join(f'"{v}"' for v in arp.STREAM_COLUMNS.values())} FROM t
    UNION ALL SELECT year, 'Total', {", ".join(f'CAST(sum("{v}") AS BIGINT)' for v in arp.STREAM_COLUMNS.values())} FROM t GROUP BY year""",
)
def region_by_stream(spark, d):
    return arp.region_by_stream(arp_rows(spark, d), regions(spark, d), BRIEFING)


def _concat(kept: str, joined: str) -> str:
    return BASE + f"""SELECT year, stream, state, name, city, {kept}, underserved, string_agg(x, ', ' ORDER BY x) AS {joined}
      FROM (SELECT DISTINCT year, stream, state, name, city, {kept}, underserved, coalesce({joined}, 'NA') AS x FROM arp) GROUP BY ALL"""


@query("arp_service_types", _concat("shelter", "urban"))
def service_types(spark, d):
    return arp.service_types(arp_rows(spark, d))


@query("arp_area_types", _concat("urban", "shelter"))
def area_types(spark, d):
    return arp.area_types(arp_rows(spark, d))


def _stream_table(column: str, names: dict[str, str]) -> str:
    who = "(name, city, state)"
    cells = ", ".join(f"count(DISTINCT {who}) FILTER ({column} = '{k}') AS \"{v}\"" for k, v in names.items())
    shown = [*names.values(), "Region Total*"]
    return BASE + f""", t AS (SELECT year, stream, region, {cells}, count(DISTINCT {who}) AS "Region Total*"
      FROM arp LEFT JOIN regions ON state_abb = state GROUP BY year, stream, region)
    SELECT year AS "Fiscal Year", stream, region AS "Region", {", ".join(f'"{n}"' for n in shown)} FROM t
    UNION ALL SELECT year, stream, {titled("stream", TITLES)}, {", ".join(f'CAST(sum("{n}") AS BIGINT)' for n in shown)} FROM t GROUP BY year, stream"""


@query("arp_region_by_service", _stream_table("shelter", dict(BRIEFING.types)))
def region_by_service(spark, d):
    return arp.region_by_service(arp_rows(spark, d), regions(spark, d), BRIEFING)


@query("arp_region_by_area", _stream_table("urban", dict(BRIEFING.areas)))
def region_by_area(spark, d):
    return arp.region_by_area(arp_rows(spark, d), regions(spark, d), BRIEFING)


def _type_counts(kind: str) -> str:
    return f"""SELECT year, {titled("stream", arp.STREAM_LABELS)} AS stream, region AS "HHS Region", count(*) AS n
      FROM (SELECT DISTINCT year, stream, state, name, city, shelter, underserved FROM arp
            WHERE shelter = '{kind}' AND NOT (year < {FORM_YEARS[0]} AND stream = 'ARP Unspecified'))
      LEFT JOIN regions ON state_abb = state GROUP BY year, stream, region"""


@query("arp_shelter_counts", BASE + _type_counts("Shelter"))
def shelter_counts(spark, d):
    return arp.type_counts(arp_rows(spark, d), regions(spark, d), "Shelter", BRIEFING)


@query("arp_nonshelter_counts", BASE + _type_counts("Non-shelter"))
def nonshelter_counts(spark, d):
    return arp.type_counts(arp_rows(spark, d), regions(spark, d), "Non-shelter", BRIEFING)


@query(
    "arp_coalition_counts",
    BASE + f""", seen AS ({_type_counts("Coalition")}),
    grid AS (SELECT year, s AS stream, r AS "HHS Region" FROM years, unnest({list(arp.STREAM_LABELS.values())}) AS a(s), unnest({list(REGIONS)}) AS b(r)
      WHERE NOT (year < {FORM_YEARS[0]} AND s = 'ARP Unspecified'))
    SELECT year, stream, "HHS Region", coalesce(n, 0) AS n FROM grid FULL JOIN seen USING (year, stream, "HHS Region")""",
)
def coalition_counts(spark, d):
    return arp.coalition_counts(arp_rows(spark, d), regions(spark, d), BRIEFING)


@query("arp_served_entities", SERVED + "SELECT year, state, stream, name, city, cultspec FROM served")
def served_entities(spark, d):
    return served(spark, d)


@query(
    "arp_served_by_stream",
    SERVED + f"""SELECT year AS "Fiscal Year", {titled("stream", {**TITLES, arp.EXTERNAL: arp.EXTERNAL_TITLE})} AS "Funding Source",
      count(*) AS "Number of CS/US Subawardees" FROM served GROUP BY year, stream""",
)
def served_by_stream(spark, d):
    return arp.served_by_stream(served(spark, d))


@query(
    "arp_served_unique",
    SERVED.replace("state, stream, name", "state, name").replace("state, 'CultSpec', subawardee", "state, subawardee")
    + """SELECT year AS "Fiscal Year", count(*) AS "Number of CS/US Subawardees" FROM served GROUP BY year""",
)
def served_unique(spark, d):
    return arp.served_unique(served(spark, d, by_stream=False))


@query(
    "arp_served_by_region",
    SERVED + f""", seen AS (SELECT year, {titled("stream", {**arp.STREAM_LABELS, arp.EXTERNAL: arp.EXTERNAL_LABEL})} AS stream, region AS "HHS Region",
        count(*) AS n FROM served LEFT JOIN regions ON state_abb = state GROUP BY ALL),
    grid AS (SELECT year, s AS stream, r AS "HHS Region" FROM years, unnest({[*arp.STREAM_LABELS.values(), arp.EXTERNAL_LABEL]}) AS a(s), unnest({list(REGIONS)}) AS b(r))
    SELECT year, stream, "HHS Region", coalesce(n, 0) AS n FROM grid LEFT JOIN seen USING (year, stream, "HHS Region")""",
)
def served_by_region(spark, d):
    return arp.served_by_region(served(spark, d), regions(spark, d), BRIEFING)


@query(
    "arp_submission_matrix",
    BASE + f""", cells AS (
      SELECT r.state_abb AS state, y.year, s AS stream, CASE WHEN r.state_abb = 'NATION_3' AND y.year = 2000 AND s = 'ARP Unspecified' THEN '0'
        WHEN u.state IS NULL AND n IS NULL THEN 'Did Not Submit' WHEN n IS NULL THEN '0' ELSE CAST(n AS VARCHAR) END AS v
      FROM regions r CROSS JOIN years y CROSS JOIN unnest({STREAMS}) AS a(s)
      LEFT JOIN (SELECT year, state, stream, count(*) AS n FROM ents GROUP BY ALL) c ON c.state = r.state_abb AND c.year = y.year AND c.stream = s
      LEFT JOIN (SELECT DISTINCT state_abb AS state, year FROM status WHERE completeness = 'Complete'
        AND program IN ('ARP Act', 'ARP COVID-19 Testing Supplemental', 'ARP Support Survivors of Sexual Assualt')) u
        ON u.state = r.state_abb AND u.year = y.year)
    SELECT state AS "State", 'FY' || CAST(year AS VARCHAR) AS "FiscalYear", {spread(TITLES, "v")} FROM cells GROUP BY ALL""",
)
def submission_matrix(spark, d):
    fixes = literal_table(
        spark, {"state": "string", "year": "int", "stream": "string", "n": "string"},
        [("NATION_3", 2000, "ARP Unspecified", "0")],
    )
    # Read by the counts and, twice, by the expectations: written once, with what they need.
    rows = stage(arp_rows(spark, d).select("year", *arp.ENTITY, "stream", "ProgAcronym").distinct())
    return arp.submission_matrix(rows, status_of(spark, d, rows), regions(spark, d), fixes, BRIEFING)


@query(
    "arp_coalition_matrix",
    BASE + f"""SELECT name AS "FVPSA ARP State/Territory Funded Statewide Coalition", state AS "State", year AS "Year",
      {spread(TITLES, "'Funded'", "Not Funded")} FROM arp WHERE shelter = 'Coalition' GROUP BY ALL""",
)
def coalition_matrix(spark, d):
    return arp.coalition_matrix(arp_rows(spark, d), BRIEFING)


_MATRIX = {"Covid": "ARP Covid-19", "SA": "ARP SA", "DV": "ARP Supplemental", "ARP Unspecified": "ARP Unspecified"}


@query(
    "arp_served_matrix",
    SERVED + f"""SELECT state AS "State", city AS "City", year, name AS "Subawardee", {spread(_MATRIX, "'Funded'", "Not Funded")},
      CASE WHEN count(DISTINCT stream) > 1 THEN 'Yes' ELSE 'No' END AS "Multi-Stream Funded"
    FROM served WHERE stream <> 'CultSpec' GROUP BY state, city, year, name""",
)
def served_matrix(spark, d):
    return arp.served_matrix(served(spark, d))


@query(
    "arp_organisation_amounts",
    f"""WITH {ctes("external")}, x AS (
      SELECT subawardee, state, CASE amount WHEN '-' THEN 0 ELSE CAST(amount AS DECIMAL(18,2)) END AS n FROM external
      UNION ALL SELECT 'Total funding', '', sum(CASE amount WHEN '-' THEN 0 ELSE CAST(amount AS DECIMAL(18,2)) END) FROM external)
    SELECT subawardee AS "Organization", state AS "Location", '$' || format('{{:,.0f}}', CAST(n AS DOUBLE)) AS "Funding Amount" FROM x""",
)
def organisation_amounts(spark, d):
    return arp.organisation_amounts(derived(spark, d, "external"))
