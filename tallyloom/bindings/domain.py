"""Submission tables derived from the test tables.

Each derivation is one SQL text that Spark and DuckDB both read, with plain column names; the
Spark side then takes the headers of the forms. Customers are grantees or sub-awardees,
nations states, regions regions, order years fiscal years, line items sub-awards.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyloom.bindings.registry import table
from tallyloom.plans import forms

YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

FACTS = """
    lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
"""
_NAME = "CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN NULL ELSE c_name END"
_KIND = """CASE WHEN l_returnflag = 'A' THEN 'Shelter' WHEN l_returnflag = 'N' THEN 'Non-shelter'
           WHEN l_linestatus = 'F' THEN 'Other' ELSE 'Select' END"""
_AREA = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Urban' WHEN '2-HIGH' THEN 'Suburban' WHEN '3-MEDIUM' THEN 'Rural'
           WHEN '4-NOT SPECIFIED' THEN 'Frontier' ELSE 'Select' END"""
_PROGRAM = """CASE o_orderpriority WHEN '1-URGENT' THEN 'ARP Act' WHEN '2-HIGH' THEN 'ARP COVID-19 Testing Supplemental'
              WHEN '3-MEDIUM' THEN 'ARP Support Survivors of Sexual Assualt' WHEN '4-NOT SPECIFIED' THEN 'CARES Act'
              ELSE 'Core FVPSA' END"""

TEXTS = {
    # Sub-awards as the analysis set has them.
    "subawards": f"""
      SELECT CAST(year(o_orderdate) AS INT) AS fy, {_NAME} AS name, c_mktsegment AS city, n_name AS state, {_KIND} AS kind,
        {_AREA} AS area, CASE WHEN l_discount >= 0.09 THEN 'Group ' || l_returnflag ELSE '' END AS cult2,
        CASE WHEN l_tax = 0 AND l_linenumber = 1 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
        CASE o_orderstatus WHEN 'P' THEN 'ARP Act' ELSE 'Core FVPSA' END AS program,
        CASE l_linenumber WHEN 1 THEN 'ARP DV Supplemental' WHEN 2 THEN 'ARP Sexual Assault Supplemental | ARP DV Supplemental'
          WHEN 3 THEN 'ARP COVID-19 Testing Supplemental' WHEN 4 THEN 'FVPSA Core Annual Funding'
          WHEN 6 THEN 'ARP DV Supplemental|Disaster Assistance Supplemental' WHEN 7 THEN 'A type not known' END AS funding_type,
        {_PROGRAM} AS arp_program
      FROM {FACTS}""",
    "regions": "SELECT n_name AS state_abb, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "coalitions": """
      SELECT c_name AS data_name, 'Coalition of ' || c_name AS coalition, n_name AS state, c_acctbal > 9000 AS statewide_dv
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "funding": """
      SELECT 'ALLOTMENTS FFY ' || CAST(1995 + c_custkey % 7 AS STRING) AS grant_program,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'Tribe' ELSE 'State' END AS grantee_type,
        CASE c_custkey % 4 WHEN 0 THEN 'Sexual Assault Supplemental' WHEN 1 THEN 'COVID-19 Testing Vaccines & Mobile Health'
          WHEN 2 THEN 'ARP Domestic Violence Supplemental' ELSE 'Other' END AS grant_type,
        CAST(c_acctbal AS DECIMAL(18,2)) AS amount FROM customer""",
    "reports": f"""
      SELECT CAST(year(o_orderdate) AS INT) AS fy, n_name AS state, {_PROGRAM} AS program, max(o_orderstatus) AS code,
        CASE WHEN min(o_totalprice) < 20000 THEN 'Empty' ELSE 'Complete' END AS completeness
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY CAST(year(o_orderdate) AS INT), n_name, {_PROGRAM} HAVING max(o_totalprice) > 470000""",
    "spreadsheets": f"""
      SELECT CAST(year(o_orderdate) AS INT) AS fy, n_name AS state, CASE l_linenumber % 3 WHEN 0 THEN 'SA' WHEN 1 THEN 'DV' ELSE 'Covid' END AS stream,
        'sheet' AS source, {_NAME} AS name, c_mktsegment AS city, {_KIND} AS kind, {_AREA} AS area,
        CASE WHEN l_discount >= 0.05 THEN 'code ' || l_returnflag END AS served
      FROM {FACTS}""",
    "arp_coalitions": """
      SELECT c_name AS name, CASE WHEN c_acctbal > 9300 THEN 'Coalition of ' || c_name END AS name_formal, c_acctbal > 9600 AS state_dv
      FROM customer WHERE c_acctbal > 9000""",
    "external": """
      SELECT CAST(1995 + s_suppkey % 7 AS INT) AS fy, n_name AS state, s_name AS subawardee,
        CASE WHEN s_acctbal < 0 THEN '-' ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING) END AS amount
      FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "categories": """
      SELECT 'code A' AS served, 'Group A' AS cult2 UNION ALL SELECT 'code A', 'Group A' UNION ALL SELECT 'code N', 'Other'
      UNION ALL SELECT 'code R', ''""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

HEADERS: Mapping[str, Mapping[str, str]] = {
    "subawards": {
        "fy": forms.YEAR, "name": forms.NAME, "city": forms.CITY, "state": forms.STATE, "kind": forms.TYPE, "area": forms.AREA,
        "cult2": forms.CULT, "amount": forms.AMOUNT, "program": "ProgAcronym", "funding_type": forms.FUNDING_TYPE,
    },
    "regions": {"state_abb": "State Abb", "region": "HHS Region"},
    "coalitions": {},
    "funding": {
        "grant_program": "Grant Program", "grantee_type": "Grantee Type", "grant_type": "Grant Program Type", "amount": "Amount",
    },
    "reports": {
        "fy": "Year", "state": "State", "program": "Program Acronym", "code": "CodeTxt", "completeness": "ppr_completeness",
    },
    "spreadsheets": {"fy": "year", "kind": "shelter", "area": "urban", "served": "underserved"},
    "arp_coalitions": {},
    "external": {"fy": "year"},
    "categories": {"served": "SubAwdCultSpecf", "cult2": "CultSpec2"},
}


def derived(spark: SparkSession, d: str, name: str, text: str | None = None, headers: Mapping[str, str] | None = None) -> DataFrame:
    """One derived table under the headers of the forms."""
    sql = " ".join((text or TEXTS[name]).split()) + " "
    used = {}
    for t in TABLES:
        marked = sql.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
        if marked != sql:
            sql, used[t] = marked, table(spark, d, t)
    return spark.sql(sql, **used).withColumnsRenamed(dict(headers if headers is not None else HEADERS[name]))


def ctes(*names: str) -> str:
    """The same derivations as common table expressions for DuckDB."""
    return ", ".join(f"{n} AS ({TEXTS[n]})" for n in names)

