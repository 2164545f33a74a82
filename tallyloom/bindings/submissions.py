"""The cleaning jobs on screens derived from the test tables: one submission per order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyloom.bindings.domain import FACTS, YEARS, derived
from tallyloom.bindings.registry import doubles, query
from tallyloom.operators.present import with_constants
from tallyloom.plans import analysis_set, coalitions, formula, forms
from tallyloom.plans.forms import AMOUNT, CITY, NAME, SERVED, TYPE_RAW
from tallyloom.sources.publish import publish_periods, read_history
from tallyloom.sources.staging import stage, staging_folder
from tallyloom.sources.tables import literal_table, overwrite_periods

ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
KEYS = """
  CAST(year(o_orderdate) AS INT) AS fy, '[1 ' || lpad(CAST(c_custkey AS STRING), 9, '0') || ' A1]' AS rpt_ein,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE c_name || ' &amp; Co ' || CAST(o_orderkey % 3 AS STRING) END AS grantee,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'State' WHEN 'MACHINERY' THEN 'Territory' WHEN 'FURNITURE' THEN 'Other' ELSE 'Tribe' END AS kind,
  n_name AS postal,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'FVPS' WHEN '2-HIGH' THEN 'FVC6' WHEN '3-MEDIUM' THEN 'FVC3' ELSE 'FTC6' END AS program,
  CASE o_orderstatus WHEN 'F' THEN 'Submitted' WHEN 'O' THEN 'Submission Accepted by CO' ELSE 'Submission Returned by CO' END AS code,
  o_orderkey AS rev, 'R' || CAST(o_orderkey AS STRING) AS receipt, o_orderkey AS row_ix
"""
GROUPS = [f"{p} {g}" for p in forms.CLIENT_PREFIXES for g in forms.CLIENT_GROUPS]
CLIENTS = [f"Clients {i}" for i in range(len(GROUPS))]
OUTCOMES = [
    f"{f}{s} R{i}" for i in (1, 2) for s in ("", " SAFETY") for f in ("NUMBER OF SURVEYS", "NUMBER OF YES RESPONSES", "PERCENTAGE")
]
N_METRICS = len(CLIENTS) + len(OUTCOMES)
_METRICS = ", ".join(
    f"CASE WHEN (CAST(floor(o_totalprice) AS BIGINT) + {i}) % 5 = 0 THEN NULL ELSE (CAST(floor(o_totalprice) AS BIGINT) + {i}) % 97 END AS m{i}"
    for i in range(N_METRICS)
)
COVER = f"SELECT {KEYS}, CAST(o_orderdate AS DATE) AS submitted FROM {ORDERS}"
METRICS = f"SELECT {KEYS}, {_METRICS}, 'said &quot;' || o_orderpriority || '&quot;' AS comment FROM {ORDERS}"
LINES = f"""
  SELECT {KEYS}, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, 'Sub &amp; ' || CAST(l_suppkey AS STRING) AS sub_name, c_mktsegment AS city,
    CASE WHEN l_returnflag = 'A' THEN 'shelter' WHEN l_returnflag = 'N' THEN 'Non-shelter' END AS sub_kind,
    CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount, 'code ' || l_returnflag AS served
  FROM {FACTS}"""
HEADERS = {
    "fy": "Fy", "rpt_ein": "RptEin", "grantee": "GranteeName", "kind": "GranteeTypeTxt", "postal": "PostalCode", "program": "ProgAcronym",
    "code": "CodeTxt", "rev": "RevSeqNumber", "receipt": "Rpt-Receipt-Id", "submitted": "SubmitDate",
    "comment": "Any comments, please?.1", "sub_name": NAME, "city": CITY, "sub_kind": TYPE_RAW, "amount": AMOUNT, "served": SERVED,
    **{f"m{i}": n for i, n in enumerate([*CLIENTS, *OUTCOMES])},
}
FORM = forms.StateForm(
    keys=("Fy", "RptEin", "GranteeName", "GranteeTypeTxt", "PostalCode", "ProgAcronym", "CodeTxt", "RevSeqNumber", "Rpt-Receipt-Id"),
    name_floor=2000,
    repairs={"Any comments, please?": ["Any comments, please?"]},
)
# The later form leaves the header as it came and maps it to the lookup instead.
FORM_V8 = forms.StateForm(
    keys=FORM.keys, name_floor=2000, question_names={"Any comments, please?.1": "ANY COMMENTS, PLEASE?...50"}
)
ROSTER = [f"NATION_{i}" for i in range(25)] + ["NATION_99"]
LABELS = [*GROUPS, "Comments", "Shelter Funds", "Other Funds"]

CLEAN = f"""
  WITH cover AS ({COVER}), metrics AS ({METRICS}), lines AS ({LINES}),
  names AS (SELECT rpt_ein, arg_min(grantee, row_ix) FILTER (grantee IS NOT NULL) AS grantee FROM cover GROUP BY 1),
  subs AS (
    SELECT c.* EXCLUDE (grantee, kind), replace(n.grantee, '&amp;', '&') AS grantee, CASE kind WHEN 'Territory' THEN 'State' ELSE kind END AS kind,
      '1' || substr(rpt_ein, 4, 9) || 'A1' AS ein FROM cover c JOIN names n USING (rpt_ein)),
  latest AS (SELECT * FROM subs WHERE code <> 'Submission Returned by CO' QUALIFY rev = max(rev) OVER (PARTITION BY fy, ein, program)),
  states AS (SELECT * FROM latest WHERE kind = 'State' QUALIFY submitted = max(submitted) OVER (PARTITION BY postal, fy, program)),
  resolved AS (
    SELECT r.*, {", ".join(f"m{i}" for i in range(N_METRICS))}, replace(comment, '&quot;', '"') AS comment
    FROM (SELECT * FROM states UNION ALL SELECT * FROM latest WHERE kind = 'Tribe') r JOIN metrics m ON m.receipt = r.receipt),
  awards AS (SELECT l.*, CASE served WHEN 'code A' THEN 'Group A' WHEN 'code N' THEN 'Other' END AS cult2, replace(sub_name, '&amp;', '&') AS sub
    FROM lines l WHERE receipt IN (SELECT receipt FROM resolved WHERE kind = 'State')),
  totals AS (SELECT fy, postal, program, coalesce(sum(amount) FILTER (sub_kind = 'shelter'), 0) AS shelter,
      coalesce(sum(amount) FILTER (sub_kind IS DISTINCT FROM 'shelter'), 0) AS other
    FROM awards WHERE CASE kind WHEN 'Territory' THEN 'State' ELSE kind END = 'State' GROUP BY ALL),
  rows AS (SELECT r.*, t.shelter, t.other FROM resolved r LEFT JOIN totals t
    ON r.kind IN ('State', 'Tribe') AND t.fy = r.fy AND t.postal = r.postal AND t.program = r.program),
  elements AS (
    {" UNION ALL ".join(f"SELECT fy, kind, program, postal, ein, 'C{i}' AS element, 'q{i}' AS demo, CAST(m{i} AS VARCHAR) AS v FROM rows" for i in range(len(GROUPS)))}
    UNION ALL SELECT fy, kind, program, postal, ein, 'COMMENTS', 'text', comment FROM rows
    UNION ALL SELECT fy, kind, program, postal, ein, 'SUBAWARDEE_SHELTER_TOTAL', NULL, CAST(shelter AS VARCHAR) FROM rows WHERE kind = 'State'
    UNION ALL SELECT fy, kind, program, postal, ein, 'SUBAWARDEE_NONSHELTER_TOTAL', NULL, CAST(other AS VARCHAR) FROM rows WHERE kind = 'State')
"""
IDS = 'kind AS "Grant Type", fy AS "Year", program AS "Program Acronym", postal AS "State", ein AS "EIN"'


def screens(spark, d):
    cover = derived(spark, d, "", COVER, HEADERS).withColumn("EIN", F.lit("raw"))
    metrics = derived(spark, d, "", METRICS, HEADERS)
    return {"Screen-1": cover.withColumn("Screen-Name", F.lit("cover")), "Screen-2": derived(spark, d, "", LINES, HEADERS),
            "Screen-3": metrics.withColumn("Screen-Name", F.lit("metrics"))}


def lookup(spark, comment="ANY COMMENTS, PLEASE?"):
    rows = [(c.upper(), f"c{i}", f"q{i}") for i, c in enumerate(CLIENTS)]
    rows += [(comment, "comments", "text"), ("CODETXT", None, "status"), ("NOT A COLUMN", "absent", "x")]
    table = literal_table(spark, {"Meta Name Description": "string", "Element": "string", "Demo": "string"}, rows)
    return with_constants(table, {"Clients": None, "In Use": None, "TypeService": None, "Outcomes": None})


def crosswalk(spark):
    rows = [(c.upper(), f"C{i}", GROUPS[i], "Clients") for i, c in enumerate(CLIENTS)]
    rows += [("ANY COMMENTS, PLEASE?", "COMMENTS", "Comments", None), (None, forms.SHELTER_TOTAL, "Shelter Funds", None),
             (None, forms.NONSHELTER_TOTAL, "Other Funds", None)]
    rows += [(c, None, ("Counseling" if c.endswith("1") else "Shelter") + " question", "Service Outcome") for c in OUTCOMES]
    names = {"Meta Name Description": "string", "Element": "string", "Label": "string", "Group_Description": "string"}
    return literal_table(spark, names, rows)


def categories(spark):
    return literal_table(
        spark, {"SubAwdCultSpecf": "string", "CultSpec2": "string", "row_ix": "bigint"},
        [("code A", "Group A", 1), ("code A", "Group B", 2), ("code N", "Other", 3)],
    )


def submission_index(spark, d, form=FORM):
    clean = formula.clean_screens(screens(spark, d))
    return clean, stage(formula.submission_index(clean["Screen-1"], clean["Screen-3"], form))


def resolved_submissions(spark, d, form=FORM):
    """As the job does: joined once, resolved on what decides; what several steps read is written once and read back."""
    clean = formula.clean_screens(screens(spark, d))
    joined = stage(formula.joined_submissions(clean["Screen-1"], clean["Screen-3"], form))
    kept = stage(formula.resolve_submissions(formula.deciding_columns(joined)))
    return clean, kept, stage(formula.decoded(formula.counted_submissions(joined, kept)))


def subawards(spark, d, resolved):
    receipts = stage(formula.state_receipts(resolved))
    cut = formula.clean_screens(screens(spark, d), kept={"Screen-2": receipts})
    return formula.subaward_rows(cut["Screen-2"], categories(spark), receipts)


def long_rows(spark, d):
    clean, _, resolved = resolved_submissions(spark, d)
    return clean, resolved, formula.long_table(resolved, stage(subawards(spark, d, resolved)), lookup(spark), FORM)


def wide_rows(spark, d):
    _, resolved, long = long_rows(spark, d)
    return formula.wide_table(long, crosswalk(spark), resolved, LABELS, FORM)


def reporting(spark, d):
    clean, index = submission_index(spark, d)
    columns = formula.join_screens(clean["Screen-1"], clean["Screen-3"], FORM).columns  # of the plan; nothing runs
    kept = formula.resolve_submissions(index)
    return stage(formula.reporting_submissions(kept, lookup(spark), crosswalk(spark), columns, FORM))


@query(
    "states_original_format",
    CLEAN + """SELECT fy AS "Fy", ein AS "EIN", grantee AS "GranteeName", kind AS "GranteeTypeTxt", postal AS "PostalCode", program AS "ProgAcronym",
      code AS "CodeTxt", rev AS "RevSeqNumber", submitted AS "SubmitDate", receipt AS "Rpt-Receipt-Id", m0 AS "Clients 0", m19 AS "PERCENTAGE SAFETY R2",
      comment AS "Any comments, please?" FROM resolved""",
)
def states_original_format(spark, d):
    out = resolved_submissions(spark, d)[2]
    return out.select("Fy", "EIN", "GranteeName", "GranteeTypeTxt", "PostalCode", "ProgAcronym", "CodeTxt", "RevSeqNumber", "SubmitDate",
                      "`Rpt-Receipt-Id`", "Clients 0", "PERCENTAGE SAFETY R2", "Any comments, please?")


def _outcome(kind: str, i: int) -> str:
    at = len(CLIENTS) + (i - 1) * 6
    cells = ", ".join(f'CAST(m{at + j} AS VARCHAR) AS "{m}"' for j, m in enumerate(forms.OUTCOME_FAMILIES))
    return f"""SELECT {IDS}, '{kind}' AS "Survey Type", {cells} FROM resolved"""


@query("states_service_outcome", CLEAN + _outcome("Counseling Survey", 1) + " UNION ALL " + _outcome("Shelter Survey", 2))
def states_service_outcome(spark, d):
    return formula.service_outcomes(resolved_submissions(spark, d)[2], crosswalk(spark))


@query(
    "states_subawards",
    CLEAN + f"""SELECT receipt AS "Rpt-Receipt-Id", line, part, supp, sub AS "{NAME}", sub_kind AS "{TYPE_RAW}", CAST(amount AS DOUBLE) AS "{AMOUNT}",
      cult2 AS "CultSpec2" FROM awards""",
)
def states_subawards(spark, d):
    resolved = resolved_submissions(spark, d)[2]
    out = doubles(subawards(spark, d, resolved), AMOUNT)
    return out.select("`Rpt-Receipt-Id`", "line", "part", "supp", NAME, TYPE_RAW, AMOUNT, "CultSpec2")


@query("states_long_format", CLEAN + f"""SELECT {IDS}, demo AS "Demo", element AS "Element", v AS "Value" FROM elements""")
def states_long_format(spark, d):
    return long_rows(spark, d)[2].drop("Clients", "In Use", "TypeService", "Outcomes")


@query("states_v8_long_format", CLEAN + f"""SELECT {IDS}, demo AS "Demo", element AS "Element", v AS "Value" FROM elements""")
def states_v8_long_format(spark, d):
    resolved = resolved_submissions(spark, d, FORM_V8)[2]
    names = lookup(spark, "ANY COMMENTS, PLEASE?...50")
    out = formula.long_table(resolved, stage(subawards(spark, d, resolved)), names, FORM_V8)
    return out.drop("Clients", "In Use", "TypeService", "Outcomes")


@query(
    "states_long_history",
    CLEAN + f"""SELECT {IDS}, element AS "Element", v AS "Value" FROM elements
    UNION ALL SELECT kind, fy - 3, program, postal, ein, element, 'old' FROM elements WHERE fy - 3 < {YEARS[0]}""",
)
def states_long_history(spark, d):
    clean, _, long = long_rows(spark, d)
    columns = [*forms.OUT_IDS, "Element", "Value"]
    long = stage(long.select(*columns))
    history = long.withColumns({"Year": F.col("Year") - 3, "Value": F.lit("old")})
    return formula.merge_long_history(history, long, clean["Screen-1"])


def _stored(spark, d, by_program):
    """The history as it is stored: an extract whose last year was returned whole replaces what was there."""
    clean, _, long = long_rows(spark, d)
    columns = [*forms.OUT_IDS, "Element", "Value"]
    long = stage(long.select(*columns))
    path = f"{staging_folder(spark)}/history-{uuid.uuid4().hex}"
    shifted = long.withColumns({"Year": F.col("Year") - 3, "Value": F.lit("old")})
    returned = long.filter(F.col("Year") == YEARS[-1]).withColumns({"Year": F.col("Year") + 1, "Value": F.lit("stale")})
    overwrite_periods(shifted.unionByName(returned), path, "Year")
    cover = clean["Screen-1"].select("Fy").distinct().unionByName(spark.range(1).select(F.lit(YEARS[-1] + 1).cast("int").alias("Fy")))
    formula.store_history(long, cover, path, by_program)
    return spark.read.parquet(path).select(*columns)


@query(
    "states_history_stored",
    CLEAN + f"""SELECT {IDS}, element AS "Element", v AS "Value" FROM elements
    UNION ALL SELECT kind, fy - 3, program, postal, ein, element, 'old' FROM elements WHERE fy - 3 < {YEARS[0]}""",
)
def states_history_stored(spark, d):
    return _stored(spark, d, by_program=True)


@query(
    "states_history_published",
    CLEAN + f"""SELECT {IDS}, element AS "Element", v AS "Value" FROM elements
    UNION ALL SELECT kind, fy - 3, program, postal, ein, element, 'old' FROM elements WHERE fy - 3 < {YEARS[0]}""",
)
def states_history_published(spark, d):
    """As states_history_stored, as versions: the second replaces its years and refers to the first for the others."""
    clean, _, long = long_rows(spark, d)
    long = stage(long.select(*forms.OUT_IDS, "Element", "Value"))
    root = f"{staging_folder(spark)}/published-{uuid.uuid4().hex}"
    shifted = long.withColumns({"Year": F.col("Year") - 3, "Value": F.lit("old")})
    returned = long.filter(F.col("Year") == YEARS[-1]).withColumns({"Year": F.col("Year") + 1, "Value": F.lit("stale")})
    before = shifted.unionByName(returned)
    publish_periods(before, before.select("Year"), root, "history", "v1", "first", "Year")
    cover = clean["Screen-1"].select("Fy").distinct().unionByName(spark.range(1).select(F.lit(YEARS[-1] + 1).cast("int").alias("Fy")))
    formula.publish_history(long, cover, root, "history", "v2", "second")
    return read_history(spark, root, "history").select(*forms.OUT_IDS, "Element", "Value")


@query(
    "states_history_merged_programs",
    CLEAN + """SELECT kind AS "Grant Type", postal AS "State", fy AS "Year", ein AS "EIN", element AS "Element", max(v) AS "Value"
      FROM elements GROUP BY ALL""",
)
def states_history_merged_programs(spark, d):
    clean, _, long = long_rows(spark, d)
    out = formula.merge_long_history(None, long, clean["Screen-1"], by_program=False)
    return out.select("Grant Type", "State", "Year", "EIN", "Element", "Value")


@query(
    "states_history_last_by_position",
    CLEAN + f""", placed AS (
      {" UNION ALL ".join(f"SELECT row_ix, kind, fy, postal, ein, 'C{i}' AS element, CAST(m{i} AS VARCHAR) AS v FROM rows" for i in range(len(GROUPS)))}
      UNION ALL SELECT row_ix, kind, fy, postal, ein, 'COMMENTS', comment FROM rows
      UNION ALL SELECT row_ix, kind, fy, postal, ein, 'SUBAWARDEE_SHELTER_TOTAL', CAST(shelter AS VARCHAR) FROM rows WHERE kind = 'State'
      UNION ALL SELECT row_ix, kind, fy, postal, ein, 'SUBAWARDEE_NONSHELTER_TOTAL', CAST(other AS VARCHAR) FROM rows WHERE kind = 'State')
    SELECT kind AS "Grant Type", postal AS "State", fy AS "Year", ein AS "EIN", element AS "Element", v AS "Value" FROM placed
    QUALIFY row_number() OVER (PARTITION BY kind, postal, fy, ein, element ORDER BY row_ix DESC) = 1""",
)
def states_history_last_by_position(spark, d):
    clean, _, resolved = resolved_submissions(spark, d)
    long = formula.long_table(resolved, stage(subawards(spark, d, resolved)), lookup(spark), FORM, ordered=True)
    out = formula.merge_long_history(None, long, clean["Screen-1"], by_program=False)
    return out.select("Grant Type", "State", "Year", "EIN", "Element", "Value")


def _client_total(parts: list[str]) -> str:
    return f"""nullif({" + ".join(f"coalesce(CAST({p} AS DOUBLE), 0)" for p in parts)}, 0)"""


_N = len(forms.CLIENT_GROUPS)


@query(
    "states_wide_format",
    CLEAN + f""", named AS (SELECT ein, CASE WHEN fy >= 2000 THEN grantee END AS newest FROM resolved
      QUALIFY row_number() OVER (PARTITION BY ein ORDER BY fy DESC, row_ix) = 1)
    SELECT {IDS.replace("ein AS", "rows.ein AS")}, {", ".join(f'CAST(m{i} AS DOUBLE) AS "{g}"' for i, g in enumerate(GROUPS))}, comment AS "Comments",
      CASE WHEN kind = 'State' THEN CAST(shelter AS VARCHAR) END AS "Shelter Funds", CASE WHEN kind = 'State' THEN CAST(other AS VARCHAR) END AS "Other Funds",
      {", ".join(f'{_client_total([f"m{p * _N + j}" for j in range(_N)])} AS "{n} Total"' for p, n in enumerate(forms.CLIENT_PREFIXES))},
      {", ".join(f'{_client_total([f"m{j}", f"m{_N + j}"])} AS "{g}"' for j, g in enumerate(forms.CLIENT_GROUPS))},
      newest AS "Grantee Name"
    FROM rows LEFT JOIN named n ON n.ein = rows.ein""",
)
def states_wide_format(spark, d):
    return wide_rows(spark, d)


WIDE_IDS = CLEAN + ", wide AS (SELECT DISTINCT kind, fy, postal, ein FROM rows) "


@query(
    "states_reporting_counts",
    WIDE_IDS + """SELECT fy AS "Year", count(DISTINCT ein) FILTER (kind = 'State') AS "Number of states reporting",
      count(DISTINCT ein) FILTER (kind = 'Tribe') AS "Number of tribes reporting" FROM wide GROUP BY fy""",
)
def states_reporting_counts(spark, d):
    return formula.reporting_counts(reporting(spark, d))


@query(
    "states_missing",
    WIDE_IDS + f"""SELECT y.fy AS "Year", s AS "State" FROM (SELECT DISTINCT fy FROM wide) y, unnest({ROSTER}) AS r(s)
      WHERE NOT EXISTS (SELECT 1 FROM wide w WHERE w.kind = 'State' AND w.fy = y.fy AND w.postal = s)""",
)
def states_missing(spark, d):
    return formula.missing_states(reporting(spark, d), ROSTER)


@query(
    "states_status_counts",
    CLEAN + """SELECT y.fy AS "Fy", k.kind AS "GranteeTypeTxt", c.code AS "CodeTxt", p.program AS "ProgAcronym", count(s.ein) AS "count"
      FROM (SELECT DISTINCT fy FROM subs) y CROSS JOIN (SELECT DISTINCT kind FROM subs) k CROSS JOIN (SELECT DISTINCT code FROM subs) c
      CROSS JOIN (SELECT DISTINCT program FROM subs) p
      LEFT JOIN subs s ON s.fy = y.fy AND s.kind = k.kind AND s.code = c.code AND s.program = p.program GROUP BY ALL""",
)
def states_status_counts(spark, d):
    return formula.status_counts(submission_index(spark, d)[1])


# Coalitions: several revisions per customer, year and program.
COALITION_FORM = forms.CoalitionForm(
    "DunsId9", "DUNS", questions=3, pairs=tuple((str(y), p) for y in YEARS for p in (forms.CORE, forms.ARP)),
    first_year="1995", last_year="2001",
)
STATES = [f"NATION_{i}" for i in range(25)] + ["NATION_99"]
CO_KEYS = """
  n_name AS state, CAST(year(o_orderdate) AS INT) AS fy, c_custkey AS ein,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'SDVC' WHEN '2-HIGH' THEN 'SDC6' WHEN '3-MEDIUM' THEN 'SDC3' ELSE 'OTHER' END AS program,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(month(o_orderdate) AS INT) END AS rev, o_orderdate AS submitted,
  CAST(o_orderkey % 3 AS INT) AS iteration, 'R' || CAST(o_orderkey AS STRING) AS receipt, o_orderkey AS row_ix
"""
CO_COVER = f"SELECT {CO_KEYS}, 'D' || CAST(c_custkey AS STRING) AS duns, c_name AS grantee, c_mktsegment AS program_name FROM {ORDERS}"
CO_PLAIN = f"SELECT {CO_KEYS}, o_totalprice AS price FROM {ORDERS}"
CO_NARRATIVE = f"""SELECT {CO_KEYS}, o_orderpriority AS n1, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END AS n2,
  CASE WHEN o_totalprice > 250000 THEN c_mktsegment END AS n3 FROM {ORDERS}"""
CO_ACTIVITIES = f"""SELECT {CO_KEYS}, CASE WHEN o_orderstatus = 'O' THEN 'seLect' ELSE 'Involved' END AS inv_a, 'None' AS inv_b,
  CASE WHEN o_totalprice > 200000 THEN 'Training | Policy' END AS typ_a, 'short' AS sho_a,
  CASE WHEN o_totalprice > 300000 THEN 'many' ELSE CAST(year(o_orderdate) AS STRING) END AS tra_b FROM {ORDERS}"""
CO_HEADERS = {
    "state": "PostalCode", "fy": "Fy", "ein": "RptEin", "program": "ProgAcronym", "rev": "RevSeqNumber", "iteration": "Row-Iteration",
    "receipt": "Rpt-Receipt-Id", "duns": "DunsId9", "grantee": "GranteeName", "program_name": "ProgramName", "submitted": "SubmitDate",
}
CO_IDS = ["State", "Year", "Program Abbr", "EIN"]
CO_BEST = "row_number() OVER (PARTITION BY state, fy, program, ein ORDER BY rev DESC NULLS LAST, submitted DESC, iteration, row_ix) = 1"
CO_NAMED = "CASE program WHEN 'SDVC' THEN 'Core FVPSA' WHEN 'SDC6' THEN 'ARP Act' WHEN 'SDC3' THEN 'CARES Act' ELSE program END"
CO_BASE = f"""
  WITH cover AS ({CO_COVER}), answers AS ({CO_NARRATIVE}), acts AS ({CO_ACTIVITIES}),
  grid AS (SELECT s AS state, CAST(y AS INT) AS fy, p AS program FROM unnest({STATES}) AS a(s), unnest({list(YEARS)}) AS b(y), unnest(['Core FVPSA', 'ARP Act']) AS c(p)),
  chosen AS (SELECT * REPLACE ({CO_NAMED} AS program) FROM (SELECT * FROM cover QUALIFY {CO_BEST})),
  full_grid AS (
    SELECT g.state, g.fy, g.program, c.* EXCLUDE (state, fy, program), c.ein IS NULL AS missing, 'Coalition ' || g.state AS coalition
    FROM grid g LEFT JOIN chosen c ON c.state = g.state AND c.fy = g.fy AND c.program = g.program)
"""
CO_OUT = 'state AS "State", CAST(fy AS VARCHAR) AS "Year", program AS "Program Abbr", f.ein AS "EIN", missing AS "Missing", coalition AS "CoalitionName"'


# The later form identifies a coalition by another code.
COALITION_FORM_V2 = forms.CoalitionForm(
    "UEI[Unique Entity Identifier]", "UEI", questions=7, pairs=COALITION_FORM.pairs, first_year="1995", last_year="2001"
)


def coalition_screens(spark, d, form=COALITION_FORM):
    headers = {**CO_HEADERS, "duns": form.code_column}

    def screen(text: str, name: str):
        df = derived(spark, d, "", text, headers)
        text_date = F.date_format("SubmitDate", "MM/dd/yyyy")
        return df.withColumns({"SubmitDate": text_date, "Screen-Name": F.lit(name)})

    plain = {s: screen(CO_PLAIN, s) for s in ("Screen-2", "Screen-3", "Screen-6", "Screen-7")}
    special = {"Screen-1": CO_COVER, "Screen-4": CO_NARRATIVE, "Screen-5": CO_ACTIVITIES}
    return {s: plain[s] if s in plain else screen(special[s], s) for s in forms.SECTIONS}


def coalition_crosswalk(spark):
    rows = [("n1", "1. What"), ("n2", "2. Why"), ("n3", "3. Who"), ("inv_a", "Level of Involvement - Area A"),
            ("inv_b", "Level of Involvement - Area B"), ("typ_a", "Types of Activities - Area A"),
            ("sho_a", "Short Response (Involved and Highly Involved only) - Area A"), ("tra_b", "Number of People Trained - Area B")]
    return literal_table(spark, {"Meta Name Description": "string", "Label": "string"}, rows)


def coalition_sections(spark, d, wanted, form=COALITION_FORM):
    """The wanted sections with their keys; the cover page always takes part."""
    raw = coalition_screens(spark, d, form)
    names = literal_table(
        spark, {"State": "string", "CoalitionName": "string"}, [(s, f"Coalition {s}") for s in STATES]
    )
    clean = formula.clean_screens(raw, territories=False)
    keys = coalitions.section_keys(clean, CO_IDS, form)
    chosen = {s: clean[s] for s in ("Screen-1", *wanted)}
    expected = coalitions.expected_submissions(spark, form, STATES)
    standard = coalitions.standardise(chosen, CO_IDS, names, form, stage, expected) if wanted else (
        coalitions.standardise(chosen, CO_IDS, names, form, expected=expected)
    )
    xw = coalition_crosswalk(spark)
    if "Screen-5" in wanted:
        return keys, coalitions.sections(standard, keys, xw, expected, names, form)
    return keys, {
        s: coalitions.section_table(df, s, keys, xw, expected, names, form) for s, df in standard.items()
    }


@query(
    "coalition_expected",
    f"""SELECT s AS "State", CAST(y AS VARCHAR) AS "Year", p AS "Program Abbr" FROM (SELECT DISTINCT n_name AS s FROM nation),
      unnest({list(YEARS)}) AS b(y), unnest(['Core FVPSA', 'ARP Act']) AS c(p)""",
)
def coalition_expected(spark, d):
    states = derived(spark, d, "", "SELECT n_name AS State FROM nation", {})
    return coalitions.expected_submissions(spark, COALITION_FORM, states)


@query(
    "coalition_cover_section",
    CO_BASE + f"""SELECT {CO_OUT}, duns AS "DUNS", program_name AS "Program Name", rev AS "RevSeqNumber", CAST(submitted AS DATE) AS "SubmitDate",
      receipt AS "Rpt-Receipt-Id" FROM full_grid f""",
)
def coalition_cover_section(spark, d):
    _, out = coalition_sections(spark, d, [])
    return out["Screen-1"].select(*CO_IDS, "Missing", "CoalitionName", "DUNS", "Program Name", "RevSeqNumber", "SubmitDate", "`Rpt-Receipt-Id`")


@query(
    "coalition_v2_cover_section",
    CO_BASE + f"""SELECT {CO_OUT}, duns AS "UEI", program_name AS "Program Name", receipt AS "Rpt-Receipt-Id" FROM full_grid f""",
)
def coalition_v2_cover_section(spark, d):
    _, out = coalition_sections(spark, d, [], COALITION_FORM_V2)
    return out["Screen-1"].select(*CO_IDS, "Missing", "CoalitionName", "UEI", "Program Name", "`Rpt-Receipt-Id`")


ANSWERED = CO_BASE + f""", best_answers AS (SELECT * FROM answers QUALIFY {CO_BEST}), best_acts AS (SELECT * FROM acts QUALIFY {CO_BEST}) """
_ACTS = """
  CASE WHEN lower(inv_a) = 'select' THEN NULL ELSE inv_a END AS inv_a, typ_a, sho_a, TRY_CAST(tra_b AS DOUBLE) AS tra_b, n1, n2, n3
"""
_JOINED = "FROM full_grid f LEFT JOIN best_acts a ON a.row_ix = f.row_ix LEFT JOIN best_answers n ON n.row_ix = f.row_ix"


@query(
    "coalition_activities_section",
    ANSWERED + f"""SELECT f.{CO_OUT.replace("CAST(fy", "CAST(f.fy").replace("program AS", "f.program AS")}, f.receipt AS "Rpt-Receipt-Id",
      CASE WHEN lower(inv_a) = 'select' THEN NULL ELSE inv_a END AS "Level of Involvement - Area A", CAST(NULL AS VARCHAR) AS "Level of Involvement - Area B",
      typ_a AS "Types of Activities - Area A", sho_a AS "Short Response (Involved and Highly Involved only) - Area A",
      TRY_CAST(tra_b AS DOUBLE) AS "Number of People Trained - Area B", n1 AS "1. What", n2 AS "2. Why", n3 AS "3. Who" {_JOINED}""",
)
def coalition_activities_section(spark, d):
    _, out = coalition_sections(spark, d, ["Screen-4", "Screen-5"])
    return out["Screen-5"].drop("row_ix", "Row-Iteration", "Screen-Name", "RevSeqNumber", "SubmitDate", "DUNS", "Program Name")


@query(
    "coalition_narrative_long",
    ANSWERED + f""", l AS (
      SELECT f.*, 1 AS pos, '1. What' AS question, n1 AS response {_JOINED} UNION ALL SELECT f.*, 2, '2. Why', n2 {_JOINED}
      UNION ALL SELECT f.*, 3, '3. Who', n3 {_JOINED})
    SELECT {CO_OUT}, duns AS "DUNS", program_name AS "Program Name", receipt AS "Rpt-Receipt-Id", question AS "Narrative Question", response AS "Response" FROM l f
    QUALIFY row_number() OVER (PARTITION BY state, fy, program, ein, receipt, response ORDER BY pos) = 1""",
)
def coalition_narrative_long(spark, d):
    keys, out = coalition_sections(spark, d, ["Screen-4"])
    return coalitions.narrative_long(out["Screen-4"], coalitions.long_id_columns(keys), COALITION_FORM)


@query(
    "coalition_activities_long",
    ANSWERED + f""", l AS (
      SELECT f.*, 'Area A' AS area, CASE WHEN lower(inv_a) = 'select' THEN NULL ELSE inv_a END AS inv, typ_a AS typ, sho_a AS sho, CAST(NULL AS DOUBLE) AS tra {_JOINED}
      UNION ALL SELECT f.*, 'Area B', NULL, NULL, NULL, TRY_CAST(tra_b AS DOUBLE) {_JOINED}),
    x AS (SELECT *, trim(t) AS part FROM l, unnest(string_split(l.typ, '|')) AS u(t) WHERE typ IS NOT NULL UNION ALL SELECT *, NULL, NULL FROM l WHERE typ IS NULL)
    SELECT {CO_OUT}, receipt AS "Rpt-Receipt-Id", duns AS "DUNS", program_name AS "Program Name", area AS "Priority Area", inv AS "Level of Involvement", part AS "Types of Activities", sho AS "Short Response",
      CAST(tra AS DOUBLE) AS "Number of People Trained" FROM x f""",
)
def coalition_activities_long(spark, d):
    keys, out = coalition_sections(spark, d, ["Screen-4", "Screen-5"])
    long = coalitions.activities_long(out["Screen-5"], coalitions.long_id_columns(keys))
    return long.withColumn("Number of People Trained", F.col("Number of People Trained").cast("double"))


# Analysis sets.
WIDE_TEXT = f"""
  SELECT 'State' AS kind, CAST(year(o_orderdate) AS INT) AS fy, o_orderpriority AS program, n_name AS state, CAST(c_custkey AS STRING) AS ein,
    c_name AS grantee, CASE WHEN sum(CAST(floor(o_totalprice) AS BIGINT)) % 3 = 0 THEN NULL ELSE count(*) - 1 END AS m1, '0' AS m2
  FROM {ORDERS} GROUP BY CAST(year(o_orderdate) AS INT), o_orderpriority, n_name, c_custkey, c_name"""
STATUS_TEXT = f"""
  SELECT 'State' AS kind, CAST(year(o_orderdate) AS INT) AS fy, o_orderpriority AS program, n_name AS state, CAST(c_custkey AS STRING) AS ein,
    c_name AS grantee, o_orderstatus AS code FROM {ORDERS}"""


@query(
    "analysis_wide",
    f"""WITH w AS ({WIDE_TEXT}), s AS ({STATUS_TEXT})
    SELECT w.kind AS "Grant Type", w.fy AS "Year", CASE w.program WHEN '1-URGENT' THEN 'Core FVPSA' ELSE w.program END AS "Program Acronym", w.state AS "State",
      w.ein AS "EIN", w.grantee AS "Grantee Name", CAST(m1 AS DOUBLE) AS m1, m2, s.code AS "CodeTxt",
      CASE WHEN coalesce(m1, 0) = 0 THEN 'Empty' ELSE 'Complete' END AS ppr_completeness
    FROM w LEFT JOIN (SELECT DISTINCT * FROM s) s USING (kind, fy, program, state, ein, grantee) WHERE w.fy = 1998""",
)
def analysis_wide(spark, d):
    wide = derived(spark, d, "", WIDE_TEXT, {"kind": "Grant Type", "fy": "Year", "program": "Program Acronym", "state": "State",
                                             "ein": "EIN", "grantee": "Grantee Name"})
    original = derived(spark, d, "", STATUS_TEXT, {"kind": "GranteeTypeTxt", "fy": "Fy", "program": "ProgAcronym", "state": "PostalCode",
                                                   "ein": "EIN", "grantee": "GranteeName", "code": "CodeTxt"})
    return analysis_set.analysis_wide(wide, original, ["m1", "m2"], ["m1"], 1998, {"1-URGENT": forms.CORE})


AWARD_TEXT = f"""
  SELECT CAST(year(o_orderdate) AS INT) AS fy, l_orderkey, l_linenumber, l_returnflag AS kind, o_orderpriority AS area, o_orderstatus AS program,
    CASE WHEN l_discount > 0.05 THEN 'Group ' || l_returnflag END AS cult2, CASE WHEN l_tax > 0.04 THEN 'Other' END AS cult3
  FROM {FACTS}"""


@query(
    "analysis_subawards",
    f"""WITH a AS ({AWARD_TEXT}), c AS (SELECT *, CASE WHEN cult2 IS NULL AND cult3 IS NULL THEN 'None' WHEN cult3 IS NULL THEN cult2
        ELSE coalesce(cult2, '') || ' and ' || cult3 END AS cat FROM a WHERE fy = 1999)
    SELECT fy AS "Fy", l_orderkey, l_linenumber, kind AS "Shelter Type", area AS "Rural Designation", CASE program WHEN 'F' THEN 'ARP Act' ELSE program END AS "ProgAcronym",
      coalesce(cult2, '') AS "CultSpec2", coalesce(cult3, '') AS "CultSpec3", cat AS cult_cat, cat <> 'None' AS csus FROM c""",
)
def analysis_subawards(spark, d):
    rows = derived(spark, d, "", AWARD_TEXT, {"fy": "Fy", "kind": TYPE_RAW, "area": forms.AREA_RAW, "program": "ProgAcronym",
                                              "cult2": "CultSpec2", "cult3": "CultSpec3"})
    return analysis_set.analysis_subawards(rows, 1999, {"F": forms.ARP}, compat_labels=True)


@query(
    "coalition_latest_records",
    f"""SELECT t.* FROM (WITH p AS ({CO_PLAIN}) SELECT state AS "PostalCode", fy AS "Fy", ein AS "RptEin", program AS "ProgAcronym", rev AS "RevSeqNumber",
      receipt AS "Rpt-Receipt-Id", price FROM p QUALIFY row_number() OVER (PARTITION BY fy, ein, program ORDER BY submitted DESC, row_ix) = 1) t""",
)
def coalition_latest_records(spark, d):
    out = analysis_set.coalition_set(coalition_screens(spark, d), None)["org_data"]
    return out.drop("SubmitDate", "Row-Iteration", "row_ix", "Screen-Name")


def _section(screen: str) -> None:
    """A section without questions of its own: every expected submission with the resolved row of that screen."""

    @query(
        f"coalition_section_{screen[-1]}",
        CO_BASE + f""", plain AS ({CO_PLAIN}), best AS (SELECT * FROM plain QUALIFY {CO_BEST})
        SELECT {CO_OUT.replace("state AS", "f.state AS").replace("CAST(fy", "CAST(f.fy").replace("program AS", "f.program AS")}, duns AS "DUNS",
          program_name AS "Program Name", f.receipt AS "Rpt-Receipt-Id", price FROM full_grid f LEFT JOIN best b ON b.row_ix = f.row_ix""",
    )
    def section(spark, d):
        _, out = coalition_sections(spark, d, [screen])
        return out[screen].select(*CO_IDS, "Missing", "CoalitionName", "DUNS", "Program Name", "`Rpt-Receipt-Id`", "price")


for _screen in ("Screen-2", "Screen-3", "Screen-6", "Screen-7"):
    _section(_screen)


def _latest(name: str) -> None:
    @query(
        f"coalition_latest_{name}",
        f"""SELECT t.* FROM (WITH p AS ({CO_PLAIN}) SELECT state AS "PostalCode", fy AS "Fy", ein AS "RptEin", program AS "ProgAcronym", rev AS "RevSeqNumber",
          receipt AS "Rpt-Receipt-Id", price FROM p QUALIFY row_number() OVER (PARTITION BY fy, ein, program ORDER BY submitted DESC, row_ix) = 1) t""",
    )
    def latest(spark, d):
        out = analysis_set.coalition_set(coalition_screens(spark, d), None)[name]
        return out.drop("SubmitDate", "Row-Iteration", "row_ix", "Screen-Name")


for _name in ("funding_data", "event_data", "tta_data"):
    _latest(_name)


@query(
    "coalition_priority_areas",
    ANSWERED + f"""SELECT {CO_OUT}, area AS "Priority Area", inv AS "Level of Involvement" FROM (
      SELECT f.*, 'Area A' AS area, CASE WHEN lower(inv_a) = 'select' THEN NULL ELSE inv_a END AS inv {_JOINED}
      UNION ALL SELECT f.*, 'Area B', NULL {_JOINED}) f""",
)
def coalition_priority_areas(spark, d):
    """The fifth table of the coalition set: priority areas, before their types of activities are told apart."""
    keys, out = coalition_sections(spark, d, ["Screen-4", "Screen-5"])
    areas = coalitions.activities_long(out["Screen-5"].drop("Types of Activities - Area A"), coalitions.long_id_columns(keys))
    found = analysis_set.coalition_set(coalition_screens(spark, d), areas)["pa_data"]
    return found.select(*CO_IDS, "Missing", "CoalitionName", "Priority Area", "Level of Involvement")
