"""The jobs end to end on small hand-made submissions holding the awkward cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import analysis_set, arp_briefing, coalitions, core_briefing, formula, forms
from tallyloom.sources import publish
from tallyloom.sources.tables import literal_table

KEYS = ("Fy", "RptEin", "GranteeName", "GranteeTypeTxt", "PostalCode", "ProgAcronym", "CodeTxt", "RevSeqNumber", "SubmitDate", "Rpt-Receipt-Id")
COVER = ("`row_ix` int, `Screen-Name` string, `Fy` int, `RptEin` string, `GranteeName` string, `GranteeTypeTxt` string, `PostalCode` string, "
         "`ProgAcronym` string, `CodeTxt` string, `RevSeqNumber` int, `SubmitDate` string, `Rpt-Receipt-Id` string, `EIN` string")
E1, E2, E3, E4 = "[1 000000001 A1]", "[1 000000002 A1]", "[1 000000003 A1]", "[1 000000004 A1]"
OK, BACK = "Submitted", forms.RETURNED


def submission(ix, ein, name, kind, state, prog="FVPS", code=OK, rev=1, day="01/15/2023", fy=2023):
    return (ix, "x", fy, ein, name, kind, state, prog, code, rev, day, f"R{ix}", "raw")


SUBMISSIONS = [
    submission(1, E1, None, "State", "AL", rev=1, day="12/31/2023"),          # older revision, later date
    submission(2, E1, "Alpha &amp; Co\t", "State", "AL", rev=2, day="01/15/2023"),
    submission(3, E1, "Other spelling", "State", "AL", rev=3, code=BACK),       # returned
    submission(4, E2, "Beta", "Territory", "PR", day="12/31/2022"),
    submission(5, E3, "Gamma", "State", "PR", day="01/15/2023"),                # text order would pick E2
    submission(6, E4, "Tribe", "Tribe", "AK"),
    submission(7, E4, "Tribe", "Tribe", "AK", prog="FVC6"),                     # second program, same year
    submission(8, "[1 000000005 A1]", "nan", "Other", "AZ"),
    submission(9, E4, "Tribe", "Tribe", "AK", fy=2017),
]


@pytest.fixture(scope="module")
def screens(spark):
    cover = spark.createDataFrame(SUBMISSIONS, COVER)
    metrics = cover.drop("EIN").withColumns({
        "Clients W": F.when(F.col("row_ix") != 6, F.col("row_ix") * 10).cast("string"),
        "Clients N": F.lit("0"),
        "No such metric": F.lit("zzz"),
        "Said, what?": F.lit(" &quot;hi&quot; "),
        "NUMBER OF SURVEYS a": F.col("row_ix"), "NUMBER OF YES RESPONSES a": F.lit(1), "PERCENTAGE a": F.lit(0.5),
        "NUMBER OF SURVEYS SAFETY a": F.lit(2), "NUMBER OF YES RESPONSES SAFETY a": F.lit(None).cast("int"), "PERCENTAGE SAFTY a": F.lit(1),
    })
    def award(receipt, state, name, amount, kind, served):
        return (2023, "State", state, "FVPS", receipt, name, "City", amount, kind, "Rural", served, 1)
    subs = spark.createDataFrame(
        [award("R2", "AL", "Org &amp; Co", 10.0, "SHELTER", "s1"), award("R2", "AL", "Org 2", None, None, "nan"),
         award("R2", "AL", "Org 3", 5.0, "Non-shelter", "unknown"), award("R1", "AL", "old", 99.0, "Shelter", "s1")],
        f"`Fy` int, `GranteeTypeTxt` string, `PostalCode` string, `ProgAcronym` string, `Rpt-Receipt-Id` string, `{forms.NAME}` string, `{forms.CITY}` string, "
        f"`{forms.AMOUNT}` double, `{forms.TYPE_RAW}` string, `{forms.AREA_RAW}` string, `{forms.SERVED}` string, `row_ix` int",
    ).withColumn(forms.AMOUNT, F.col(forms.AMOUNT).cast("decimal(18,2)"))
    return {"Screen-1": cover, "Screen-2": subs, "Screen-3": metrics}


@pytest.fixture(scope="module")
def lookups(spark):
    lookup = literal_table(spark, {"Meta Name Description": "string", "Element": "string", "Clients": "string", "In Use": "string", "Demo": "string",
                                   "TypeService": "string", "Outcomes": "string"},
                           [("CLIENTS W", "cw", "c", "y", "d", "t", "o"), ("clients n", "CN", None, None, None, None, None),
                            ("SAID, WHAT?", "Said", None, None, None, None, None), ("CODETXT", None, None, None, None, None, None)])
    names = {"Meta Name Description": "string", "Element": "string", "Label": "string", "Note": "string", "Group_Description": "string"}
    outcome = ["NUMBER OF SURVEYS A", "NUMBER OF YES RESPONSES A", "PERCENTAGE A", "NUMBER OF SURVEYS SAFETY A", "NUMBER OF YES RESPONSES SAFETY A", "PERCENTAGE SAFTY A"]
    xw = literal_table(spark, names, [("x", "cw", "Shelter Women", None, None), ("x", "CN", "Non-shelter Women", None, None), ("x", "SAID", "Said", None, None),
                                      ("x", forms.SHELTER_TOTAL, "Shelter Funds", None, None), (None, "dropped", "Dropped", None, None)]
                       + [(o, None, "Counseling things", None, "Service Outcome") for o in outcome])
    cult = literal_table(spark, {"SubAwdCultSpecf": "string", "CultSpec2": "string", "CultSpec3": "string", "row_ix": "int"},
                         [("s1", "first", "f3", 1), ("s1", "second", None, 2)])
    return {"lookup": lookup, "crosswalk": xw, "cultspec_subawardee": cult}


@pytest.fixture(scope="module")
def published(spark, screens, lookups, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out"))
    form = forms.StateForm(keys=KEYS)
    formula.run(screens, lookups, form, root, "v1", "test", history_path=root + "/history", roster=["AL", "PR", "WY"])
    return root, lambda t: publish.read_version(spark, root, "states_tribes", t)


def test_the_submissions_that_count(published, rows):
    out = published[1]("OriginalFormat")
    assert rows(out, "`Rpt-Receipt-Id`", "EIN", "GranteeName", "GranteeTypeTxt", "SubmitDate") == [
        ("R2", "1000000001A1", "Alpha & Co", "State", dt.date(2023, 1, 15)),
        ("R5", "1000000003A1", "Gamma", "State", dt.date(2023, 1, 15)),
        ("R6", "1000000004A1", "Tribe", "Tribe", dt.date(2023, 1, 15)),
        ("R7", "1000000004A1", "Tribe", "Tribe", dt.date(2023, 1, 15)),
        ("R9", "1000000004A1", "Tribe", "Tribe", dt.date(2023, 1, 15)),
    ]
    assert rows(out.select("Said, what?").distinct()) == [('"hi"',)]


def test_subawards_of_counted_states_with_the_first_category(published, rows):
    assert rows(published[1]("Subawardee"), f"`{forms.NAME}`", "CultSpec2", f"`{forms.SERVED}`") == [
        ("Org & Co", "first", "s1"), ("Org 2", None, None), ("Org 3", None, "unknown")]


def test_long_format(published, rows):
    long = published[1]("LongFormat")
    assert rows(long.where("State = 'AL'"), "Element", "Value", "Clients") == [
        ("CN", "0", None), ("CW", "20", "c"), ("SAID", '"hi"', None), ("SUBAWARDEE_NONSHELTER_TOTAL", "5.00", None),
        ("SUBAWARDEE_SHELTER_TOTAL", "10.00", None)]
    assert rows(long.where("State = 'PR'"), "Element", "Value")[-2:] == [("SUBAWARDEE_NONSHELTER_TOTAL", None), ("SUBAWARDEE_SHELTER_TOTAL", None)]
    assert rows(long.where("`Grant Type` = 'Tribe'").select("Element").distinct()) == [("CN",), ("CW",), ("SAID",)]


def test_wide_format(published, rows):
    wide = published[1]("WideFormat")
    got = rows(wide, "Year", "`Program Acronym`", "State", "`Shelter Women`", "`Shelter Total`", "`Non-shelter Total`", "Women", "`Shelter Funds`", "`Grantee Name`")
    assert got == [
        (2017, "FVPS", "AK", 90.0, 90.0, None, 90.0, None, "Tribe"), (2023, "FVC6", "AK", 70.0, 70.0, None, 70.0, None, "Tribe"),
        (2023, "FVPS", "AK", None, None, None, None, None, "Tribe"), (2023, "FVPS", "AL", 20.0, 20.0, None, 20.0, "10.00", "Alpha & Co"),
        (2023, "FVPS", "PR", 50.0, 50.0, None, 50.0, None, "Gamma")]
    assert "Dropped" not in wide.columns


def test_outcomes_and_metadata(published, rows):
    out = published[1]("ServiceOutcome")
    assert rows(out.where("State = 'AL'"), "`Survey Type`", *[f"`{m}`" for m in forms.OUTCOME_FAMILIES]) == [
        ("Counseling Survey", "2", "1", "0.5", "2", None, "1")]
    assert rows(published[1]("ReportingCounts")) == [(2017, 0, 1), (2023, 2, 1)]
    assert rows(published[1]("MissingStates")) == [(2017, "AL"), (2017, "PR"), (2017, "WY"), (2023, "WY")]
    counts = published[1]("StatusCounts")
    assert counts.count() == 2 * 3 * 2 * 2
    assert rows(counts.where("CodeTxt = '%s' and count > 0" % BACK)) == [(2023, "State", BACK, "FVPS", 1)]


def test_history_is_stored_by_year(spark, published, rows):
    stored = spark.read.parquet(published[0] + "/history")
    assert stored.count() == published[1]("LongFormat").count()
    assert rows(stored.select("Year").distinct()) == [(2017,), (2023,)]


def test_screens_join_on_leading_columns(screens):
    assert formula.submission_keys(screens["Screen-1"], forms.StateForm(n_key_columns=4)) == ["Fy", "RptEin"]


# Coalitions


CO = ("`row_ix` int, `Screen-Name` string, `PostalCode` string, `Fy` int, `ProgAcronym` string, `RptEin` string, `GranteeName` string, `RevSeqNumber` int, "
      "`SubmitDate` string, `Row-Iteration` int, `Screen-Iteration` int, `Rpt-Receipt-Id` string")


@pytest.fixture(scope="module")
def coalition_tables(spark, tmp_path_factory):
    data = [(1, "x", "AL", 2023, "SDVC", "e1", "Raw name", 1, "01/01/2023", 1, 1, "R1"), (2, "x", "AL", 2023, "SDVC", "e1", "Raw name", 2, "12/31/2022", 2, 1, "R2"),
            (3, "x", "AL", 2023, "SDVC", "e1", "Raw name", 2, "12/31/2022", 1, 1, "R3"), (4, "x", "AK", 2023, "WHAT", "e2", "Other", 1, "01/01/2023", 1, 1, "R4")]
    base = spark.createDataFrame(data, CO)
    screens = {s: base for s in forms.SECTIONS}
    screens["Screen-1"] = base.withColumns({"DunsId9": F.lit("d9"), "ProgramName": F.lit("Program")})
    screens["Screen-4"] = base.withColumns({"q1": F.lit("same"), "q2": F.lit("same"), "q3": F.lit(None).cast("string"), "q11": F.lit("later")})
    screens["Screen-5"] = base.withColumns({
        "iA": F.lit("Select"), "iB": F.lit("Involved"), "tA": F.lit("one | two"), "nB": F.lit("many"), "nA": F.lit("12"),
        "Types of Activities,FVPSA Summary of Activities,R19C2": F.lit("moved")})
    xw = literal_table(spark, {"Meta Name Description": "string", "Label": "string"},
                       [("q1", "1. One"), ("q2", "2. Two"), ("q3", "5. Five"), ("q11", "11. Eleven"), ("iA", "Level of Involvement - A"),
                        ("iB", "Level of Involvement - B"), ("tA", "Types of Activities - A"), ("nA", "Number of People Trained - A"), ("nB", "Number of People Trained - B"),
                        ("Types of Activities,FVPSA Summary of Activities,R9C2", "Types of Activities - C")])
    names = literal_table(spark, {"State": "string", "CoalitionName": "string"}, [("AL", "Coalition AL"), ("AK", "Coalition AK")])
    root = str(tmp_path_factory.mktemp("coalitions"))
    coalitions.run(screens, xw, names, forms.COALITIONS_V1, root, "v1", "test", ids=["State", "Year", "Program Abbr", "EIN"], states=["AL", "AK"])
    return lambda t: publish.read_version(spark, root, "coalitions", t)


def test_one_submission_per_coalition_and_missing_ones_flagged(coalition_tables, rows):
    cover = coalition_tables("I. Cover Page")
    assert cover.count() == 18 and "GranteeName" not in cover.columns
    assert rows(cover.where("not Missing"), "State", "Year", "`Program Abbr`", "`Rpt-Receipt-Id`", "CoalitionName", "DUNS") == [
        ("AL", "2023", "Core FVPSA", "R3", "Coalition AL", "d9")]
    assert rows(cover.where("State = 'AK'").select("CoalitionName").distinct()) == [("Coalition AK",)]


def test_activities(coalition_tables, rows):
    section = coalition_tables("V. Summary of Activities").where("not Missing")
    assert rows(section, "`1. One`", "`5. Five`", "`Level of Involvement - A`", "`Number of People Trained - A`", "`Number of People Trained - B`", "`Types of Activities - C`") == [
        ("same", None, None, 12.0, None, "moved")]
    assert "11. Eleven" not in section.columns
    long = coalition_tables("Section V SoA Long Format").where("not Missing")
    assert rows(long, "`Priority Area`", "`Level of Involvement`", "`Types of Activities`", "`Number of People Trained`") == [
        ("A", None, "one", "12.0"), ("A", None, "two", "12.0"), ("B", "Involved", None, None), ("C", None, "moved", None)]


def test_narratives_collapse_equal_answers(coalition_tables, rows):
    long = coalition_tables("Section IV Narr Long Format")
    assert rows(long.where("not Missing"), "`Narrative Question`", "Response") == [("1. One", "same"), ("5. Five", None)]
    assert rows(long.where("Missing"), "`Narrative Question`", "Response") == [("1. One", None)] * 17


def test_expected_grid_sizes(spark):
    assert coalitions.expected_submissions(spark, forms.COALITIONS_V1).count() == 504
    assert coalitions.expected_submissions(spark, forms.COALITIONS_V2).count() == 112
    assert len(forms.STATE_ROSTER) == 52 and len(set(forms.COALITION_STATES)) == 56


# Analysis sets and briefings


def test_latest_record_parses_dates(spark, rows):
    df = spark.createDataFrame([(2023, "e", "p", "12/31/2022", 1), (2023, "e", "p", "01/15/2024", 2), (2023, "e", "p", "01/15/2024", 3), (2023, "e", "p", None, 0)],
                               "Fy int, RptEin string, ProgAcronym string, SubmitDate string, row_ix int")
    assert rows(analysis_set.latest_record(df), "row_ix") == [(2,)]


def test_core_tables(spark, rows):
    def sub(name, city, state, kind, amount, cult="", fy=2023, program=forms.CORE, area="Rural"):
        return (fy, name, city, state, kind, area, cult, amount, program)

    data = [sub("A", "x", "AL", "Shelter", 10), sub("A", "x", "AL", "Shelter", 5), sub("A", "x", "AL", "Select", 7, "Group"), sub("B", "y", "AL", "Other", 1),
            sub("B", "y", "AL", "Other", 1, fy=2024), sub("C", "z", "??", "Shelter", 4), sub(None, "x", "AL", "Shelter", 99), sub("D", "x", "AL", "Shelter", 0),
            sub("D", "x", "AL", "Shelter", None), sub("E", "x", "AL", "Shelter", 8, program="ARP Act")]
    df = spark.createDataFrame(data, f"Fy int, `{forms.NAME}` string, `{forms.CITY}` string, PostalCode string, `{forms.TYPE}` string, `{forms.AREA}` string, "
                                     f"CultSpec2 string, `{forms.AMOUNT}` int, ProgAcronym string")
    b = core_briefing.CoreBriefing(regions=("Region 1",))
    core = core_briefing.core_subawards([df], b)
    assert rows(core_briefing.subawardees_per_year(core, b)) == [("FY23", 3), ("FY24", 1)]
    regions = spark.createDataFrame([("AL", "Region 1")], "`State Abb` string, `HHS Region` string")
    listed = spark.createDataFrame([("B", "Coalition B", "AL", True), ("A", "no", "AL", False)], "data_name string, coalition string, state string, statewide_dv boolean")
    placed = core_briefing.placed_subawards(core, regions, listed)
    table = [tuple(r) for r in core_briefing.region_by_type(placed, b).collect()]
    assert table == [(2023, "FY23 - Total", 2, 0, 1, 0, 1, 3), (2023, "Region 1", 1, 0, 1, 0, 1, 2), (2023, None, 1, 0, 0, 0, 0, 1),
                     (2024, "FY24 - Total", 0, 0, 1, 0, 0, 1), (2024, "Region 1", 0, 0, 1, 0, 0, 1)]
    assert rows(core_briefing.coalition_amounts(placed, b)) == [("Coalition B", "$1", "$1")]
    assert rows(core_briefing.funded_matrix(placed, b, {"A": "Alpha"})) == [("Alpha", "x", "AL", "Funded", "")]
    assert rows(core_briefing.mean_award(placed, b)) == [(2023, (22 + 1 + 4) / 3), (2024, 1.0)]
    wide = spark.createDataFrame([("AL", 2023, forms.CORE, "State", "Empty")], "State string, Year int, `Program Acronym` string, `Grant Type` string, ppr_completeness string")
    assert rows(core_briefing.submission_status(listed, wide, b)) == [("AL", "2023", "Empty"), ("AL", "2024", "Did not submit")]


def test_arp_streams_and_unspecified_rules(spark, rows):
    def sub(name, funding, program):
        return (2024, "AL", "c", name, "Rural", funding, "Shelter", "", program)

    df = spark.createDataFrame(
        [sub("A", "ARP DV Supplemental | ARP Sexual Assault Supplemental", "x"), sub("B", None, forms.ARP), sub("C", None, "FVDR"), sub("D", "odd", forms.ARP), sub("K", None, "FSC6")],
        f"Fy int, PostalCode string, `{forms.CITY}` string, `{forms.NAME}` string, `{forms.AREA}` string, `{forms.FUNDING_TYPE}` string, `{forms.TYPE}` string, "
        "CultSpec2 string, ProgAcronym string")
    known = spark.createDataFrame([("K", None, False), ("Z", "Zed", True)], "name string, name_formal string, state_dv boolean")
    form = arp_briefing.form_rows(df, known)
    assert rows(form, "name", "stream", "shelter") == [
        ("A", "DV", "Shelter"), ("A", "SA", "Shelter"), ("B", "ARP Unspecified", "Shelter"), ("C", "Disaster Unspecified", "Shelter"), ("D", None, "Shelter"),
        ("K", "ARP Unspecified", "Coalition")]
    arp = arp_briefing.arp_subawards([form, form])
    assert rows(arp_briefing.stream_counts(arp)) == [(2024, "ARP Unspecified", 2), (2024, "DV", 1), (2024, "SA", 1)]


def test_served_categories_with_missing_ones(spark, rows):
    base = [(2024, "AL", "DV", "A", "c", "g"), (2024, "AL", "DV", "A", "c", None), (2024, "AL", "DV", "B", "c", None), (2024, "AL", "DV", "C", "c", "Other"), (2024, "AL", "DV", "C", "c", "")]
    arp = spark.createDataFrame(base, "year int, state string, stream string, name string, city string, underserved string")
    external = spark.createDataFrame([("2024", "AK", "Ext", "-")], "year string, state string, subawardee string, amount string")
    assert rows(arp_briefing.served_entities(arp, external), "name", "cultspec") == [("A", "g"), ("Ext", "General")]
    assert rows(arp_briefing.served_entities(arp, external, compat=True), "name", "cultspec") == [("A", "NA***g"), ("B", "NA"), ("Ext", "General")]
    assert rows(arp_briefing.organisation_amounts(external)) == [("Ext", "AK", "$0"), ("Total funding", "", "$0")]


def test_arp_briefing_counts_once(spark, rows, tmp_path):
    """All tables of the job against the functions that count for themselves."""
    base = [(2024, s, st, n, c, k, u, p) for s in ("AL", "AK", "??") for st in ("DV", "SA", "Covid", "ARP Unspecified") for n, c, k, u, p in (
        ("A", "c", "Shelter", "g", forms.ARP), ("A", "c", "Shelter", None, forms.ARP), ("A", "c", "Coalition", "g", forms.CORE),
        ("B", None, None, "", forms.ARP)) if (s, st) != ("AK", "SA")]
    part = spark.createDataFrame(base, "year int, state string, stream string, name string, city string, shelter string, underserved string, ProgAcronym string")
    part = part.withColumns({c: F.lit(None).cast("string") for c in arp_briefing.BASE if c not in part.columns} | {"urban": F.lit("Rural")})
    part = part.select(*arp_briefing.BASE)
    regions = spark.createDataFrame([("AL", "Region 1"), ("AK", "Region 2")], "`State Abb` string, `HHS Region` string")
    lookups = {
        "regions": regions,
        "funding": spark.createDataFrame([("State", "Sexual Assault Supplemental", 5)], "`Grantee Type` string, `Grant Program Type` string, Amount int"),
        "external": spark.createDataFrame([("2024", "AK", "Ext", "-")], "year string, state string, subawardee string, amount string"),
        "wide": spark.createDataFrame([("AL", 2024, forms.ARP, "State", "Submitted", "Empty")],
                                      "State string, Year int, `Program Acronym` string, `Grant Type` string, CodeTxt string, ppr_completeness string"),
    }
    b = arp_briefing.ArpBriefing(regions=("Region 1", "Region 2"))
    arp_briefing.run([part], lookups, b, str(tmp_path), "v1", "test")
    arp = arp_briefing.arp_subawards([part])

    def published(t):
        return rows(publish.read_version(spark, str(tmp_path), "arp_briefing", t))

    assert published("StreamCounts") == rows(arp_briefing.stream_counts(arp))
    assert published("RegionByStream") == rows(arp_briefing.region_by_stream(arp, regions, b))
    assert published("AwardSummary") == rows(arp_briefing.award_summary(arp, lookups["funding"]))
    assert published("SubmissionMatrix") == rows(arp_briefing.submission_matrix(
        arp, publish.read_version(spark, str(tmp_path), "arp_briefing", "Status"), regions, None, b))
    assert published("ShelterCounts") == rows(spark.createDataFrame(
        [(2024, arp_briefing.STREAM_LABELS[s], r, n) for s in ("DV", "SA", "Covid", "ARP Unspecified")
         for r, n in (("Region 1", 2), ("Region 2", 2), (None, 2)) if (r, s) != ("Region 2", "SA")], "y int, s string, r string, n int"))
    coalition = {(r[1], r[2]): r[3] for r in published("CoalitionCounts") if r[0] == 2024}
    assert coalition["ARP SA", "Region 2"] == 0 and coalition["ARP SA", "Region 1"] == 1


def test_screens_of_several_files_have_one_order(spark, screens, lookups, tmp_path, rows):
    """Two files per screen, as CSV in small splits: first names, last values and revisions follow file, then row."""
    from tallyloom.sources import tables

    for name, df in screens.items():
        for part, rule in (("a", F.col("row_ix") <= 4), ("b", F.col("row_ix") > 4)):
            one = df.where(rule).orderBy("row_ix").drop("row_ix").coalesce(1).write.option("header", True).option("quoteAll", True).option("escape", '"')
            one.csv(f"{tmp_path}/in/{name}/{part}")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256")
    try:
        kinds = {"Fy": "int", "RevSeqNumber": "int", forms.AMOUNT: "decimal(18,2)"}
        read = {n: tables.with_row_order(tables.read_table(spark, f"{tmp_path}/in/{n}/*", "csv", overrides=kinds), "csv") for n in screens}
        cover = read["Screen-1"].orderBy("source_path", "row_ix")
        assert [r["Rpt-Receipt-Id"] for r in cover.collect()] == [s[11] for s in SUBMISSIONS]
        root = str(tmp_path / "out")
        paths = formula.run(read, lookups, forms.StateForm(keys=KEYS), root, "v1", "test", history="states_history", roster=["AL"])
    finally:
        spark.conf.set(size, before)
    resolved = publish.read_version(spark, root, "states_tribes", "OriginalFormat")
    assert rows(resolved, "`Rpt-Receipt-Id`", "GranteeName") == [("R2", "Alpha & Co"), ("R5", "Gamma"), ("R6", "Tribe"), ("R7", "Tribe"), ("R9", "Tribe")]
    history = publish.read_history(spark, root, "states_history")
    long = spark.read.parquet(paths["LongFormat"])
    assert sorted(history.columns) == sorted(long.columns)
    assert rows(history.select(*long.columns)) == rows(long)


def test_the_last_value_of_a_key_is_the_last_by_position(spark, rows):
    long = spark.createDataFrame(
        [("State", 2023, p, "AL", "e", "X", v, c, r) for p, v, c, r in (("A", "9", 1, 1), ("B", "10", 1, 3), ("C", None, 1, 2), ("D", "1", 0, 9))],
        "`Grant Type` string, Year int, `Program Acronym` string, State string, EIN string, Element string, Value string, column_ix int, row_ix int")
    cover = spark.createDataFrame([(2023,)], "Fy int")
    assert rows(formula.merge_long_history(None, long, cover, by_program=False), "Value") == [("10",)]
    assert rows(formula.merge_long_history(None, long.drop("column_ix", "row_ix"), cover, by_program=False), "Value") == [("9",)]
