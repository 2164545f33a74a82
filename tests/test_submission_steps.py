"""Steps of the submission jobs: what is dropped early, what is read once, and that neither changes a row."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import coverage
from tallyloom.plans import coalitions, formula, forms
from tallyloom.sources.staging import stage
from tallyloom.sources.tables import literal_table

OK, BACK = "Submitted", forms.RETURNED
KEYS = ("Fy", "RptEin", "GranteeName", "GranteeTypeTxt", "PostalCode", "ProgAcronym", "CodeTxt", "RevSeqNumber", "SubmitDate", "Rpt-Receipt-Id")
SCREEN = ("`row_ix` int, `Screen-Name` string, `Fy` int, `RptEin` string, `GranteeName` string, `GranteeTypeTxt` string, `PostalCode` string, "
          "`ProgAcronym` string, `CodeTxt` string, `RevSeqNumber` int, `SubmitDate` string, `Rpt-Receipt-Id` string")


def row(ix, ein, kind="Tribe", code=OK, rev=1, receipt=None, state="AK"):
    return (ix, "x", 2023, ein and f"[1 00000000{ein} A1]", "Name", kind, state, "FVPS", code, rev, "01/15/2023", receipt or f"R{ix}")


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_and_null_rows_are_counted_as_often_as_they_join(spark, rows):
    cover = spark.createDataFrame(
        [row(1, "A"), row(1, "A"), row(2, "B", rev=1), row(3, "B", rev=2), row(4, "C", code=BACK, rev=9), row(5, "C"),
         row(6, "D", kind="Other"), row(7, None), row(8, "E", kind=None), row(9, "F", code=None)], SCREEN)
    metrics = cover.withColumn("m", F.col("row_ix") * 10)
    form = forms.StateForm(keys=KEYS)
    joined = stage(formula.joined_submissions(cover, metrics, form))
    assert joined.where(F.col("CodeTxt") == BACK).count() == 0
    kept = formula.resolve_submissions(formula.deciding_columns(joined))
    out = formula.counted_submissions(joined, kept)
    # Two equal rows on either screen join to four; the returned revision does not hide the one before it.
    assert rows(out, "m") == [(10,)] * 4 + [(30,), (50,), (70,), (90,)]
    assert formula.NUMBER not in out.columns


def test_sub_awards_are_cut_before_names_are_looked_up(no_broadcast, rows):
    spark = no_broadcast
    cover = spark.createDataFrame([row(1, "A", "State"), row(2, "B", "State")], SCREEN)
    awards = spark.createDataFrame(
        [(1, "[1 00000000A A1]", "old", " R1 ", "x"), (2, "[1 00000000B A1]", "old", "R2", "y"), (3, None, "old", "R1", "z"),
         (4, "[1 00000000A A1]", "old", None, "w")],
        "row_ix int, RptEin string, GranteeName string, `Rpt-Receipt-Id` string, v string")
    receipts = spark.createDataFrame([("R1",)], "`Rpt-Receipt-Id` string")
    screens = {"Screen-1": cover, "Screen-2": awards}
    out = formula.clean_screens(screens, kept={"Screen-2": receipts})["Screen-2"]
    assert rows(out, "row_ix", "GranteeName", "`Rpt-Receipt-Id`") == [(1, "Name", "R1"), (3, None, "R1")]
    text = plan(out)
    assert text.index("LeftOuter") < text.index("LeftSemi")  # the semi-join lies below, so that it runs first
    assert out.columns == formula.clean_screens(screens)["Screen-2"].columns


def test_sections_take_expected_rows_only_and_look_for_the_first_once(no_broadcast, rows):
    spark = no_broadcast
    form = forms.CoalitionForm("DunsId9", "DUNS", questions=1, pairs=(("2023", forms.CORE),))
    screen = spark.createDataFrame(
        [("AK", 2023, "SDVC", 7, 1, "a", 1), ("AK", 2023, "SDVC", 7, 2, "b", 2), ("AK", 2022, "SDVC", 7, 1, "c", 3), ("AK", 2023, "SDC6", 7, 1, "d", 4),
         ("ZZ", 2023, "SDVC", 7, 1, "e", 5), (None, 2023, "SDVC", 7, 1, "f", 6), ("AK", 2023, None, 7, 1, "g", 7)],
        "PostalCode string, Fy int, ProgAcronym string, RptEin int, RevSeqNumber int, v string, row_ix int")
    ids = ["State", "Year", "Program Abbr", "EIN"]
    names = literal_table(spark, {"State": "string", "CoalitionName": "string"}, [("AK", "Of AK"), ("AL", "Of AL")])
    expected = coalitions.expected_submissions(spark, form, ["AK", "AL"])
    raw = {coalitions.COVER: screen, "Screen-2": screen.select("PostalCode", "Fy", "ProgAcronym", "RptEin", "RevSeqNumber", "v", "row_ix")}
    cut = coalitions.standardise(raw, ids, names, form, expected=expected)
    whole = coalitions.standardise(raw, ids, names, form)
    assert rows(cut["Screen-2"], "v") == [("b",)] and whole["Screen-2"].count() > 1
    assert cut["Screen-2"].columns == whole["Screen-2"].columns

    crosswalk = literal_table(spark, {"Meta Name Description": "string", "Label": "string"}, [("v", "V")])
    table = coalitions.section_table(whole["Screen-2"], "Screen-2", ids, crosswalk, expected, names, form)
    same = coalitions.section_table(cut["Screen-2"], "Screen-2", ids, crosswalk, expected, names, form)
    want = [("AK", "2023", forms.CORE, "b", False, "Of AK"), ("AL", "2023", forms.CORE, None, True, "Of AL")]
    columns = ["State", "Year", "`Program Abbr`", "V", "Missing", "CoalitionName"]
    assert rows(table, *columns) == want == rows(same, *columns)
    plain = spark.createDataFrame([("AK", "2023", forms.CORE, 7, "b", 1)], "State string, Year string, `Program Abbr` string, EIN int, v string, row_ix int")
    assert plan(coalitions.section_table(plain, "Screen-2", ids, crosswalk, expected, names, form)).count(" Window [row_number") == 1


def test_another_frame_may_tell_what_came(spark, rows):
    expected = literal_table(spark, {"k": "int"}, [(1,), (2,), (3,)])
    df = spark.createDataFrame([(1, "a"), (1, "b"), (4, "c"), (None, "d")], "k int, v string")
    want = rows(coverage.complete_against(df, expected, ["k"]))
    assert rows(coverage.complete_against(df, expected, ["k"], seen=df.select("k").distinct())) == want
    assert want == [(1, "a", False), (1, "b", False), (2, None, True), (3, None, True)]
