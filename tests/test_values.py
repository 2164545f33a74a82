"""Column expressions against hand-computed values."""

import html

from pyspark.sql import functions as F

from tallyloom.functions import names, values as V
from tallyloom.functions.html import html_unescape, unescape_columns


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lit(v):
    return F.lit(v).cast("string")


def test_strip_removes_what_python_strips(spark):
    for text in ["\t a b \n", "\xa0x　", "\x1c\x1dy\x85", "", " ", "plain", " in side "]:
        assert one(spark, V.strip(lit(text))) == (text.strip(),)
    assert one(spark, V.strip(lit(None))) == (None,)


def test_normalise_id_agrees_with_slices(spark):
    for old in ["[1 236003113 A1]", "[2 1 Z9]", "nan", "ab", "a", "", "[1 23]"]:
        assert one(spark, V.normalise_id(lit(old))) == (old[1:2] + old[3:-4] + old[-3:-1],), old


def test_sentinels(spark):
    got = one(spark, *[V.null_if_in(lit(v), ["nan", ""]) for v in ("nan", "", " nan ", "x", None)])
    assert got == (None, None, " nan ", "x", None)
    assert one(spark, V.null_if_in(lit("NoNe"), ["none"], ignore_case=True)) == (None,)


def test_recode_and_rules(spark):
    assert one(spark, V.recode(lit("a"), {"a": "A"}), V.recode(lit("b"), {"a": "A"}), V.recode(lit("b"), {"a": "A"}, "null")) == ("A", "b", None)
    assert one(spark, V.recode(lit("a"), {})) == ("a",)
    assert one(spark, V.overwrite_when(lit("s"), [(F.lit(False), "x"), (F.lit(True), "y")])) == ("y",)
    assert one(spark, V.unify_alias(lit("grantee_name"), ["GRANTEE_NAME"], "GRANTEENAME")) == ("GRANTEENAME",)


def test_join_labels(spark):
    cases = [("a", "b", "a and b", "a and b"), ("a", None, "a", "a"), (None, "b", "b", " and b"), ("", None, "None", "None")]
    for a, b, plain, compat in cases:
        assert one(spark, V.join_labels(lit(a), lit(b)), V.join_labels(lit(a), lit(b), compat=True)) == (plain, compat)


def test_amounts_and_numbers(spark):
    got = one(spark, *[V.parse_amount(lit(t)).cast("string") for t in ("$1,234.50", "-", "n/a", "USD -3", "7", None)])
    assert got == ("1234.50", "0.00", None, "-3.00", "7.00", None)
    assert one(spark, V.to_number(lit("12x")), V.to_number(lit("1.5"))) == (None, 1.5)


def test_dates_compare_as_dates(spark):
    df = spark.createDataFrame([("12/31/2022",), ("01/15/2024",), ("bad",)], "t string")
    assert str(df.select(F.max(V.parse_date(F.col("t")))).first()[0]) == "2024-01-15"


def test_presentation(spark):
    assert one(spark, V.money_text(F.lit(1234.5), 0), V.money_text(F.lit(-1.25), 2), V.count_text(F.lit(12345))) == ("$1,234", "-$1.25", "12,345")
    assert one(spark, V.range_text(F.lit(1), F.lit(2000))) == ("$1 - $2,000",)
    assert one(spark, V.period_label(F.lit(2023)), V.period_label(F.lit(2019), [2023])) == ("FY23", "2019")


def test_flags(spark):
    none_int = F.lit(None).cast("int")
    assert one(spark, V.tri_state(none_int, lit(None)), V.tri_state(none_int, lit("Yes")), V.tri_state(F.lit(3), lit(None))) == ("Did Not Submit", "0", "3")
    assert one(spark, V.more_than([lit("Funded"), lit(None), lit("Funded")], "Funded"), V.count_equal([lit(None)], "Funded")) == ("Yes", 0)
    assert one(spark, V.filled(lit(None)), V.filled(lit("0")), V.filled(F.lit(0)), V.filled(lit("x"))) == (0, 0, 0, 1)
    assert one(spark, V.binary_category(lit("sHelter"), "Shelter", "S", "N"), V.binary_category(lit(None), "Shelter", "S", "N")) == ("S", "N")
    assert one(spark, V.status_label(lit(None), "gone"), V.status_label(lit("Empty"), "gone", {"Empty": "Complete"})) == ("gone", "Complete")
    assert one(spark, V.classify_contains(lit("xb"), [("a", "A"), ("b", "B")], "T"), V.classify_contains(lit("x"), [("a", "A")])) == ("B", None)


def test_html_unescape_is_pythons(spark):
    texts = ["&quot;a&quot; &amp; b", "&eacute;&#233;&#xe9;", "&notin &nothing; &amp;amp;", "no entity", "", None, "&"]
    df = spark.createDataFrame([(t, 1) for t in texts], "t string, n int")
    got = [r[0] for r in df.select(html_unescape(F.col("t"))).collect()]
    assert got == [None if t is None else html.unescape(t) for t in texts]
    assert unescape_columns(df).dtypes == df.dtypes


def test_names():
    assert names.quote("a`b.c") == "`a``b.c`"
    assert names.names_like(["xa", "ya", "z"], ["a"], ["y"]) == ["xa"]
    assert names.folded_clashes(["Total", "TOTAL", "x"]) == ["TOTAL"]
