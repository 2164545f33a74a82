"""Joins, deduplication and revision resolution: nulls, ties and duplicates."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import hygiene, joins, resolve


def test_null_keys_match(spark, rows):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, x string")
    b = spark.createDataFrame([(1, "A"), (None, "B"), (4, "D")], "k int, y string")
    assert rows(joins.null_safe_join(a, b, ["k"])) == [(1, "a", "A"), (None, "b", "B")]
    assert rows(joins.null_safe_join(a, b, ["k"], null_match=False)) == [(1, "a", "A")]
    assert rows(joins.null_safe_join(a, b, ["k"], "full")) == [(1, "a", "A"), (3, "c", None), (4, None, "D"), (None, "b", "B")]
    assert rows(joins.keep_ids(a, b, ["k"])) == [(1, "a"), (None, "b")]
    assert rows(joins.drop_ids(a, b, ["k"])) == [(3, "c")]


def test_odd_names_and_clashes(spark, rows):
    a = spark.createDataFrame([(1, "a")], ["UEI[Unique. Id]", "Total, any?"])
    b = a.select(F.col("`UEI[Unique. Id]`").alias("id.2"), F.col("`Total, any?`"))
    out = joins.null_safe_join(a, b, [("UEI[Unique. Id]", "id.2")], suffixes=("_x", "_y"))
    assert out.columns == ["UEI[Unique. Id]", "Total, any?_x", "Total, any?_y"]
    assert joins.join_shared(a, a).columns == a.columns


def test_lookup_must_be_unique(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="not unique"):
        joins.lookup_left(df, dim, ["k"]).collect()
    assert len(joins.lookup_left(df, dim, ["k"], unique=False).collect()) == 3
    assert rows(joins.lookup_left(df, dim.where("v = 'a'"), ["k"])) == [(1, "a"), (2, None)]


def test_measures_meet_once(spark, rows):
    a = spark.createDataFrame([(1, 10), (None, 5)], "k int, x int")
    b = spark.createDataFrame([(1, 7), (2, 8)], "k int, y int")
    assert rows(joins.outer_measures([a, b], ["k"])) == [(1, 10, 7), (2, None, 8), (None, 5, None)]
    assert rows(joins.inner_measures([a, b], ["k"])) == [(1, 10, 7)]
    with pytest.raises(Exception, match="repeats a key"):
        joins.outer_measures([a, b.union(b)], ["k"]).collect()


def test_cover_enriches_the_other_screens(spark, rows):
    cover = spark.createDataFrame([(1, None, "c", "s1"), (2, 9, "d", "s1")], "id int, z int, extra string, screen string")
    other = spark.createDataFrame([(1, None, "s2"), (2, 8, "s2")], "id int, z int, screen string")
    out = joins.enrich_from_cover({"cover": cover, "other": other}, "cover", ["screen"])
    assert rows(out["other"]) == [(1, None, "s2", "c"), (2, 8, "s2", None)]


SUBS = "who string, rev int, day string, it int, ix int"


def test_keep_max_keeps_ties_and_drops_null(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x", 1, 1), ("a", 2, "y", 1, 2), ("a", 2, "z", 1, 3), ("b", None, "q", 1, 4), (None, 5, "n", 1, 5)], SUBS
    )
    assert rows(resolve.keep_max(df, ["who"], "rev"), "ix") == [(2,), (3,)]
    assert rows(resolve.keep_max(df, ["who"], "rev", null_keys="keep"), "ix") == [(2,), (3,), (5,)]
    assert rows(resolve.keep_max(df, ["who"], "rev", ties="first", order_by=["ix"]), "ix") == [(2,)]


def test_hierarchy_goes_level_by_level(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "2024-01-01", 1, 1), ("a", 2, "2023-01-01", 2, 2), ("a", 2, "2023-01-01", 1, 3), ("a", 2, "2023-01-01", 1, 4),
         ("b", None, "2020-01-01", 1, 5), ("b", None, None, 1, 6), (None, 1, None, None, 7)], SUBS
    )
    levels = [("rev", "max"), ("absent", "max"), ("day", "max"), ("it", "min")]
    assert rows(resolve.resolve_hierarchy(df, ["who"], levels), "ix") == [(3,), (4,), (5,), (7,)]
    assert rows(resolve.resolve_hierarchy(df, ["who"], levels, ties="first", order_by=["ix"]), "ix") == [(3,), (5,), (7,)]
    assert rows(resolve.resolve_hierarchy(df, ["who"], levels, null_keys="drop"), "ix") == [(3,), (4,), (5,)]


@pytest.mark.parametrize("ties,kept", [("keep", [(2,), (3,), (4,)]), ("first", [(2,), (4,)])])
def test_subset_is_resolved_and_the_rest_passes(spark, rows, ties, kept):
    df = spark.createDataFrame([("S", 1, "a", 1, 1), ("S", 2, "a", 1, 2), ("S", 2, "a", 1, 3), ("T", 1, "a", 1, 4), ("O", 9, "a", 1, 5)], SUBS)
    who = F.col("who")
    out = resolve.resolve_subset(df, who == "S", ["day"], "rev", who == "T", ties=ties, order_by=["ix"])
    assert rows(out, "ix") == kept


def test_total_and_first_row(spark, rows):
    df = spark.createDataFrame([("a", 1, "later", 5, 2), ("a", 2, None, None, 1), (None, 3, "n", 4, 1)], SUBS)
    out = resolve.total_and_distinct(df, ["who"], "it", ["ix"], keep=["day", "rev"])
    assert rows(out) == [("a", None, 2, 5), (None, "n", 3, 4)]
    assert resolve.total_and_distinct(df, ["who"], "it", ["ix"]).columns == ["who", "rev", "day", "it", "ix", "funding"]
    assert rows(resolve.total_and_distinct(df, ["who"], "it", keep=(), nulls="propagate")) == [("a", None), (None, 4)]


def test_first_and_last(spark, rows):
    df = spark.createDataFrame([("a", 1, "x", 1, 2), ("a", 2, "y", 1, 1), ("b", 3, "z", 1, 3)], SUBS)
    assert rows(resolve.distinct_on(df, ["who"], ["ix"]), "rev") == [(2,), (3,)]
    assert rows(resolve.distinct_last(df, ["who"], ["ix"]), "rev") == [(1,), (3,)]


def test_cleaning_order_and_null_filters(spark, rows):
    df = spark.createDataFrame([(1, " nan "), (2, "nan"), (3, " "), (4, "\tx\n")], "i int, t string")
    assert rows(hygiene.clean_strings(df)) == [(1, "nan"), (2, None), (3, ""), (4, "x")]
    assert rows(hygiene.clean_strings(df, trim_first=True)) == [(1, None), (2, None), (3, None), (4, "x")]
    quoted = spark.createDataFrame([(1, "it's"), (2, "a\\b")], "i int, t string")
    assert rows(hygiene.clean_strings(quoted, sentinels=["it's", "a\\b"])) == [(1, None), (2, None)]
    n = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "i int, t string")
    assert rows(hygiene.exclude_values(n, "t", ["x"])) == [(1, None), (3, "y")]
    z = spark.createDataFrame([(1, None), (2, 0), (3, 4)], "i int, v int")
    assert rows(hygiene.nonzero(z, "v")) == [(3, 4)]
