"""Aggregations, reshapes, coverage, presentation and history."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import coverage, history, present, reshape, rollup


def test_sums_and_nulls(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", 1), ("b", None), ("c", 2)], "k string, v int")
    assert rows(rollup.sum_by(df, ["k"], "v")) == [("a", 0), ("b", 1), ("c", 2)]
    assert rows(rollup.sum_by(df, ["k"], "v", nulls="propagate")) == [("a", None), ("b", None), ("c", 2)]
    assert rows(rollup.stats_by(df, ["k"], "v", {"m": "mean", "n": "count"})) == [("a", None, 0), ("b", 1.0, 1), ("c", 2.0, 1)]
    assert rows(rollup.agg_of_agg(df, ["k"], [], "v", {"top": "max"})) == [(2,)]


def test_entities_with_null_parts_count(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (1, "a", "x"), (2, None, None)], "y int, n string, c string")
    assert rows(rollup.count_distinct_entities(df, ["n", "c"], ["y"])) == [(1, 2), (2, 1)]


def test_paired_totals_zero_is_null(spark, rows):
    df = spark.createDataFrame([(1, None, 0, None), (2, 3, None, 4), (0, 0, None, 0)], "`S Men` int, `S Women` int, `N Men` int, `N Women` int")
    out = rollup.paired_totals(df, ["Men", "Women"], ["S", "N"])
    assert rows(out, "`S Total`", "`N Total`", "Men", "Women") == [(1, None, 1, None), (5, 4, 2, 7), (None, None, None, None)]


def test_category_totals(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    facts = spark.createDataFrame([(1, "A", 5), (1, "A", None), (None, "A", 9)], "k int, c string, m int")
    out = rollup.category_totals(df, facts, ["k"], "c", "m", {"A": "a", "B": "b"})
    assert rows(out) == [(1, "x", 5, 0), (2, "y", None, None), (None, "z", None, None)]


def test_completeness_is_per_key(spark, rows):
    df = spark.createDataFrame([(1, None, "0"), (1, "x", None), (2, "0", None), (None, None, None)], "k int, a string, b string")
    got = rollup.completeness(df, ["a", "b"], ["k"]).select("k", "completeness").distinct()
    assert rows(got) == [(1, "Complete"), (2, "Empty"), (None, "Empty")]


def test_totals_rows(spark, rows):
    df = spark.createDataFrame([(1, "a", 2), (1, None, 3), (2, "a", 4)], "y int, r string, n int")
    assert rows(rollup.with_totals(df, ["y"], "r", ["n"])) == [
        (1, "Total", 5, True), (1, "a", 2, False), (1, None, 3, False), (2, "Total", 4, True), (2, "a", 4, False)]


def test_distinct_total_is_not_the_row_sum(spark, rows):
    df = spark.createDataFrame([(1, "R", "e1", "S"), (1, "R", "e1", "N"), (1, "R", "e1", "S"), (1, "R", "e2", "odd"), (1, "Q", "e1", None)],
                               "y int, r string, e string, k string")
    out = rollup.counts_with_distinct_total(df, ["e"], ["y"], "r", "k", {"S": "S", "N": "N"}, "all")
    assert rows(out.drop("is_total")) == [(1, "Q", 0, 0, 1), (1, "R", 1, 1, 2), (1, "Total", 1, 1, 3)]


def test_attributes(spark, rows):
    df = spark.createDataFrame([("k", 2017, "old", 1), ("k", 2019, None, 3), ("k", 2019, "new", 4), ("j", 2017, "j", 1), (None, 2020, "n", 9)],
                               "id string, y int, v string, ix int")
    assert rows(rollup.latest_attribute(df, "id", "y", "v", ["ix"], 2018)) == [("j", None), ("k", None), (None, "n")]
    assert rows(rollup.canonical_attribute(df, "id", "v", ["ix"])) == [("j", "j"), ("k", "old")]
    tables = rollup.canonicalise({"a": df, "b": df.drop("v")}, "id", "v", "a", ["ix"])
    assert tables["b"].columns == ["id", "y", "ix"]
    assert rows(tables["a"].where("ix = 3"), "v") == [("old",)]
    assert rows(tables["a"].where("ix = 9"), "v") == [(None,)]


def test_concat_distinct_in_order_of_appearance(spark, rows):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "b", 3), ("k", None, 4), ("j", None, 5)], "id string, v string, ix int")
    assert rows(rollup.concat_distinct(df, ["id"], "v", ", ", ["ix"])) == [("k", "b, a")]
    assert rows(rollup.concat_distinct(df, ["id"], "v", ", ", ["ix"], null_text="NA")) == [("j", "NA"), ("k", "b, a, NA")]


def test_pivots(spark, rows):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "a", "y")], "k int, l string, v string")
    assert rows(reshape.pivot_strict(df, ["k"], "l", "v", ["a", "b", "c"])) == [(1, "x", None, None), (2, "y", None, None)]
    with pytest.raises(Exception, match="occurs twice"):
        reshape.pivot_strict(df.union(df), ["k"], "l", "v", ["a"]).collect()
    filled = reshape.pivot_fill(df, ["k"], "l", {"a": "A", "b": "B"}, "v", fill="-", how="value")
    assert rows(filled) == [(1, "x", None), (2, "y", "-")]
    assert rows(reshape.pivot_fill(df, ["k"], "l", ["b"])) == [(1, 1), (2, 0)]


def test_long_mixes_types_as_text(spark, rows):
    df = spark.createDataFrame([(1, 2, "x", None)], "k int, a.b int, c string, d int".replace("a.b", "`a.b`"))
    assert rows(reshape.to_long(df, ["k"])) == [(1, "a.b", "2"), (1, "c", "x"), (1, "d", None)]


def test_crosswalk(spark, rows):
    df = spark.createDataFrame([(1, "x", 2, 3, 4)], "k int, Known string, `known.1` int, other int, TOTAL int")
    xw = spark.createDataFrame([("KNOWN", "E1", "L1"), ("KNOWN", "E2", "L2"), ("known.1", None, "L3"), ("gone", "E4", "L4")],
                               "`Meta Name Description` string, Element string, Label string")
    out = reshape.crosswalk_long(df, ["k"], xw, attributes=["Label"], extra=["TOTAL"])
    assert rows(out) == [(1, "L1", "E1", "x"), (1, "L2", "E2", "x"), (1, None, "TOTAL", "4")]
    assert reshape.rename_by_crosswalk(df, xw.where("Label = 'L3'")).columns == ["k", "Known", "L3", "other", "TOTAL"]


def test_renames(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Q", "Q.1", "my Q", "z"])
    assert reshape.rename_by_substring(df, {"Q": ["first"]}).columns == ["Q", "first", "my Q", "z"]
    assert reshape.rename_by_substring(df, None).columns == df.columns
    moved = reshape.rename_columns(df, {"Q": "z", "z": "Q"})
    assert moved.columns == ["z", "Q.1", "my Q", "Q"] and tuple(moved.first()) == (1, 2, 3, 4)


def test_families(spark, rows):
    df = spark.createDataFrame([(1, 5, None, 7, "a|  b", "s", None)],
                               "k int, `N - A` int, `N - B` int, `N - C` int, `T - A` string, `T - C` string, `S - D` string")
    out = reshape.prefix_families_long(df, ["k"], {"N": "N - ", "T": "T - ", "S": "S - "}, "area", explode="T")
    assert rows(out) == [(1, "A", "5", "a", None), (1, "A", "5", "b", None), (1, "B", None, None, None), (1, "C", "7", "s", None), (1, "D", None, None, None)]
    families = reshape.survey_families(
        ["NUM c1", "NUM c2", "PCT c1", "NUM SAFETY c1"], {"NUM C1": "Counseling", "NUM C2": "x", "PCT C1": "Counseling"},
        {"n": ("NUM", ["SAFETY"], False), "p": ("PCT", ["SAFETY"], False)}, [("Counseling", "C")], "Total")
    assert families == {"n": {"C": "NUM c1", "Total": "NUM c2"}, "p": {"C": "PCT c1"}}
    with pytest.raises(ValueError, match="two columns"):
        reshape.survey_families(["NUM a", "NUM b"], {}, {"n": ("NUM", [], False)}, [("x", "X")], "Total")


def test_questions(spark, rows):
    df = spark.createDataFrame([(1, "a", "a", None, None)], "k int, q1 string, q2 string, q3 string, q4 string")
    q = ["q1", "q2", "q3", "q4"]
    assert rows(reshape.questions_long(df, ["k"], q)) == [(1, "q1", "a"), (1, "q3", None)]
    assert len(reshape.questions_long(df, ["k"], q, dedup="question").collect()) == 4


def test_explode_keeps_null_and_empty(spark, rows):
    df = spark.createDataFrame([(1, "a | b"), (2, None), (3, "")], "k int, v string")
    assert rows(reshape.explode_delimited(df, "v")) == [(1, "a"), (1, "b"), (2, None), (3, "")]
    assert rows(reshape.explode_delimited(spark.createDataFrame([(1, "a::b")], "k int, v string"), "v", "::")) == [(1, "a"), (1, "b")]


def test_transpose_and_override(spark, rows):
    df = spark.createDataFrame([(2023, 1, 2), (2024, 3, 4)], "y int, a int, b int")
    assert rows(reshape.transpose_metrics(df, "y", ["a", "b"], {2023: "FY23", 2024: "FY24"})) == [("a", 1, 3), ("b", 2, 4)]
    fix = spark.createDataFrame([(2023, 9)], "y int, a int")
    assert rows(reshape.override_cells(df, fix, ["y"], "a"), "a") == [(3,), (9,)]


def test_coverage(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("q", 1, "z")], "s string, y int, v string")
    grid = spark.createDataFrame([("a", 1), ("b", 1)], "s string, y int")
    assert rows(coverage.complete_against(df, grid, ["s", "y"])) == [("a", 1, "x", False), ("a", 1, "y", False), ("b", 1, None, True)]
    assert rows(coverage.unexpected(df, grid, ["s", "y"])) == [("q", 1, "z")]
    assert rows(coverage.missing_members(df, ["a", "b"], "y", "s")) == [(1, "b")]
    assert rows(coverage.missing_members(df, grid.select("s"), "y", "s")) == [(1, "b")]
    counts = df.groupBy("s", "y").agg(F.count(F.lit(1)).alias("n"))
    assert rows(coverage.complete(counts, {"s": ["a", "b"], "y": [1]}, {"n": 0})) == [("a", 1, 2), ("b", 1, 0), ("q", 1, 1)]
    assert rows(coverage.contingency(df, ["s", "v"])) == sorted(
        [(s, v, int((s, v) in {("a", "x"), ("a", "y"), ("q", "z")})) for s in "aq" for v in "xyz"])
    assert rows(coverage.complete(counts, {"s": ["a", "b"], "y": [1]}, {"n": 0}, unique=True)) == [("a", 1, 2), ("b", 1, 0), ("q", 1, 1)]


def test_long_axes(spark):
    df = spark.range(10_001).select(F.col("id").alias("v"), (F.col("id") % 2).alias("s"))
    got = coverage.contingency(df, ["v", "s"])
    assert got.agg(F.count(F.lit(1)), F.sum("count")).first() == (20_002, 10_001)
    assert coverage.missing_members(df, spark.range(3).toDF("s"), "v", "s").count() == 2 * 10_001


def test_crosswalk_with_many_entries(spark, rows):
    df = spark.createDataFrame([(1, "x")], "id int, a string")
    many = spark.createDataFrame([("A", f"e{i}", i) for i in range(25)], "`Meta Name Description` string, Element string, n int")
    assert reshape.crosswalk_long(df, ["id"], many).count() == 25
    named = many.withColumnsRenamed({"Element": "Label"}).withColumn("Meta Name Description", F.lit("a"))
    assert reshape.rename_by_crosswalk(df, named, order_by=["n"]).columns == ["id", "e24"]
    with pytest.raises(ValueError, match="different labels"):
        reshape.rename_by_crosswalk(df, named)


def test_presentation(spark, rows):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("z", 4)], "l string, n int")
    assert [r.l for r in present.order_by_levels(df, "l", ["a", "b"], after=["n"]).collect()] == ["a", "b", None, "z"]
    assert [r.n for r in present.top_k(df, [F.col("n").desc()], 2).collect()] == [4, 3]
    banded = present.with_band_rows(spark.createDataFrame([(1, "x", 5)], "y int, l string, n int"), "y", "l", {1: "FY1", 2: "FY2"})
    assert rows(banded) == [(1, "FY1", None, 0), (1, "x", 5, 1), (2, "FY2", None, 0)]
    stacked = present.stack([df, spark.createDataFrame([("5", "q")], "n string, l string")], {"n": "int"})
    assert (("q", 5)) in rows(stacked)
    assert present.align_columns(df, ["n", "new"]).columns == ["n", "new"]


def test_history_replaces_whole_periods(spark, rows):
    old = spark.createDataFrame([(2022, "a", "o1"), (2023, "a", "o2"), (2023, "b", "o3")], "y int, k string, v string")
    new = spark.createDataFrame([(2023, "a", "n1"), (2023, "a", "n2")], "y int, k string, v string")
    want = [(2022, "a", "o1"), (2023, "a", "n2")]
    for periods in ([2023], new):
        assert rows(history.merge_history(old, new, "y", periods, ["y", "k"], ["v"])) == want
    assert rows(history.merge_history(None, new, "y", [2023], ["y", "k"], ["v"])) == [(2023, "a", "n2")]
    once = history.merge_history(old, new, "y", [2023], ["y", "k"], ["v"])
    assert rows(history.merge_history(once, new, "y", [2023], ["y", "k"], ["v"])) == want


def test_axes_meet_the_base_by_tiles(spark, rows):
    """The base is copied once per tile, not once per value or partition; a short axis copies nothing."""
    base = spark.range(50).select(F.nullif("id", F.lit(7)).alias("k"), F.lit("x").alias("v"))
    for n, tile_rows in ((3, 1024), (40, 8), (0, 8)):
        axis = spark.range(n).select((F.col("id") * 2).alias("a"), F.col("id").cast("string").alias("b"))
        tiles, n_tiles = coverage.tiles_of(axis, tile_rows)
        assert n_tiles == max(1, -(-n // tile_rows))
        met = coverage.meet_tiles(base, axis, tile_rows, chunk_rows=16)
        assert met.count() == 50 * tiles.count() <= 50 * n_tiles
        pairs = coverage.every_pair(base, axis, tile_rows=tile_rows, chunk_rows=16)
        assert pairs.columns == ["k", "v", "a", "b"]
        assert rows(pairs) == rows(base.crossJoin(axis))
    met = coverage.meet_tiles(base, spark.range(3).toDF("a"))
    assert met.count() == 50 and "CartesianProduct" not in met._jdf.queryExecution().executedPlan().toString()
