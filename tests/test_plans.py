"""Plans stay what they should be: no cross joins, cut groups before the shuffle, pruned scans."""

import inspect
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.bindings import load
from tallyloom.operators import coverage, joins, resolve, rollup
from tallyloom.sources import tables

SF = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(resolve.top_n_per_group(df, ["k"], [F.col("id").desc()], 2))
    assert text.count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in plan(resolve.resolve_hierarchy(df, ["k"], [("id", "max")]))


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_semi", "left_anti"])
def test_null_safe_joins_are_equi_joins(no_broadcast, how):
    a = no_broadcast.range(10).select(F.nullif("id", F.lit(3)).alias("k"), F.col("id").alias("x"))
    text = plan(joins.null_safe_join(a, a.withColumnRenamed("x", "y"), ["k"], how))
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_measures_shuffle_once(no_broadcast):
    a = no_broadcast.range(10).select(F.col("id").alias("k"), F.col("id").alias("x"))
    frames = [a, a.withColumnRenamed("x", "y"), a.withColumnRenamed("x", "z")]
    assert plan(joins.outer_measures(frames, ["k"])).count("Exchange hashpartitioning") == 1


def test_distinct_total_needs_no_join(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("y"), F.lit("r").alias("r"), F.col("id").alias("e"), F.lit("c").alias("c"))
    text = plan(rollup.counts_with_distinct_total(df, ["e"], ["y"], "r", "c", {"c": "C"}, "all"))
    assert "Join" not in text


def test_grids_need_no_cross_join(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"))
    for out in (coverage.contingency(df, ["a", "b"]), coverage.missing_members(df, [0, 1], "a", "b"),
                coverage.complete(df, {"a": [0], "b": [0, 1]}, {})):
        text = plan(out)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "SinglePartition" not in text


def test_periods_are_rebalanced_when_stored(spark):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("y"))
    assert "REBALANCE" in plan(df.hint("rebalance", F.col("y")))
    assert inspect.getsource(tables).count("def overwrite_periods") == 1
    assert 'hint("rebalance"' in inspect.getsource(tables.overwrite_periods)


@needs_data
@pytest.mark.parametrize("name", sorted(load()[0]))
def test_no_query_has_a_cross_join(spark, name):
    text = plan(load()[0][name](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@needs_data
def test_scans_read_what_they_need(spark):
    text = load()[0]["sum_by"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" in text and "l_shipdate" not in text and "l_tax" not in text
    text = load()[0]["lookup_left_diffname"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(s_acctbal,5000.0)" in text


def test_laid_out_lookups_are_read_without_a_shuffle(no_broadcast, rows):
    fact = no_broadcast.range(40).select((F.col("id") % 7).alias("k, odd"), "id").withColumn("k, odd", F.nullif("k, odd", F.lit(5)))
    dim = no_broadcast.range(6).select(F.col("id").alias("key"), F.col("id").cast("string").alias("na.me"))
    laid = joins.lay_out(dim, ["key"])
    out = joins.lookup_left(fact, laid, [("k, odd", "key")])
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert plan(joins.lookup_left(fact, dim, [("k, odd", "key")])).count("Exchange hashpartitioning") > 1
    assert rows(out) == rows(joins.lookup_left(fact, dim, [("k, odd", "key")]))
    with_null = joins.lay_out(dim.withColumn("key", F.nullif("key", F.lit(2))), ["key"])
    assert with_null.null_keys and not laid.null_keys
    met = joins.lookup_left(fact, with_null, [("k, odd", "key")])
    assert rows(met.where("`k, odd` IS NULL").select("`na.me`").distinct()) == [("2",)]
    with pytest.raises(ValueError, match="not unique"):
        joins.lay_out(dim.unionByName(dim), ["key"])
    with pytest.raises(ValueError, match="laid out by"):
        joins.lookup_left(fact, laid, [("id", "na.me")])


@needs_data
def test_checked_lookups_cost_one_shuffle(no_broadcast):
    """Each of the two lookups was shuffled twice in every table."""
    no_broadcast.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        queries = load()[0]
        assert plan(queries["core_funding_by_type"](no_broadcast, SF)).count("Exchange hashpartitioning") <= 13
        assert plan(queries["sum_by"](no_broadcast, SF)).count("Exchange hashpartitioning") <= 7
    finally:
        no_broadcast.conf.set("spark.sql.adaptive.enabled", "true")


@needs_data
def test_briefing_tables_read_one_base(no_broadcast):
    no_broadcast.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        queries = load()[0]
        for name in ("arp_coalition_counts", "arp_expected_subaward_reports", "arp_status_counts", "states_status_counts"):
            text = plan(queries[name](no_broadcast, SF))
            assert text.count("Exchange hashpartitioning") <= 15 and text.count("FileScan") <= 5, name
    finally:
        no_broadcast.conf.set("spark.sql.adaptive.enabled", "true")
