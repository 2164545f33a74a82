"""One key with a third of all rows: results stay right and no task takes the whole group."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import coverage, joins, resolve, rollup

N = 240_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
    yield spark.range(0, N, 1, 16).select(hot.alias("k"), (F.col("id") % 7).alias("a"), F.col("id").alias("ix"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)




def executed(spark, df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_attribute_join_is_split(spark, skewed):
    names = skewed.groupBy("k").agg(F.max("ix").alias("name"))
    out = joins.null_safe_join(skewed, names, ["k"], "left")
    text = executed(spark, out)
    assert "skew=true" in text
    assert out.where("k = -1").select("name").distinct().count() == 1
    assert out.count() == N


def test_completeness_on_a_hot_key(spark, skewed):
    out = rollup.completeness(skewed, ["a"], ["k"])
    assert "skew=true" in executed(spark, out)
    assert out.count() == N


def test_ties_of_a_hot_key_are_spread_and_kept(spark, skewed):
    out = resolve.keep_max(skewed, ["k"], "a")
    assert out.where("k = -1").count() == skewed.where("k = -1 and a = 6").count()
    hier = resolve.resolve_hierarchy(skewed, ["k"], [("a", "max")])
    assert hier.count() == out.count()


def test_top_n_sends_few_rows_of_a_hot_key(spark, skewed):
    out = resolve.top_n_per_group(skewed, ["k"], [F.col("ix").desc()], 1)
    rows = out.where("k = -1").collect()
    assert [r.ix for r in rows] == [N - 3]
    assert executed(spark, out).count("WindowGroupLimit") >= 2


def test_totals_and_distinct_counts(spark, skewed):
    total = resolve.total_and_distinct(skewed, ["k"], "a", ["ix"], keep=["ix"])
    hot = total.where("k = -1").first()
    assert hot.ix == 0 and hot.funding == sum(i % 7 for i in range(0, N, 3))
    assert rollup.count_distinct_entities(skewed, ["ix"], ["k"]).where("k = -1").first().n == N // 3
    assert rollup.concat_distinct(skewed, ["k"], "a", ",", ["ix"]).where("k = -1").first().a == "0,3,6,2,5,1,4"


def test_hot_cell_of_a_grid(spark, skewed):
    grid = spark.createDataFrame([(-1,), (-2,)], "k bigint")
    out = coverage.complete_against(skewed, grid, ["k"])
    assert out.where("not Missing").count() == N // 3
    assert [r.k for r in out.where("Missing").collect()] == [-2]
