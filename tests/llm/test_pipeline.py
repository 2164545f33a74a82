"""The pipeline by its stages, and the registered queries against their SQL."""

import os

import pytest

import __spark_entry__
import corpus_pipeline
from tallyloom.llm import decontaminate, mixing, ngram_join, quality_rules
from tallyloom.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    rows, difference = compare(spark, connect(SF), SF, QUERIES[name], ORACLES[name])
    assert difference is None, difference
    assert rows > 0


def test_pipeline_runs_its_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    kept = {r.doc_id for r in quality_rules.quality_report(docs).filter("kept").collect()}
    good = docs.filter(docs.doc_id.isin(kept))
    one = {r.doc_id for r in ngram_join.similarity_report(good).filter("doc_id = component_id").collect()}
    single = good.filter(good.doc_id.isin(one))
    leaks = {r.doc_id for r in decontaminate.contamination_report(single, benchmark).collect()}
    clean = single.filter(~single.doc_id.isin(leaks)) if leaks else single
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.mix_report(clean).collect() if r.taken}
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "shard"]
    rows = got.groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in rows} == taken
    assert got.filter("shard < 0 OR shard > 23 OR shard IS NULL").count() == 0


def test_stages_take_odd_rows(spark, docs, tmp_path):
    """Null, empty, repeated and very long rows, and columns with clashing names, one stage after the other."""
    spark.createDataFrame([(1, "a question that no document holds at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    current = docs.selectExpr("*", "'x' AS `K1`", "1 AS number", "'y' AS kept")
    for name, stage in corpus_pipeline.STAGES:
        before = current.count()
        got = stage(spark, current, str(tmp_path))
        assert got.columns == [*current.columns, *(["shard"] if name == "kd_shards" else [])]
        assert 0 < got.count() <= 2 * before
        if name != "weighted_mix":
            assert got.count() <= before
        current = got
    assert current.filter("text IS NULL OR length(text) = 0").count() == 0


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
