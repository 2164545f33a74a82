"""The pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Defined cases, as the operators have them: null and empty texts fail the quality rules and go with the first stage; a
stage that is given some keeps them, but for the mix, which takes documents with words only; very long texts are read
whole; of repeated rows and copies the join keeps one; a null id is the last, and a null language or source is a group
of its own; a document that the mix takes twice has two rows; ties are settled as the operators say, alike on every
run over the same table; an empty table gives an empty result; other columns pass through, whatever their names, but
that a column ``shard`` is replaced by the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontaminate, kd_shards, mixing, ngram_join, quality_rules
from tallyloom.sources.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.75 or more."""
    return ngram_join.keep_one(docs, percent=75, width=5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, as it is or with other numbers and names, go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice has two rows."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return kd_shards.shard_documents(docs, shards=24)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("ngram_join", one_of_each),
    ("decontamination", decontaminated),
    ("weighted_mix", mixed),
    ("kd_shards", sharded),
]

#: Quantile sketches, near copies and sampling by hashed keys have no equal in DuckDB SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
