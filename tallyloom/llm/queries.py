"""The text operators bound to the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import (
    decontaminate, kd_shards, lexical_search, mixing, ngram_join, phrase_dedup, pu_quality, quality_rules, sanitise, suffix_dedup,
    toxicity, warc, whitening,
)
from tallyloom.sources.staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_template_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_kd_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard_report(table(spark, sf_dir, "documents"), shards=24)


@query("op6_weighted_mix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query("op10_pu_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu_quality.scored(docs, pu_quality.learn(docs, table(spark, sf_dir, "labels")))


@query(
    "op9_phrase_automata",
    """
    WITH w AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ), starts AS (
        SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM w WHERE len(words) >= 50
    ), windows AS (
        SELECT doc_id, i, sha256(array_to_string(words[i : i + 49], ' ')) AS h FROM starts
    ), firsts AS (
        SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (h) WHERE first < doc_id
    ), each_word AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
    ), kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
        FROM each_word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
    )
    SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(phrase_dedup.repeated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256"))


@query(
    "op3_ngram_join",
    """
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, hash(array_to_string(words[i : i + 4], ' ')) AS h
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM s AS a JOIN s AS b USING (h) JOIN sizes AS x ON x.doc_id = a.doc_id JOIN sizes AS y ON y.doc_id = b.doc_id
        WHERE a.doc_id != b.doc_id AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
        GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
    ), reach(a, b) AS (
        SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    )
    SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, coalesce(least(w.doc_id, min(b)), w.doc_id) AS component_id
    FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_report(table(spark, sf_dir, "documents"))


@query("op4_disclosure_sanitiser")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.span_report(table(spark, sf_dir, "documents"))


@query(
    "op2_capture_index",
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), f AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first != page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first != page_id THEN first END AS refers_to
    FROM f
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


@query(
    "op11_lexical_search",
    """
    WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM documents
    ), asked AS (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark
    ), tf AS (
        SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
    ), sizes AS (
        SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
    ), corpus AS (
        SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tf, corpus GROUP BY term, documents
    ), scores AS (
        SELECT item_id, doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), corpus
        GROUP BY item_id, doc_id
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query(
    "op13_suffix_dedup",
    """
    WITH t AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
    ), windows AS (
        SELECT doc_id, i, md5(substring(x, 2 * i + 1, 100)) AS h
        FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM t WHERE len(x) >= 100)
    ), firsts AS (
        SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)
    ), starts AS (
        SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE first < doc_id
    ), spaced AS (
        SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS opens FROM starts
    ), numbered AS (
        SELECT doc_id, i, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM spaced
    ), spans AS (
        SELECT doc_id, span, min(i) AS s, max(i) + 50 AS e FROM numbered GROUP BY doc_id, span
    ), bounds AS (
        SELECT t.doc_id, x, coalesce(lag(e) OVER (PARTITION BY t.doc_id ORDER BY s), 0) AS a, coalesce(s, len(x) // 2) AS b, span,
               CASE WHEN lead(s) OVER (PARTITION BY t.doc_id ORDER BY s) IS NULL THEN e END AS last
        FROM t LEFT JOIN spans USING (doc_id)
    ), kept AS (
        SELECT doc_id, any_value(x) AS x, CAST(count(span) AS BIGINT) AS n_spans,
               string_agg(substring(x, 2 * a + 1, 2 * (b - a)) || coalesce(substring(x, 2 * last + 1), ''), '' ORDER BY a) AS "left"
        FROM bounds GROUP BY doc_id
    )
    SELECT doc_id, len(x) // 2 AS n_bytes, (len(x) - len("left")) // 2 AS n_removed, n_spans, sha256(unhex("left")) AS kept_sha256 FROM kept
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return stage(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
