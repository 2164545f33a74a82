"""Reshapes, crosswalks, ordering and stacking on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.aggregation import ORDERS, orders_with_region, places
from tallyloom.bindings.joining import YEARS
from tallyloom.bindings.registry import money, query, table
from tallyloom.functions.names import names_like
from tallyloom.operators import joins, present, reshape, rollup
from tallyloom.sources.tables import literal_table


@query(
    "to_long",
    """
    SELECT p_partkey, 'p_size' AS metric, CAST(p_size AS VARCHAR) AS measured FROM part
    UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
    UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
    """,
)
def to_long(spark, d):
    return reshape.to_long(table(spark, d, "part"), ["p_partkey"], ["p_size", "p_type", "p_brand"], "metric", "measured")


@query("pivot_strict", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_type, p_brand FROM part")
def pivot_strict(spark, d):
    return reshape.pivot_strict(
        to_long(spark, d), ["p_partkey"], "metric", "measured", ["p_size", "p_type", "p_brand"]
    )


@query(
    "pivot_fill",
    f"""WITH {ORDERS} SELECT n_name, count(*) FILTER (o_orderstatus='F') AS "F", count(*) FILTER (o_orderstatus='O') AS "O",
        count(*) FILTER (o_orderstatus='P') AS "P", count(*) FILTER (o_orderstatus='X') AS "unknown" FROM placed GROUP BY ALL""",
)
def pivot_fill(spark, d):
    return reshape.pivot_fill(
        orders_with_region(spark, d), ["n_name"], "o_orderstatus", {"F": "F", "O": "O", "P": "P", "X": "unknown"}
    )


@query(
    "pivot_fill_values",
    """
    WITH cells AS (SELECT o_custkey, o_orderstatus, nullif(count(*), 3) AS n FROM orders GROUP BY ALL)
    SELECT o_custkey,
      CASE WHEN count(*) FILTER (o_orderstatus='F') = 0 THEN -1 ELSE max(n) FILTER (o_orderstatus='F') END AS filled,
      CASE WHEN count(*) FILTER (o_orderstatus='O') = 0 THEN -1 ELSE max(n) FILTER (o_orderstatus='O') END AS "open"
    FROM cells GROUP BY 1
    """,
)
def pivot_fill_values(spark, d):
    cells = rollup.count_by(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"]).withColumn(
        "n", F.nullif("n", F.lit(3))
    )
    return reshape.pivot_fill(
        cells, ["o_custkey"], "o_orderstatus", {"F": "filled", "O": "open"}, "n", fill=-1, how="value"
    )


@query(
    "transpose_metrics",
    """
    WITH y AS (SELECT year(o_orderdate) AS yr, CAST(count(*) AS DOUBLE) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price
               FROM orders GROUP BY 1),
    l AS (SELECT yr, 'orders' AS metric, orders AS v FROM y UNION ALL SELECT yr, 'price', price FROM y)
    SELECT metric, max(v) FILTER (yr=1995) AS "FY95", max(v) FILTER (yr=1996) AS "FY96", max(v) FILTER (yr=1997) AS "FY97",
      max(v) FILTER (yr=1998) AS "FY98", max(v) FILTER (yr=1999) AS "FY99", max(v) FILTER (yr=2000) AS "FY00", max(v) FILTER (yr=2001) AS "FY01"
    FROM l GROUP BY 1
    """,
)
def transpose_metrics(spark, d):
    y = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("yr")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("price")
    )
    return reshape.transpose_metrics(y, "yr", ["orders", "price"], {n: f"FY{str(n)[-2:]}" for n in YEARS})


def _part_crosswalk(spark):
    return literal_table(
        spark,
        {"Meta Name Description": "string", "Element": "string", "Demo": "string"},
        [("P_SIZE", "SIZE", "m"), ("p_type", "TYPE", "t"), ("P_BRAND", None, "b"), ("P_RETAILPRICE", "PRICE", "m"),
         ("P_RETAILPRICE", "COST", "c"), ("P_ABSENT", "ABSENT", "a")],
    )


@query(
    "crosswalk_long",
    """
    SELECT p_partkey, Demo, Element, measured FROM (
      SELECT p_partkey, 'P_SIZE' AS variable, CAST(p_size AS VARCHAR) AS measured FROM part
      UNION ALL SELECT p_partkey, 'P_TYPE', p_type FROM part
      UNION ALL SELECT p_partkey, 'P_RETAILPRICE', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) FROM part)
    JOIN (VALUES ('P_SIZE','SIZE','m'),('P_TYPE','TYPE','t'),('P_RETAILPRICE','PRICE','m'),('P_RETAILPRICE','COST','c')) x(name, Element, Demo)
      ON variable = name
    UNION ALL SELECT p_partkey, NULL, 'P_NAME', p_name FROM part
    """,
)
def crosswalk_long(spark, d):
    part = table(spark, d, "part").withColumn("p_retailprice", money("p_retailprice"))
    return reshape.crosswalk_long(
        part, ["p_partkey"], _part_crosswalk(spark), attributes=["Demo"], extra=["p_name"], value="measured"
    )


@query(
    "rename_by_crosswalk",
    'SELECT p_partkey, p_name, p_brand, p_type AS "Kind, of part", p_size AS "Size [cm]", p_retailprice FROM part',
)
def rename_by_crosswalk(spark, d):
    xw = literal_table(
        spark, {"Meta Name Description": "string", "Label": "string"},
        [("p_type", "Kind, of part"), ("p_size", "Size [cm]"), ("p_absent", "Nothing")],
    )
    return reshape.rename_by_crosswalk(table(spark, d, "part"), xw)


@query(
    "rename_by_substring",
    'SELECT s_suppkey, s_name, s_nationkey AS first_hit, s_acctbal AS "key.1" FROM supplier',
)
def rename_by_substring(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("Question A.1"),
                                           F.col("s_acctbal").alias("key.1"))
    return reshape.rename_by_substring(s, {"Question A": ["first_hit"], "s_suppkey": ["never"], "absent": ["x"]})


@query("rename_chain", "SELECT s_suppkey AS s_nationkey, s_nationkey AS s_suppkey, s_name FROM supplier")
def rename_chain(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    return reshape.rename_columns(s, {"s_suppkey": "s_nationkey", "s_nationkey": "s_suppkey"})


@query("select_like", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def select_like(spark, d):
    part = table(spark, d, "part")
    return part.select(*names_like(part.columns, ["part", "r"], ["type"]))


USER_WIDE = """
    w AS (SELECT user_id,
      count(*) FILTER (event_type='click') AS "NUMBER click", CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type='click') AS DECIMAL(38,2)) AS VARCHAR) AS "TOTAL click",
      count(*) FILTER (event_type='view') AS "NUMBER view", CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type='view') AS DECIMAL(38,2)) AS VARCHAR) AS "TOTAL view",
      count(*) FILTER (event_type='error') AS "NUMBER error"
      FROM events GROUP BY 1)
"""


def _user_wide(spark, d):
    def is_type(kind):
        return F.col("event_type") == kind

    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(
        F.count_if(is_type("click")).alias("NUMBER click"),
        F.sum(F.when(is_type("click"), money("value"))).cast("string").alias("TOTAL click"),
        F.count_if(is_type("view")).alias("NUMBER view"),
        F.sum(F.when(is_type("view"), money("value"))).cast("string").alias("TOTAL view"),
        F.count_if(is_type("error")).alias("NUMBER error"),
    )


@query(
    "unpivot_families",
    f"""WITH {USER_WIDE}
    SELECT user_id, 'Clicks' AS kind, CAST("NUMBER click" AS VARCHAR) AS n, "TOTAL click" AS total FROM w
    UNION ALL SELECT user_id, 'Views', CAST("NUMBER view" AS VARCHAR), "TOTAL view" FROM w""",
)
def unpivot_families(spark, d):
    wide = _user_wide(spark, d)
    families = reshape.survey_families(
        wide.columns,
        {c.upper(): c for c in wide.columns},
        {"n": ("NUMBER", ["SAFETY"], False), "total": ("TOTAL", ["SAFETY"], False)},
        [("click", "Clicks"), ("view", "Views")],
        "Other",
    )
    return reshape.unpivot_families(wide, ["user_id"], families, "kind")


@query(
    "prefix_families_long",
    f"""WITH {USER_WIDE}, l AS (
      SELECT user_id, 'click' AS "Priority Area", CAST("NUMBER click" AS VARCHAR) AS "Count", 'a | b' AS "Kinds" FROM w
      UNION ALL SELECT user_id, 'view', CAST("NUMBER view" AS VARCHAR), CASE WHEN user_id > 75 THEN 'c' END FROM w
      UNION ALL SELECT user_id, 'error', CAST("NUMBER error" AS VARCHAR), NULL FROM w)
    SELECT user_id, "Priority Area", "Count", trim(k) AS "Kinds" FROM l, unnest(string_split(l."Kinds", '|')) AS t(k)
    UNION ALL SELECT user_id, "Priority Area", "Count", NULL FROM l WHERE "Kinds" IS NULL""",
)
def prefix_families_long(spark, d):
    wide = _user_wide(spark, d).select(
        "user_id",
        F.col("NUMBER click").alias("Count - click"),
        F.col("NUMBER view").alias("Count - view"),
        F.col("NUMBER error").alias("Count - error"),
        F.lit("a | b").alias("Kinds - click"),
        F.when(F.col("user_id") > 75, F.lit("c")).alias("Kinds - view"),
    )
    return reshape.prefix_families_long(
        wide, ["user_id"], {"Count": "Count - ", "Kinds": "Kinds - "}, explode="Kinds", order_by=["Count - click"]
    )


QUESTIONS = """
    WITH l AS (
      SELECT doc_id, 1 AS pos, '1. lang' AS question, lang AS response FROM documents
      UNION ALL SELECT doc_id, 2, '2. source', CASE WHEN n_chars > 500 THEN source ELSE lang END FROM documents
      UNION ALL SELECT doc_id, 3, '3. long', CASE WHEN n_chars > 2000 THEN text END FROM documents
      UNION ALL SELECT doc_id, 4, '4. again', CASE WHEN n_chars > 9000 THEN text END FROM documents)
    SELECT doc_id, question, response FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id, response ORDER BY pos) AS rn FROM l) WHERE rn = 1
"""


def _questions(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.col("lang").alias("1. lang"),
        F.when(F.col("n_chars") > 500, F.col("source")).otherwise(F.col("lang")).alias("2. source"),
        F.when(F.col("n_chars") > 2000, F.col("text")).alias("3. long"),
        F.when(F.col("n_chars") > 9000, F.col("text")).alias("4. again"),
    )


ASKED = ["1. lang", "2. source", "3. long", "4. again"]


@query("questions_long", QUESTIONS)
def questions_long(spark, d):
    return reshape.questions_long(_questions(spark, d), ["doc_id"], ASKED, "question", "response")


@query("questions_long_in_row", QUESTIONS)
def questions_long_in_row(spark, d):
    return reshape.questions_long(_questions(spark, d), ["doc_id"], ASKED, "question", "response", unique_ids=True)


@query(
    "explode_delimited",
    """
    WITH p AS (SELECT p_partkey, CASE WHEN p_size > 5 THEN replace(p_name, ' ', ' | ') END AS words FROM part)
    SELECT p_partkey, trim(w) AS words FROM p, unnest(string_split(p.words, '|')) AS t(w)
    UNION ALL SELECT p_partkey, NULL FROM p WHERE words IS NULL
    """,
)
def explode_delimited(spark, d):
    words = F.when(F.col("p_size") > 5, F.replace("p_name", F.lit(" "), F.lit(" | "))).alias("words")
    return reshape.explode_delimited(table(spark, d, "part").select("p_partkey", words), "words", "|")


@query(
    "cast_columns",
    """
    SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#', '') AS INT) AS brand_no, TRY_CAST(p_type AS INT) AS kind,
           CAST(p_size AS INT) AS size_no FROM part
    """,
)
def cast_columns(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_no"), F.col("p_type").alias("kind"),
        F.col("p_size").cast("string").alias("size_no"),
    )
    return reshape.cast_columns(part, ["brand_no", "kind", "size_no"], "int")


@query(
    "order_by_levels",
    """
    SELECT o_orderpriority, count(*) AS n,
      CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '1-URGENT' THEN 3 END AS level
    FROM orders GROUP BY 1
    """,
)
def order_by_levels(spark, d):
    counts = rollup.count_by(table(spark, d, "orders"), ["o_orderpriority"])
    return present.order_by_levels(
        counts, "o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"], after=["o_orderpriority"], rank="level"
    )


@query(
    "top_k",
    f"WITH {ORDERS} SELECT n_name, count(*) AS n FROM placed GROUP BY 1 ORDER BY n DESC, n_name LIMIT 10",
)
def top_k(spark, d):
    counts = rollup.count_by(orders_with_region(spark, d), ["n_name"])
    return present.top_k(counts, [F.col("n").desc(), F.col("n_name")], 10)


@query(
    "bottom_k",
    f"WITH {ORDERS} SELECT n_name, count(*) AS n FROM placed GROUP BY 1 ORDER BY n, n_name LIMIT 10",
)
def bottom_k(spark, d):
    counts = rollup.count_by(orders_with_region(spark, d), ["n_name"])
    return present.top_k(counts, [F.col("n").asc(), F.col("n_name")], 10)


@query(
    "stack_by_name",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, s_nationkey, NULL FROM supplier
    """,
)
def stack_by_name(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, d, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name")
    )
    return present.stack([c, s], {"code": "string"})


@query(
    "align_columns",
    "SELECT s_name, CAST(NULL AS VARCHAR) AS c_mktsegment, s_acctbal FROM supplier",
)
def align_columns(spark, d):
    like = table(spark, d, "customer").select(
        F.col("c_name").alias("s_name"), "c_mktsegment", F.col("c_acctbal").alias("s_acctbal")
    )
    return present.align_columns(table(spark, d, "supplier"), like)


@query(
    "band_rows",
    """
    SELECT c_mktsegment, 'Segment ' || c_mktsegment AS label, CAST(NULL AS BIGINT) AS n, 0 AS band_row
    FROM (VALUES ('BUILDING'), ('MACHINERY')) v(c_mktsegment)
    UNION ALL SELECT c_mktsegment, n_name, count(*), 1 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
    """,
)
def band_rows(spark, d):
    c = joins.lookup_left(table(spark, d, "customer"), places(spark, d), [("c_nationkey", "nationkey")])
    counts = c.groupBy("c_mktsegment", F.col("n_name").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    out = present.with_band_rows(
        counts, "c_mktsegment", "label", {"BUILDING": "Segment BUILDING", "MACHINERY": "Segment MACHINERY"}
    )
    return out.orderBy("c_mktsegment", "band_row", "label")


@query(
    "with_constants",
    "SELECT s_suppkey, 'supplier' AS source, CAST(NULL AS VARCHAR) AS matched FROM supplier",
)
def with_constants(spark, d):
    return present.with_constants(table(spark, d, "supplier").select("s_suppkey"), {"source": "supplier", "matched": None})
