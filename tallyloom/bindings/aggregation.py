"""Aggregations on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.joining import orders_with_nation
from tallyloom.bindings.registry import doubles, money, query, table
from tallyloom.operators import joins, rollup


def places(spark, d):
    """nation key -> region name."""
    return joins.null_safe_join(
        table(spark, d, "nation"), table(spark, d, "region"), [("n_regionkey", "r_regionkey")]
    ).select(F.col("n_nationkey").alias("nationkey"), "n_name", "r_name")


def orders_with_region(spark, d):
    return joins.lookup_left(orders_with_nation(spark, d), joins.lay_out(places(spark, d), ["nationkey"]), ["nationkey"])


def lines_with_region(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", money("l_extendedprice").alias("amount")
    )
    o = orders_with_region(spark, d).select("o_orderkey", "yr", "r_name", "n_name", "nationkey")
    return joins.null_safe_join(lines, o, [("l_orderkey", "o_orderkey")])


PLACED = """
    lines AS (
      SELECT l_returnflag, l_linestatus, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
             CAST(year(o_orderdate) AS INT) AS yr, r_name, n_name, c_nationkey AS nationkey, o_custkey, c_mktsegment
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
ORDERS = """
    placed AS (
      SELECT o.*, CAST(year(o_orderdate) AS INT) AS yr, r_name, n_name, c_nationkey AS nationkey, c_mktsegment
      FROM orders o JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@query("count_by", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def count_by(spark, d):
    return rollup.count_by(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "sum_by",
    f"WITH {PLACED} SELECT r_name, l_returnflag, CAST(sum(amount) AS DOUBLE) AS amount FROM lines GROUP BY ALL",
)
def sum_by(spark, d):
    return doubles(rollup.sum_by(lines_with_region(spark, d), ["r_name", "l_returnflag"], "amount"), "amount")


@query(
    "sum_by_nulls",
    """
    SELECT o_orderpriority,
      CAST(coalesce(sum(x), 0) AS DOUBLE) AS skipping,
      CAST(CASE WHEN count(x) = count(*) THEN sum(x) END AS DOUBLE) AS propagating
    FROM (SELECT o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' OR (o_orderpriority = '2-HIGH' AND o_orderstatus = 'P')
          THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS x FROM orders) GROUP BY 1
    """,
)
def sum_by_nulls(spark, d):
    hidden = "o_orderpriority = '5-LOW' OR (o_orderpriority = '2-HIGH' AND o_orderstatus = 'P')"
    o = table(spark, d, "orders").withColumn("x", F.when(~F.expr(hidden), money("o_totalprice")))
    a = rollup.sum_by(o, ["o_orderpriority"], "x", "skipping")
    b = rollup.sum_by(o, ["o_orderpriority"], "x", "propagating", nulls="propagate")
    return doubles(joins.outer_measures([a, b], ["o_orderpriority"]), "skipping", "propagating")


@query(
    "stats_by",
    f"""WITH {PLACED} SELECT r_name, l_returnflag, CAST(sum(amount) AS DOUBLE) / count(amount) AS mean_amount,
        CAST(min(amount) AS DOUBLE) AS min_amount, CAST(max(amount) AS DOUBLE) AS max_amount FROM lines GROUP BY ALL""",
)
def stats_by(spark, d):
    out = rollup.stats_by(
        lines_with_region(spark, d), ["r_name", "l_returnflag"], "amount",
        {"mean_amount": "mean", "min_amount": "min", "max_amount": "max"},
    )
    return doubles(out, "min_amount", "max_amount")


@query(
    "agg_of_agg",
    """
    SELECT c_mktsegment, CAST(sum(total) AS DOUBLE) / count(total) AS mean_total, CAST(max(total) AS DOUBLE) AS max_total FROM (
      SELECT c_mktsegment, o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) GROUP BY 1
    """,
)
def agg_of_agg(spark, d):
    o = table(spark, d, "orders").select("o_custkey", money("o_totalprice").alias("price"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    joined = joins.null_safe_join(o, c, [("o_custkey", "c_custkey")])
    out = rollup.agg_of_agg(
        joined, ["o_custkey"], ["c_mktsegment"], "price", {"mean_total": "mean", "max_total": "max"}
    )
    return doubles(out, "max_total")


@query(
    "count_distinct_entities",
    f"WITH {ORDERS} SELECT r_name, yr, count(DISTINCT o_custkey) AS customers FROM placed GROUP BY ALL",
)
def count_distinct_entities(spark, d):
    return rollup.count_distinct_entities(orders_with_region(spark, d), ["o_custkey"], ["r_name", "yr"], "customers")


@query(
    "share_by",
    f"""WITH {ORDERS} SELECT n_name, count(*) AS number, count(*) FILTER (o_orderpriority = '1-URGENT') AS hits,
        CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) / count(*) AS percent FROM placed GROUP BY ALL""",
)
def share_by(spark, d):
    out = rollup.share_by(orders_with_region(spark, d), F.col("o_orderpriority") == "1-URGENT", ["n_name"])
    return out.orderBy(F.col("percent").desc(), "n_name")


@query(
    "paired_totals",
    """
    WITH w AS (
      SELECT l_partkey,
        CAST(sum(l_quantity) FILTER (l_linestatus='F' AND l_returnflag='A' AND l_quantity > 45) AS BIGINT) AS "F A",
        CAST(sum(l_quantity) FILTER (l_linestatus='O' AND l_returnflag='A' AND l_quantity > 45) AS BIGINT) AS "O A",
        CAST(sum(l_quantity) FILTER (l_linestatus='F' AND l_returnflag='N' AND l_quantity > 45) AS BIGINT) AS "F N",
        CAST(sum(l_quantity) FILTER (l_linestatus='O' AND l_returnflag='N' AND l_quantity > 45) AS BIGINT) AS "O N"
      FROM lineitem GROUP BY 1)
    SELECT *, nullif(coalesce("F A",0) + coalesce("F N",0), 0) AS "F Total",
      nullif(coalesce("O A",0) + coalesce("O N",0), 0) AS "O Total",
      nullif(coalesce("F A",0) + coalesce("O A",0), 0) AS "A", nullif(coalesce("F N",0) + coalesce("O N",0), 0) AS "N"
    FROM w
    """,
)
def paired_totals(spark, d):
    l = table(spark, d, "lineitem")
    cells = [
        F.sum(F.when((F.col("l_linestatus") == s) & (F.col("l_returnflag") == r) & (F.col("l_quantity") > 45),
                     F.col("l_quantity").cast("bigint"))).alias(f"{s} {r}")
        for r in ("A", "N") for s in ("F", "O")
    ]
    return rollup.paired_totals(l.groupBy("l_partkey").agg(*cells), ["A", "N"], ["F", "O"])


@query(
    "category_totals",
    f"""
    WITH {PLACED}, sums AS (
      SELECT yr, nationkey, CAST(coalesce(sum(amount) FILTER (l_returnflag='A'), 0) AS DOUBLE) AS total_a,
             CAST(coalesce(sum(amount) FILTER (l_returnflag='R'), 0) AS DOUBLE) AS total_r
      FROM lines WHERE l_linestatus = 'F' GROUP BY ALL)
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS yr, c_nationkey AS nationkey, total_a, total_r
    FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN sums s ON s.yr = CAST(year(o_orderdate) AS INT) AND s.nationkey = c_nationkey
    """,
)
def category_totals(spark, d):
    facts = lines_with_region(spark, d).where("l_linestatus = 'F'")
    rows = orders_with_nation(spark, d).select("o_orderkey", "yr", "nationkey")
    out = rollup.category_totals(
        rows, facts, ["yr", "nationkey"], "l_returnflag", "amount", {"A": "total_a", "R": "total_r"}
    )
    return doubles(out, "total_a", "total_r")


@query(
    "completeness",
    """
    WITH f AS (
      SELECT event_id, user_id, nullif(CASE WHEN value > 99 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) ELSE '0' END, '99') AS m1,
             CASE WHEN event_type = 'error' AND value > 99.5 THEN 'x' END AS m2 FROM events)
    SELECT event_id, user_id, m1, m2,
      CASE WHEN max(CASE WHEN coalesce(m1, '0') <> '0' OR coalesce(m2, '0') <> '0' THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id) = 0 THEN 'Empty' ELSE 'Complete' END AS completeness
    FROM f
    """,
)
def completeness(spark, d):
    e = table(spark, d, "events")
    whole = F.floor("value").cast("bigint").cast("string")
    f = e.select(
        "event_id", "user_id",
        F.nullif(F.when(F.col("value") > 99, whole).otherwise("0"), F.lit("99")).alias("m1"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 99.5), F.lit("x")).alias("m2"),
    )
    return rollup.completeness(f, ["m1", "m2"], ["user_id"])


@query(
    "with_totals",
    f"""
    WITH {ORDERS}, counts AS (SELECT yr, r_name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS price FROM placed GROUP BY ALL)
    SELECT yr, r_name, n, CAST(price AS DOUBLE) AS price, FALSE AS is_total FROM counts
    UNION ALL SELECT yr, 'FY' || right(CAST(yr AS VARCHAR), 2) || ' - Total', CAST(sum(n) AS BIGINT), CAST(sum(price) AS DOUBLE), TRUE FROM counts GROUP BY yr
    """,
)
def with_totals(spark, d):
    counts = orders_with_region(spark, d).groupBy("yr", "r_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("price")
    )
    name = F.concat(F.lit("FY"), F.right(F.col("yr").cast("string"), F.lit(2)), F.lit(" - Total"))
    return doubles(rollup.with_totals(counts, ["yr"], "r_name", ["n", "price"], name), "price")


@query(
    "with_distinct_total",
    f"""
    WITH {ORDERS}
    SELECT a.r_name, a.o_orderstatus, a.n, b.customers FROM
      (SELECT r_name, o_orderstatus, count(DISTINCT o_custkey) AS n FROM placed GROUP BY ALL) a
      JOIN (SELECT r_name, count(DISTINCT o_custkey) AS customers FROM placed GROUP BY ALL) b USING (r_name)
    """,
)
def with_distinct_total(spark, d):
    o = orders_with_region(spark, d).select("r_name", "o_orderstatus", "o_custkey")
    counts = rollup.count_distinct_entities(o, ["o_custkey"], ["r_name", "o_orderstatus"])
    return rollup.with_distinct_total(counts, o, ["o_custkey"], ["r_name"], "customers")


@query(
    "latest_attribute",
    """
    SELECT o_custkey, CASE WHEN yr >= 2001 THEN o_orderpriority END AS o_orderpriority FROM (
      SELECT o_custkey, o_orderpriority, year(o_orderdate) AS yr,
             row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey) AS rn
      FROM orders) WHERE rn = 1
    """,
)
def latest_attribute(spark, d):
    o = table(spark, d, "orders").withColumn("yr", F.year("o_orderdate"))
    return rollup.latest_attribute(o, "o_custkey", "yr", "o_orderpriority", ["o_orderkey"], floor=2001)


@query(
    "canonical_attribute",
    """
    WITH names AS (
      SELECT o_custkey, arg_min(p, o_orderkey) FILTER (p IS NOT NULL) AS priority
      FROM (SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p FROM orders) GROUP BY 1)
    SELECT l_orderkey, l_linenumber, o.o_custkey, priority
    FROM lineitem JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN names n ON n.o_custkey = o.o_custkey
    """,
)
def canonical_attribute(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority")
    )
    lines = joins.null_safe_join(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"),
        orders.select("o_orderkey", "o_custkey", F.lit("as entered").alias("priority")),
        [("l_orderkey", "o_orderkey")],
    )
    tables = {"orders": orders, "lines": lines}
    return rollup.canonicalise(tables, "o_custkey", "priority", "orders", ["o_orderkey"])["lines"]


@query(
    "concat_distinct",
    """
    SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY pos, o_orderpriority) AS priorities FROM (
      SELECT o_custkey, o_orderpriority, min(o_orderkey) AS pos FROM orders GROUP BY ALL) GROUP BY 1
    """,
)
def concat_distinct(spark, d):
    return rollup.concat_distinct(
        table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", ", ", ["o_orderkey"], "priorities"
    )


@query(
    "concat_distinct_null_text",
    """
    SELECT o_custkey, string_agg(p, '|' ORDER BY p) AS priorities FROM (
      SELECT DISTINCT o_custkey, coalesce(nullif(o_orderpriority, '3-MEDIUM'), 'NA') AS p FROM orders) GROUP BY 1
    """,
)
def concat_distinct_null_text(spark, d):
    o = table(spark, d, "orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priorities")
    )
    return rollup.concat_distinct(o, ["o_custkey"], "priorities", "|", null_text="NA")


@query(
    "set_count",
    """
    WITH m AS (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9000)
    SELECT c_nationkey, (SELECT count(*) FROM m) AS "sum" FROM m
    """,
)
def set_count(spark, d):
    return rollup.set_count(table(spark, d, "customer").where("c_acctbal > 9000"), ["c_nationkey"])
