"""Deduplication and revision resolution on orders, customers and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.registry import doubles, money, query, table
from tallyloom.operators import resolve

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate"]


def orders_by_day(spark, d):
    return table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query(
    "latest_revision",
    """
    SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate
    FROM (SELECT *, max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey, o_orderpriority) AS newest
          FROM orders)
    WHERE CAST(o_orderdate AS DATE) = newest
    """,
)
def latest_revision(spark, d):
    df = orders_by_day(spark, d).select(*ORDER_COLUMNS)
    return resolve.keep_max(df, ["o_custkey", "o_orderpriority"], "o_orderdate")


@query(
    "latest_revision_first_tie",
    """
    SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate FROM (
      SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate,
             row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) AS rn
      FROM orders) WHERE rn = 1
    """,
)
def latest_revision_first_tie(spark, d):
    df = orders_by_day(spark, d).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return resolve.keep_max(
        df, ["o_custkey", "o_orderpriority"], "o_orderdate", ties="first", order_by=["o_orderkey"]
    )


@query(
    "resolve_hierarchy",
    """
    SELECT o_custkey, o_orderstatus, yr, o_totalprice, o_orderkey FROM (
      SELECT o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS yr, o_totalprice, o_orderkey,
             rank() OVER (PARTITION BY o_custkey, o_orderstatus
                          ORDER BY year(o_orderdate) DESC, o_totalprice DESC, o_orderkey) AS rk
      FROM orders) WHERE rk = 1
    """,
)
def resolve_hierarchy(spark, d):
    df = table(spark, d, "orders").select(
        "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("yr"), "o_totalprice", "o_orderkey"
    )
    return resolve.resolve_hierarchy(
        df,
        ["o_custkey", "o_orderstatus"],
        [("yr", "max"), ("revision", "max"), ("o_totalprice", "max"), ("o_orderkey", "min")],
    )


@query(
    "resolve_hierarchy_ties",
    """
    SELECT seg, yr, mo, o_orderkey FROM (
      SELECT nullif(o_orderpriority, '5-LOW') AS seg, CAST(year(o_orderdate) AS INT) AS yr,
             nullif(CAST(month(o_orderdate) AS INT), 12) AS mo, o_orderkey,
             rank() OVER (PARTITION BY nullif(o_orderpriority, '5-LOW'), o_custkey
                          ORDER BY year(o_orderdate) DESC,
                                   nullif(month(o_orderdate), 12) ASC NULLS LAST) AS rk
      FROM orders) WHERE rk = 1
    """,
)
def resolve_hierarchy_ties(spark, d):
    df = table(spark, d, "orders").select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("seg"),
        "o_custkey",
        F.year("o_orderdate").alias("yr"),
        F.nullif(F.month("o_orderdate"), F.lit(12)).alias("mo"),
        "o_orderkey",
    )
    return resolve.resolve_hierarchy(df, ["seg", "o_custkey"], [("yr", "max"), ("mo", "min")]).drop("o_custkey")


@query(
    "resolve_subset",
    """
    SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate
    FROM (SELECT *, max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END)
                    OVER (PARTITION BY o_custkey, o_orderpriority) AS newest FROM orders)
    WHERE (o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) = newest) OR o_orderstatus = 'O'
    """,
)
def resolve_subset(spark, d):
    df = orders_by_day(spark, d).select(*ORDER_COLUMNS)
    status = F.col("o_orderstatus")
    return resolve.resolve_subset(
        df, status == "F", ["o_custkey", "o_orderpriority"], "o_orderdate", status == "O"
    )


@query(
    "top1_per_group",
    """
    SELECT c_nationkey, c_mktsegment, c_custkey, c_acctbal FROM (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment
                                   ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
    WHERE rn = 1
    """,
)
def top1_per_group(spark, d):
    df = table(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey", "c_acctbal")
    return resolve.top_n_per_group(
        df, ["c_nationkey", "c_mktsegment"], [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")]
    )


def _first_or_last(direction: str) -> str:
    return f"""
    SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_orderdate FROM (
      SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
             row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                ORDER BY CAST(o_orderdate AS DATE) {direction}, o_orderkey {direction}) AS rn
      FROM orders) WHERE rn = 1
    """


@query("distinct_on_first", _first_or_last("ASC"))
def distinct_on_first(spark, d):
    df = orders_by_day(spark, d).select(*ORDER_COLUMNS)
    return resolve.distinct_on(df, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query("distinct_on_last", _first_or_last("DESC"))
def distinct_on_last(spark, d):
    df = orders_by_day(spark, d).select(*ORDER_COLUMNS)
    return resolve.distinct_last(df, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query("distinct_projection", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_projection(spark, d):
    return resolve.distinct_rows(table(spark, d, "events"), ["user_id", "event_type"])


@query(
    "total_and_distinct",
    """
    SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, l_quantity,
           CAST(funding AS DOUBLE) AS funding
    FROM (SELECT *, sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_orderkey, l_returnflag) AS funding,
                 row_number() OVER (PARTITION BY l_orderkey, l_returnflag
                                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
          FROM lineitem) WHERE rn = 1
    """,
)
def total_and_distinct(spark, d):
    df = table(spark, d, "lineitem").withColumn("amount", money("l_extendedprice"))
    out = resolve.total_and_distinct(
        df,
        ["l_orderkey", "l_returnflag"],
        "amount",
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
        keep=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
    )
    return doubles(out, "funding")
