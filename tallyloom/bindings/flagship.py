"""The flagship query: resolution, regional counts by status, yearly totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.registry import query, table
from tallyloom.operators import joins, resolve, rollup


@query(
    "latest_by_region",
    """
    WITH latest AS (
      SELECT * FROM (
        SELECT o.*, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                       ORDER BY year(o_orderdate) DESC, o_orderdate DESC, o_orderkey) AS rn
        FROM orders o) WHERE rn = 1),
    placed AS (
      SELECT r_name, CAST(year(o_orderdate) AS INT) AS yr, o_custkey, o_orderstatus
      FROM latest JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey),
    counts AS (
      SELECT yr, r_name,
             count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS filled,
             count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS "open",
             count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS pending,
             count(DISTINCT o_custkey) AS customers
      FROM placed GROUP BY ALL)
    SELECT yr, r_name, filled, "open", pending, customers FROM counts
    UNION ALL
    SELECT yr, 'Total', CAST(sum(filled) AS BIGINT), CAST(sum("open") AS BIGINT), CAST(sum(pending) AS BIGINT),
           CAST(sum(customers) AS BIGINT) FROM counts GROUP BY yr
    """,
)
def latest_by_region(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate",
        F.year("o_orderdate").alias("yr"),
    )
    latest = resolve.resolve_hierarchy(
        orders,
        ["o_custkey", "o_orderpriority"],
        [("yr", "max"), ("o_orderdate", "max")],
        ties="first",
        order_by=["o_orderkey"],
    )
    places = joins.null_safe_join(
        table(spark, d, "nation"), table(spark, d, "region"), [("n_regionkey", "r_regionkey")]
    ).select("n_nationkey", "r_name")
    customers = joins.lookup_left(
        table(spark, d, "customer").select("c_custkey", "c_nationkey"), places, [("c_nationkey", "n_nationkey")]
    )
    placed = joins.null_safe_join(latest, customers, [("o_custkey", "c_custkey")])
    out = rollup.counts_with_distinct_total(
        placed,
        entity=["o_custkey"],
        block=["yr"],
        label="r_name",
        category="o_orderstatus",
        names={"F": "filled", "O": "open", "P": "pending"},
        total="customers",
    )
    return out.drop("is_total")
