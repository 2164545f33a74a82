"""Joins and coverage on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.registry import doubles, money, query, table
from tallyloom.functions.values import hit_label
from tallyloom.operators import coverage, joins, reshape
from tallyloom.sources.tables import literal_table

YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def orders_with_nation(spark, d):
    """(nation key, year, priority, status, price) of every order."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"), "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    return joins.null_safe_join(o, c, [("o_custkey", "c_custkey")], "inner")


@query(
    "join_shared_keys",
    """
    SELECT l_orderkey AS orderkey, l_linenumber, l_extendedprice, o_custkey AS custkey, o_orderstatus,
           l_comment AS comment_x, o_comment AS comment_y, c_mktsegment
    FROM (SELECT *, l_returnflag AS l_comment FROM lineitem)
    JOIN (SELECT *, o_orderpriority AS o_comment FROM orders) ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    """,
)
def join_shared_keys(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_extendedprice", F.col("l_returnflag").alias("comment")
    )
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), "o_orderstatus",
        F.col("o_orderpriority").alias("comment"),
    )
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    first = joins.join_shared(lines, orders, exclude=["comment"])
    return joins.join_shared(first, customers)


@query(
    "nullsafe_join",
    """
    SELECT c.c_custkey, c.seg, dim.seg_total
    FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer) c
    LEFT JOIN (SELECT nullif(c_mktsegment, 'BUILDING') AS seg, count(*) AS seg_total FROM customer GROUP BY 1) dim
      ON c.seg IS NOT DISTINCT FROM dim.seg
    """,
)
def nullsafe_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    dim = c.groupBy("seg").agg(F.count(F.lit(1)).alias("seg_total"))
    return joins.lookup_left(c, dim, ["seg"])


@query(
    "lookup_left_diffname",
    """
    SELECT n_name, s_name, CASE WHEN s_suppkey IS NOT NULL THEN 'Known' ELSE 'Unknown' END AS status
    FROM nation LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) ON n_nationkey = s_nationkey
    """,
)
def lookup_left_diffname(spark, d):
    rich = table(spark, d, "supplier").where("s_acctbal > 5000").select("s_suppkey", "s_name", "s_nationkey")
    out = joins.lookup_left(table(spark, d, "nation"), rich, [("n_nationkey", "s_nationkey")], unique=False)
    return out.select("n_name", "s_name", hit_label(F.col("s_suppkey"), "Known", F.lit("Unknown")).alias("status"))


@query(
    "cover_enrich",
    """
    SELECT l_orderkey AS orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus, o_orderpriority
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    """,
)
def cover_enrich(spark, d):
    tables = {
        "cover": table(spark, d, "orders").select(
            F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_orderstatus", "o_orderpriority",
            F.lit("cover").alias("screen"),
        ),
        "lines": table(spark, d, "lineitem").select(
            F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity", F.lit("lines").alias("screen")
        ),
    }
    return joins.enrich_from_cover(tables, "cover", exclude=["screen"])["lines"].drop("screen")


@query(
    "complete_against",
    """
    WITH grid AS (
      SELECT n_nationkey AS nationkey, CAST(y AS INT) AS yr, p AS o_orderpriority
      FROM nation, unnest([1995,1996,1997,1998,1999,2000,2001,2002]) AS a(y), unnest(['1-URGENT','2-HIGH','9-NEW']) AS b(p)),
    found AS (
      SELECT c_nationkey AS nationkey, CAST(year(o_orderdate) AS INT) AS yr, o_orderpriority, o_orderkey
      FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT g.nationkey, g.yr, g.o_orderpriority, f.o_orderkey, f.o_orderkey IS NULL AS missing
    FROM grid g LEFT JOIN found f ON g.nationkey = f.nationkey AND g.yr = f.yr AND g.o_orderpriority = f.o_orderpriority
    """,
)
def complete_against(spark, d):
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"))
    grid = coverage.expand_grid(
        nations, {"yr": [*YEARS, 2002], "o_orderpriority": ["1-URGENT", "2-HIGH", "9-NEW"]}
    )
    found = orders_with_nation(spark, d).select("nationkey", "yr", "o_orderpriority", "o_orderkey")
    return coverage.complete_against(found, grid, ["nationkey", "yr", "o_orderpriority"], "missing")


@query(
    "unexpected_rows",
    """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
    """,
)
def unexpected_rows(spark, d):
    expected = literal_table(spark, {"o_orderpriority": "string"}, [("1-URGENT",), ("2-HIGH",)])
    return coverage.unexpected(
        table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), expected, ["o_orderpriority"]
    )


@query(
    "expand_grid",
    """
    SELECT r_name, n_name, CAST(y AS INT) AS yr FROM region JOIN nation ON n_regionkey = r_regionkey,
      unnest([1995,1996,1997,1998,1999,2000,2001]) AS a(y)
    """,
)
def expand_grid(spark, d):
    places = joins.null_safe_join(
        table(spark, d, "nation"), table(spark, d, "region"), [("n_regionkey", "r_regionkey")]
    ).select("r_name", "n_name")
    return coverage.expand_grid(places, {"yr": YEARS})


@query(
    "missing_members",
    """
    WITH seen AS (
      SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS yr, c_nationkey AS nationkey
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus = 'F' AND o_totalprice > 450000)
    SELECT p.yr, n_nationkey AS nationkey FROM (SELECT DISTINCT yr FROM seen) p, nation
    WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.yr = p.yr AND s.nationkey = n_nationkey)
    """,
)
def missing_members(spark, d):
    seen = orders_with_nation(spark, d).where("o_orderstatus = 'F' and o_totalprice > 450000")
    roster = table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"))
    return coverage.missing_members(seen, roster, "yr", "nationkey")


def _totals_of(spark, d, kind: str):
    e = table(spark, d, "events").where(F.col("event_type") == kind)
    return e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum(money("value")).alias(kind))


@query(
    "outer_measures",
    """
    SELECT user_id, day, CAST(a.v AS DOUBLE) AS click, CAST(b.v AS DOUBLE) AS "view", CAST(c.v AS DOUBLE) AS purchase
    FROM (SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events WHERE event_type='click' GROUP BY ALL) a
    FULL JOIN (SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events WHERE event_type='view' GROUP BY ALL) b USING (user_id, day)
    FULL JOIN (SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events WHERE event_type='purchase' GROUP BY ALL) c USING (user_id, day)
    """,
)
def outer_measures(spark, d):
    frames = [_totals_of(spark, d, kind) for kind in ("click", "view", "purchase")]
    return doubles(joins.outer_measures(frames, ["user_id", "day"]), "click", "view", "purchase")


@query(
    "inner_measures",
    """
    SELECT p_partkey, p_name, CAST(qty AS DOUBLE) AS qty, CAST(revenue AS DOUBLE) AS revenue, discounted
    FROM part
    JOIN (SELECT l_partkey AS p_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY 1) USING (p_partkey)
    JOIN (SELECT l_partkey AS p_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem WHERE l_returnflag='R' GROUP BY 1) USING (p_partkey)
    JOIN (SELECT l_partkey AS p_partkey, count(*) AS discounted FROM lineitem WHERE l_discount > 0.08 GROUP BY 1) USING (p_partkey)
    """,
)
def inner_measures(spark, d):
    lines = table(spark, d, "lineitem")
    by = F.col("l_partkey").alias("p_partkey")
    frames = [
        table(spark, d, "part").select("p_partkey", "p_name"),
        lines.groupBy(by).agg(F.sum(money("l_quantity")).alias("qty")),
        lines.where("l_returnflag = 'R'").groupBy(by).agg(F.sum(money("l_extendedprice")).alias("revenue")),
        lines.where("l_discount > 0.08").groupBy(by).agg(F.count(F.lit(1)).alias("discounted")),
    ]
    return doubles(joins.inner_measures(frames, ["p_partkey"]), "qty", "revenue")


@query(
    "keep_ids",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def keep_ids(spark, d):
    ids = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.keep_ids(lines, ids, [("l_orderkey", "o_orderkey")])


@query(
    "align_key_types",
    """
    SELECT o_orderkey, n FROM orders JOIN (SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders GROUP BY 1)
      ON CAST(year(o_orderdate) AS INT) = y
    """,
)
def align_key_types(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("yr"))
    sizes = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    o, sizes = joins.align_key_types(o, sizes, [("yr", "y")], "int")
    return joins.null_safe_join(o, sizes, [("yr", "y")]).select("o_orderkey", "n")


@query(
    "complete_grid",
    """
    WITH counts AS (
      SELECT r_name, o_orderpriority, CASE WHEN o_totalprice > 495000 THEN CAST(year(o_orderdate) AS INT) ELSE 0 END AS yr, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
    grid AS (
      SELECT r AS r_name, p AS o_orderpriority, CAST(y AS INT) AS yr
      FROM unnest(['AFRICA','AMERICA','ASIA','EUROPE','MARS']) AS a(r),
           unnest(['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW']) AS b(p),
           unnest([1995,1996,1997,1998,1999,2000,2001]) AS c(y))
    SELECT r_name, o_orderpriority, yr, coalesce(n, 0) AS n FROM grid FULL JOIN counts USING (r_name, o_orderpriority, yr)
    """,
)
def complete_grid(spark, d):
    """Counts of large orders per year; all others are a row outside the declared years."""
    nations = joins.null_safe_join(
        table(spark, d, "nation"), table(spark, d, "region"), [("n_regionkey", "r_regionkey")]
    ).select("n_nationkey", "r_name")
    o = orders_with_nation(spark, d).withColumn("yr", F.when(F.col("o_totalprice") > 495000, F.col("yr")).otherwise(0))
    counts = (
        joins.lookup_left(o, nations, [("nationkey", "n_nationkey")])
        .groupBy("r_name", "o_orderpriority", "yr").agg(F.count(F.lit(1)).alias("n"))
    )
    axes = {"r_name": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MARS"], "o_orderpriority": PRIORITIES, "yr": YEARS}
    return coverage.complete(counts, axes, {"n": 0}, unique=True)


@query(
    "contingency",
    """
    WITH o AS (SELECT CASE WHEN o_totalprice > 499000 THEN CAST(year(o_orderdate) AS INT) ELSE 0 END AS yr, o_orderstatus, o_orderpriority FROM orders),
    ax AS (SELECT yr, o_orderstatus, o_orderpriority FROM
        (SELECT DISTINCT yr FROM o), (SELECT DISTINCT o_orderstatus FROM o), (SELECT DISTINCT o_orderpriority FROM o)),
    c AS (SELECT yr, o_orderstatus, o_orderpriority, count(*) AS n FROM o GROUP BY ALL)
    SELECT yr, o_orderstatus, o_orderpriority, coalesce(n, 0) AS "count" FROM ax LEFT JOIN c USING (yr, o_orderstatus, o_orderpriority)
    """,
)
def contingency(spark, d):
    yr = F.when(F.col("o_totalprice") > 499000, F.year("o_orderdate")).otherwise(0)
    o = table(spark, d, "orders").withColumn("yr", yr)
    return coverage.contingency(o, ["yr", "o_orderstatus", "o_orderpriority"])


@query(
    "override_cells",
    """
    SELECT r_name, o_orderpriority, CASE WHEN r_name = 'ASIA' AND o_orderpriority = '5-LOW' THEN 0 ELSE n END AS n
    FROM (SELECT r_name, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
    """,
)
def override_cells(spark, d):
    nations = joins.null_safe_join(
        table(spark, d, "nation"), table(spark, d, "region"), [("n_regionkey", "r_regionkey")]
    ).select("n_nationkey", "r_name")
    counts = (
        joins.lookup_left(orders_with_nation(spark, d), nations, [("nationkey", "n_nationkey")])
        .groupBy("r_name", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    )
    fixes = literal_table(
        spark, {"r_name": "string", "o_orderpriority": "string", "n": "bigint"}, [("ASIA", "5-LOW", 0)]
    )
    return reshape.override_cells(counts, fixes, ["r_name", "o_orderpriority"], "n")
