"""History, versions and file lineage on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyloom.bindings.registry import query, table
from tallyloom.functions.values import unify_alias
from tallyloom.operators import history
from tallyloom.functions.names import prefix_keys
from tallyloom.operators import joins
from tallyloom.sources import ledger, publish, tables
from tallyloom.sources.staging import stage, staging_folder


@query(
    "merge_history",
    """
    WITH merged AS (
      SELECT o_orderkey, o_custkey, upper(o_orderpriority) AS element, CAST(year(o_orderdate) AS INT) AS yr, 'history' AS origin
      FROM orders WHERE year(o_orderdate) < 1999
      UNION ALL SELECT o_orderkey, o_custkey, upper(o_orderpriority), CAST(year(o_orderdate) AS INT), 'extract'
      FROM orders WHERE year(o_orderdate) >= 1999)
    SELECT o_orderkey, o_custkey, CASE WHEN element IN ('1-URGENT', '2-HIGH') THEN '1-URGENT' ELSE element END AS element, yr, origin
    FROM merged
    QUALIFY row_number() OVER (PARTITION BY o_custkey, yr, CASE WHEN element IN ('1-URGENT', '2-HIGH') THEN '1-URGENT' ELSE element END
                               ORDER BY o_orderkey DESC) = 1
    """,
)
def merge_history(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.lower("o_orderpriority").alias("element"), F.year("o_orderdate").alias("yr")
    )
    old = o.where("yr < 2000").withColumn("origin", F.lit("history"))
    new = o.where("yr >= 1999").withColumn("origin", F.lit("extract"))
    return history.merge_history(
        old, new, "yr", new, ["o_custkey", "yr", "element"], ["o_orderkey"],
        {"element": unify_alias(F.col("element"), ["1-URGENT", "2-HIGH"], "1-URGENT")},
    )


@query(
    "overwrite_periods",
    """
    SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS yr,
      CASE WHEN year(o_orderdate) >= 1999 THEN 'extract' ELSE 'history' END AS origin FROM orders
    """,
)
def overwrite_periods(spark, d):
    """A stored history in which an extract replaced only its own years."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    path = f"{staging_folder(spark)}/history-{uuid.uuid4().hex}"
    tables.overwrite_periods(o.withColumn("origin", F.lit("history")), path, "yr")
    tables.overwrite_periods(o.where("yr >= 1999").withColumn("origin", F.lit("extract")), path, "yr")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "yr", "origin")


@query(
    "publish_roundtrip",
    "SELECT o_orderkey, o_orderstatus, 'second' AS origin FROM orders WHERE o_orderstatus <> 'P'",
)
def publish_roundtrip(spark, d):
    """Two published versions, the older one retired; the latest is read back."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    root = f"{staging_folder(spark)}/versions-{uuid.uuid4().hex}"
    publish.publish({"Orders": o.withColumn("origin", F.lit("first"))}, root, "data_for_R", "v1", "all")
    second = o.where("o_orderstatus <> 'P'").withColumn("origin", F.lit("second"))
    publish.publish({"Orders": second}, root, "data_for_R", "v2", "without pending")
    publish.retire(spark, root, "data_for_R", "v1")
    return publish.read_version(spark, root, "DATA_for_r", "orders")


@query(
    "lineage_scan",
    "SELECT c_custkey, 'customer.parquet' AS source_file, CAST(NULL AS DATE) AS pull_date FROM customer",
)
def lineage_scan(spark, d):
    return tables.read_with_lineage(spark, f"{d}/customer*.parquet").select("c_custkey", "source_file", "pull_date")


@query("row_order", "SELECT l_orderkey, l_partkey, file_row_number AS row_ix FROM (SELECT *, row_number() OVER () - 1 AS file_row_number FROM lineitem)")
def row_order(spark, d):
    return tables.with_row_order(table(spark, d, "lineitem")).select("l_orderkey", "l_partkey", "row_ix")


@query(
    "read_table_set",
    """
    SELECT 'customer' AS screen, CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
    """,
)
def read_table_set(spark, d):
    screens = tables.read_table_set(
        spark, d, ["customer", "supplier"], overrides={"c_custkey": "string", "s_suppkey": "string"}, suffix=".parquet"
    )
    parts = [
        df.select(F.lit(n).alias("screen"), F.col({"customer": "c_custkey", "supplier": "s_suppkey"}[n]).alias("code"),
                  F.col(f"{n[0]}_name").alias("name"))
        for n, df in screens.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "read_lookup",
    """
    SELECT p_brand, p_type, p_partkey FROM (
      SELECT p_brand, p_type, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1
    """,
)
def read_lookup(spark, d):
    return tables.read_lookup(spark, f"{d}/part.parquet", unique_on=["p_brand"], order_by=["p_partkey"]).select(
        "p_brand", "p_type", "p_partkey"
    )


@query("csv_roundtrip", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip FROM supplier")
def csv_roundtrip(spark, d):
    """A CSV dimension read as text, so that leading zeros stay."""
    path = f"{staging_folder(spark)}/csv-{uuid.uuid4().hex}"
    s = table(spark, d, "supplier").select(
        "s_suppkey", "s_name", F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("zip")
    )
    s.write.csv(path, header=True)
    return tables.read_table(spark, path, "csv")


SCREENS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}


@query(
    "row_order_csv",
    " UNION ALL ".join(
        f"SELECT '{t}' AS screen, CAST({k} AS VARCHAR) AS code, row_number() OVER (ORDER BY {k}) - 1 AS row_ix FROM {t}" for t, k in SCREENS.items()
    ),
)
def row_order_csv(spark, d):
    """Three CSV files in the order of their keys, read in splits of 16 KB."""
    root = f"{staging_folder(spark)}/csv-{uuid.uuid4().hex}"
    for t, k in SCREENS.items():
        rows = table(spark, d, t)
        rows.orderBy(k).coalesce(1).write.csv(f"{root}/{t}", header=True, escape='"', quoteAll=True)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "16384")
    try:
        screens = tables.read_table_set(spark, root, list(SCREENS), "csv", row_order=True)
        parts = [df.select(F.lit(t).alias("screen"), F.col(SCREENS[t]).alias("code"), "row_ix") for t, df in screens.items()]
        return stage(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    finally:
        spark.conf.set(size, before)


@query(
    "extract_ledger",
    """
    SELECT CASE WHEN s_suppkey % 3 = 2 THEN 'second' ELSE 'first' END AS batch, 'supplier_2024010' || CAST(1 + s_suppkey % 3 AS VARCHAR) || '.parquet' AS source_file,
           CAST('2024-01-0' || CAST(1 + s_suppkey % 3 AS VARCHAR) AS DATE) AS pull_date, s_suppkey FROM supplier
    """,
)
def extract_ledger(spark, d):
    """Two dated extracts are read and recorded; when the third has come, only it is read."""
    root = f"{staging_folder(spark)}/extracts-{uuid.uuid4().hex}"
    suppliers = table(spark, d, "supplier").select("s_suppkey")
    batches = []
    for batch, days in (("first", (0, 1)), ("second", (2,))):
        for day in days:
            suppliers.where(F.col("s_suppkey") % 3 == day).write.parquet(f"{root}/in/supplier_2024010{1 + day}.parquet")
        rows, files = ledger.read_unread(spark, f"{root}/in/*/*.parquet", f"{root}/ledger", level=-2)
        batches.append(stage(rows.select(F.lit(batch).alias("batch"), "source_file", "pull_date", "s_suppkey")))
        ledger.record(spark, f"{root}/ledger", files, batch)
    return batches[0].unionByName(batches[1])


@query(
    "publish_pinned",
    """
    SELECT 'v1' AS version, 'first pull' AS description, n_nationkey, n_name FROM nation
    UNION ALL SELECT 'v2', 'second pull', n_nationkey, upper(n_name) || '!' FROM nation WHERE n_nationkey < 10
    """,
)
def publish_pinned(spark, d):
    """Two versions of a table: the pinned older one and the latest, each with its description."""
    root = f"{staging_folder(spark)}/pinned-{uuid.uuid4().hex}"
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    newer = nation.where("n_nationkey < 10").withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!")))
    publish.publish({"Nation": nation}, root, "places", "v1", "first pull")
    publish.publish({"Nation": newer}, root, "places", "v2", "second pull")
    described = publish.manifest(spark, root, "places").select("version", "description")
    pinned = publish.read_version(spark, root, "places", "Nation", "v1").withColumn("version", F.lit("v1"))
    latest = publish.read_version(spark, root, "places", "Nation").withColumn("version", F.lit("v2"))
    return joins.lookup_left(pinned.unionByName(latest), described, ["version"]).select("version", "description", "n_nationkey", "n_name")


@query(
    "join_prefix_keys",
    """
    WITH a AS (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders),
    b AS (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY ALL)
    SELECT a.o_custkey, a.o_orderstatus, a.o_orderpriority AS pri_x, b.o_orderpriority AS pri_y, n
    FROM a JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus
    """,
)
def join_prefix_keys(spark, d):
    """The leading two columns are the key, the third clashes."""
    o = table(spark, d, "orders")
    a = o.select("o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("pri")).distinct()
    b = o.where("o_totalprice > 100000").groupBy("o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("pri")).agg(F.count(F.lit(1)).alias("n"))
    return joins.join_shared(a, b, prefix_keys(a, 2))
