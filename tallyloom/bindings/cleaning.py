"""Cleaning, recoding and parsing of columns over whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.bindings.registry import doubles, money, query, table
from tallyloom.functions import values as V
from tallyloom.functions.html import html_unescape
from tallyloom.operators import hygiene, rollup


@query(
    "normalise_id",
    "SELECT c_custkey, '1' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || 'A1' AS id FROM customer",
)
def normalise_id(spark, d):
    raw = F.concat(F.lit("[1 "), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit(" A1]"))
    return table(spark, d, "customer").select("c_custkey", V.normalise_id(raw).alias("id"))


# The entities that the pages hold; a test sees to it that there are no others.
PAGE_ENTITIES = {"&middot;": "\u00b7", "&copy;": "\u00a9", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&nbsp;": "\u00a0", "&#39;": "''", "&amp;": "&"}
_DECODED = "html"
for _entity, _char in PAGE_ENTITIES.items():
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_char}')"


@query(
    "html_unescape",
    f"""SELECT page_id, url, {_DECODED} AS html, chr(65 + CAST(page_id % 26 AS INT)) || '<' AS numeric FROM pages""",
)
def html_unescape_pages(spark, d):
    code = (F.col("page_id") % 26 + 65).cast("string")
    numeric = F.concat(F.lit("&#"), code, F.lit(";&#x3C;"))
    return table(spark, d, "pages").select(
        "page_id", "url", html_unescape(F.col("html")).alias("html"), html_unescape(numeric).alias("numeric")
    )


@query(
    "sentinel_nulls",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL
                           WHEN c_mktsegment = 'HOUSEHOLD' THEN 'nan' ELSE c_mktsegment END AS segment,
           nullif(c_mktsegment, 'FURNITURE') AS involvement FROM customer
    """,
)
def sentinel_nulls(spark, d):
    seg = F.col("c_mktsegment")
    dirty = table(spark, d, "customer").select(
        "c_custkey",
        F.when(seg == "BUILDING", "nan").when(seg == "MACHINERY", "").when(seg == "HOUSEHOLD", " nan ").otherwise(seg)
        .alias("segment"),
        F.when(seg == "FURNITURE", "SeLect").otherwise(seg).alias("involvement"),
    )
    return hygiene.null_values_like(hygiene.clean_strings(dirty), ["involve"], ["none", "select"])


@query("trim_all", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trim_all(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.concat(F.lit("\t  "), F.col("c_name"), F.lit("\r\n ")).alias("c_name"),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("c_mktsegment"),
    )
    return hygiene.clean_strings(c, sentinels=())


@query(
    "trim_documents",
    r"""
    SELECT doc_id, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(32)
      || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198)
      || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)) AS text
    FROM documents
    """,
)
def trim_documents(spark, d):
    return hygiene.clean_strings(table(spark, d, "documents").select("doc_id", "text"), sentinels=())


@query(
    "alias_unify",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'FIRST' ELSE upper(o_orderpriority) END AS element
    FROM orders
    """,
)
def alias_unify(spark, d):
    p = F.col("o_orderpriority")
    mixed = F.when(p == "2-HIGH", "2-high").otherwise(p)
    return table(spark, d, "orders").select(
        "o_orderkey", V.unify_alias(mixed, ["1-URGENT", "2-HIGH"], "FIRST").alias("element")
    )


@query(
    "exclude_values_nullable",
    """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders
    WHERE nullif(o_orderstatus, 'P') IS NULL OR nullif(o_orderstatus, 'P') NOT IN ('F')
    """,
)
def exclude_values_nullable(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return hygiene.exclude_values(o, "status", ["F"])


@query(
    "dropna_any_all",
    """
    WITH e AS (SELECT event_id, nullif(event_type, 'click') AS kind, CASE WHEN value > 50 THEN value END AS big FROM events)
    SELECT 'any' AS how, event_id, kind, big FROM e WHERE kind IS NOT NULL AND big IS NOT NULL
    UNION ALL SELECT 'all', event_id, kind, big FROM e WHERE kind IS NOT NULL OR big IS NOT NULL
    """,
)
def dropna_any_all(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.nullif("event_type", F.lit("click")).alias("kind"),
        F.when(F.col("value") > 50, F.col("value")).alias("big"),
    )
    parts = [hygiene.drop_nulls(e, ["kind", "big"], how).select(F.lit(how).alias("how"), "*") for how in ("any", "all")]
    return parts[0].unionByName(parts[1])


@query(
    "nonzero_filter",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <> 0 AND l_returnflag <> 'A'",
)
def nonzero_filter(spark, d):
    l = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "A", F.col("l_discount")).alias("l_discount")
    )
    return hygiene.nonzero(l, "l_discount")


@query(
    "membership_filter",
    """
    SELECT o_orderkey, o_orderpriority, CAST(year(o_orderdate) AS INT) AS yr FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND NOT (year(o_orderdate) = 1998 AND o_orderpriority <> '5-LOW')
    """,
)
def membership_filter(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("yr"))
    kept = o.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return kept.where(~((F.col("yr") == 1998) & (F.col("o_orderpriority") != "5-LOW")))


@query(
    "recode",
    """
    SELECT o_orderkey,
      CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS kept,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' END AS nulled FROM orders
    """,
)
def recode(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        V.recode(F.col("o_orderstatus"), {"F": "Filled", "O": "Open"}).alias("kept"),
        V.recode(F.col("o_orderpriority"), {"1-URGENT": "urgent", "2-HIGH": "high"}, default="null").alias("nulled"),
    )


@query(
    "conditional_overwrite",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus IN ('F', 'O') THEN 'Low Unspecified'
      WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Pending Unspecified'
      ELSE nullif(o_orderpriority, '5-LOW') END AS stream FROM orders
    """,
)
def conditional_overwrite(spark, d):
    stream, status = F.nullif("o_orderpriority", F.lit("5-LOW")), F.col("o_orderstatus")
    rules = [
        (stream.isNull() & status.isin("F", "O"), "Low Unspecified"),
        (stream.isNull() & (status == "P"), "Pending Unspecified"),
    ]
    return table(spark, d, "orders").select("o_orderkey", V.overwrite_when(stream, rules).alias("stream"))


@query(
    "labels_join",
    """
    WITH p AS (SELECT p_partkey, nullif(p_type, 'SMALL') AS a, CASE WHEN p_size > 25 THEN p_brand END AS b FROM part)
    SELECT p_partkey,
      CASE WHEN a IS NULL AND b IS NULL THEN 'None' WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a || ' and ' || b END AS cat,
      CASE WHEN a IS NULL AND b IS NULL THEN 'None' WHEN b IS NULL THEN a ELSE coalesce(a, '') || ' and ' || b END AS cat_compat,
      a IS NOT NULL OR b IS NOT NULL AS flagged FROM p
    """,
)
def labels_join(spark, d):
    a, b = F.nullif("p_type", F.lit("SMALL")), F.when(F.col("p_size") > 25, F.col("p_brand"))
    return table(spark, d, "part").select(
        "p_partkey", V.join_labels(a, b).alias("cat"), V.join_labels(a, b, compat=True).alias("cat_compat"),
        (V.join_labels(a, b) != "None").alias("flagged"),
    )


@query(
    "filled_indicator",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' OR l_discount = 0 THEN 0 ELSE 1 END AS filled FROM lineitem
    """,
)
def filled_indicator(spark, d):
    value = F.when(F.col("l_returnflag") != "A", F.when(F.col("l_discount") == 0, "0").otherwise("set"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", V.filled(value).alias("filled"))


@query(
    "binary_category",
    """
    SELECT ShelterType, count(*) AS n FROM (
      SELECT CASE WHEN lower(c_mktsegment) = 'building' THEN 'Building' ELSE 'Other' END AS ShelterType FROM customer) GROUP BY 1
    """,
)
def binary_category(spark, d):
    c = table(spark, d, "customer").select(
        V.binary_category(F.nullif("c_mktsegment", F.lit("MACHINERY")), "building", "Building", "Other").alias("ShelterType")
    )
    return rollup.count_by(c, ["ShelterType"])


@query(
    "classify_first_match",
    """
    SELECT doc_id, CASE WHEN contains(text, 'License') THEN 'License' WHEN contains(text, 'the') THEN 'English'
      WHEN contains(text, 'eau') THEN 'French' ELSE 'Total' END AS kind FROM documents
    """,
)
def classify_first_match(spark, d):
    rules = [("License", "License"), ("the", "English"), ("eau", "French")]
    return table(spark, d, "documents").select("doc_id", V.classify_contains(F.col("text"), rules, "Total").alias("kind"))


@query(
    "parse_amount",
    """
    SELECT c_custkey, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 WHEN c_mktsegment = 'MACHINERY' THEN NULL
      ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DOUBLE) AS amount FROM customer
    """,
)
def parse_amount(spark, d):
    seg = F.col("c_mktsegment")
    text = F.concat(F.lit("USD "), F.format_number(money("c_acctbal"), 2))
    raw = F.when(seg == "BUILDING", "-").when(seg == "MACHINERY", "n/a").otherwise(text)
    return doubles(table(spark, d, "customer").select("c_custkey", V.parse_amount(raw).alias("amount")), "amount")


@query(
    "to_number",
    "SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS bad FROM events",
)
def to_number(spark, d):
    return table(spark, d, "events").select(
        "event_id", V.to_number(F.regexp_extract("props", "[0-9]+", 0)).alias("k"),
        V.to_number(F.col("event_type")).alias("bad"),
    )


@query(
    "parse_dates",
    "SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS newest, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders GROUP BY 1",
)
def parse_dates(spark, d):
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    o = table(spark, d, "orders").select(
        "o_custkey", V.parse_date(text).alias("day"),
        F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(text).alias("odd"),
    )
    return o.groupBy("o_custkey").agg(
        F.max("day").alias("newest"), F.count_if(V.parse_date(F.col("odd")).isNull()).alias("bad")
    )


@query("strip_prefix", "SELECT c_custkey, replace(c_name, 'Customer#', '') AS code FROM customer")
def strip_prefix(spark, d):
    return table(spark, d, "customer").select("c_custkey", V.without_text(F.col("c_name"), "Customer#").alias("code"))


@query(
    "period_label",
    """
    SELECT label, count(*) AS n FROM (SELECT CASE WHEN year(o_orderdate) < 2000 THEN 'FY' || right(CAST(year(o_orderdate) AS VARCHAR), 2)
      ELSE CAST(year(o_orderdate) AS VARCHAR) END AS label FROM orders) GROUP BY 1
    """,
)
def period_label(spark, d):
    o = table(spark, d, "orders").select(V.period_label(F.year("o_orderdate"), range(1995, 2000)).alias("label"))
    return rollup.count_by(o, ["label"])


@query(
    "money_text",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '-$' ELSE '$' END || format('{:,.2f}', abs(c_acctbal)) AS money,
      format('{:,}', c_custkey) AS number,
      '$' || format('{:,.2f}', abs(c_acctbal)) || ' - $' || format('{:,.2f}', abs(c_acctbal) + 1) AS span FROM customer
    """,
)
def money_text(spark, d):
    a = F.abs(money("c_acctbal"))
    return table(spark, d, "customer").select(
        "c_custkey", V.money_text(money("c_acctbal"), 2).alias("money"), V.count_text(F.col("c_custkey")).alias("number"),
        V.range_text(a, a + 1, 2).alias("span"),
    )


@query(
    "tri_state",
    """
    WITH s AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS n, bool_or(o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1)
    SELECT o_custkey, CASE WHEN n = 0 AND NOT u THEN 'Did Not Submit' WHEN n = 0 THEN '0' ELSE CAST(n AS VARCHAR) END AS cell FROM s
    """,
)
def tri_state(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.nullif(F.count_if(F.col("o_orderstatus") == "P"), F.lit(0)).alias("n"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", "Yes")).alias("submitted"),
    )
    return s.select("o_custkey", V.tri_state(F.col("n"), F.col("submitted")).alias("cell"))


@query(
    "multi_flag",
    """
    WITH s AS (SELECT o_custkey, count(DISTINCT o_orderstatus) FILTER (o_totalprice > 300000) AS k FROM orders GROUP BY 1)
    SELECT o_custkey, CAST(k AS INT) AS streams, CASE WHEN k > 1 THEN 'Yes' ELSE 'No' END AS multi FROM s
    """,
)
def multi_flag(spark, d):
    big = F.col("o_totalprice") > 300000
    cells = [F.max(F.when(big & (F.col("o_orderstatus") == s), "Funded")).alias(s) for s in "FOP"]
    s = table(spark, d, "orders").groupBy("o_custkey").agg(*cells)
    streams = [F.col(c) for c in "FOP"]
    return s.select(
        "o_custkey", V.count_equal(streams, "Funded").alias("streams"), V.more_than(streams, "Funded").alias("multi")
    )


@query(
    "status_label",
    """
    SELECT status, count(*) AS n FROM (SELECT CASE o_orderstatus WHEN 'P' THEN 'Did not submit' WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Complete' END AS status
      FROM orders) GROUP BY 1
    """,
)
def status_label(spark, d):
    raw = V.recode(F.col("o_orderstatus"), {"F": "Complete", "O": "Empty"}, default="null")
    o = table(spark, d, "orders").select(V.status_label(raw, "Did not submit", {"Empty": "Complete"}).alias("status"))
    return rollup.count_by(o, ["status"])


@query(
    "threshold_label",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'Funded' ELSE '' END AS funded FROM customer",
)
def threshold_label(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", V.threshold_label(F.col("c_acctbal"), "Funded").alias("funded")
    )
