"""Personal data: patterns, and terms that give protected entities away, in DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers. They are written with possessive repeats
and anchored at the start of a run, so that long runs of one kind of character cost one pass. Places come from
the lengths of what ``split`` and ``regexp_extract_all`` give in turn.

Each entity found is protected: words that reveal it go as well. Over all documents of the corpus, the pointwise mutual
information of term and entity, ln(n(t,e) N / (n(t) n(e))), with n as document frequencies, is set against the
entity's own information ln(N / n(e)); their ratio is 1 for a term that is met only where the entity is. Terms that
``support`` different texts have together with the entity, at a ratio of ``disclosure``, are spans of kind ``term``
wherever they stand in the entity's documents. ``sanitised`` replaces entities by their kind, keeps the first letter
of a disclosing term (generalised), or removes it if the ratio is 1.

Defined cases: null texts count as empty and have no spans; texts are read whole, however long; repeated rows each get
their own row, count each in the frequencies, and are one text for ``support``; spans of different kinds may overlap,
and none can tie; an empty table gives an empty result. Other columns pass through ``sanitised`` unchanged, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh
from tallyloom.sources.staging import stage

KINDS = ("email", "ip", "card", "phone", "term")
# A match starts at the start of a run, or where the match before it ended (\G).
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must contain to match at all; spares most texts the patterns.
NEEDED = ("@", ".", None, "+")
#: A word of letters that stands by itself, marks aside.
TERM = r"""(?<![^\s"'(])\p{L}[\p{L}\p{M}]*+(?=[,;.!?:)"']{0,3}(?:\s|$))"""
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(digits))
    number = F.reverse(digits)

    def value(i: Column) -> Column:
        d = number.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(at, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _valid(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    return (
        F.when(kind == 0, True)
        .when(kind == 1, found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
        .when(kind == 2, F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def _text_keys(t: Column) -> list[Column]:
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2")]


def matches(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row per match of any pattern, valid or not, and one with a null kind for texts without matches.

    ``number, doc_id, k1, k2`` (hashes of the text), ``kind, i, before`` (characters since the match before), ``found``.
    """
    t = F.coalesce(col(text), F.lit(""))
    base = df.select(F.monotonically_increasing_id().alias("number"), col(doc_id).alias("doc_id"), t.alias("t"))
    cut, got = [], []
    for k, (pattern, need) in enumerate(zip(PATTERNS, NEEDED, strict=True)):
        may = F.contains(F.col("t"), F.lit(need)) if need else F.col("t").rlike("[0-9]")
        none = F.array().cast("array<string>")
        cut.append(F.when(may, F.split("t", pattern, -1)).otherwise(none).alias(f"p{k}"))
        got.append(F.when(may, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none).alias(f"m{k}"))
    parts = base.select("number", "doc_id", *_text_keys(F.col("t")), *cut, *got)

    def rows(k: int) -> Column:
        pieces, found = F.col(f"p{k}"), F.col(f"m{k}")
        return F.transform(
            found,
            lambda m, i: F.struct(
                F.lit(k).alias("kind"), i.alias("i"), F.length(F.get(pieces, i)).alias("before"), m.alias("found")
            ),
        )

    every = F.concat(*[rows(k) for k in range(len(PATTERNS))])
    return parts.select("number", "doc_id", "k1", "k2", F.explode_outer(every).alias("x")).select("number", "doc_id", "k1", "k2", "x.*")


def disclosing_terms(held: DataFrame, texts: DataFrame, every_text: DataFrame, support: int, disclosure: float) -> DataFrame:
    """``e, term, ratio``. ``held``: ``k1, k2, e, copies`` of entities in texts; ``texts``: those texts, each once.

    Pairs are made within a document only, and only for entities that enough texts have. Frequencies of terms are
    counted over ``every_text``, a column ``t`` of all documents, and folded in tasks before they are moved.
    """
    terms = texts.select("k1", "k2", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("t", F.lit(TERM), F.lit(0)), F.lower))).alias("term"))
    n_e = held.groupBy("e").agg(F.sum("copies").alias("n_e"))
    n_te = held.join(terms, ["k1", "k2"]).groupBy("e", "term").agg(F.sum("copies").alias("n_te"), F.count(F.lit(1)).alias("texts"))
    n_te = stage(n_te.filter(F.col("texts") >= support).drop("texts"))
    words = every_text.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("t", F.lit(TERM), F.lit(0)), F.lower))).alias("term"))
    n_t = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n = F.lit(float(every_text.count()))
    ratio = F.log(F.col("n_te") * n / (F.col("n_t") * F.col("n_e"))) / F.log(n / F.col("n_e"))
    both = n_te.join(n_e, "e").join(n_t, "term").filter(F.col("n_e") < n)
    return both.withColumn("ratio", ratio).filter(F.col("ratio") >= disclosure).select("e", "term", "ratio")


def disclosing(valid: DataFrame, every_text: DataFrame, support: int, disclosure: float) -> DataFrame:
    """Spans ``k1, k2, start, end, ratio`` of terms that reveal an entity of their text."""
    entity = F.xxhash64("kind", F.lower("found")).alias("e")
    in_rows = valid.select("number", "k1", "k2", entity).distinct()
    held = in_rows.groupBy("k1", "k2", "e").agg(F.count(F.lit(1)).alias("copies"))
    often = held.groupBy("e").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= support).select("e")
    held = stage(held.join(often, "e"))
    keys = held.select("k1", "k2").distinct()
    texts = every_text.select(*_text_keys(F.col("t")), "t").join(keys, ["k1", "k2"], "left_semi")
    texts = stage(texts.groupBy("k1", "k2").agg(F.any_value("t").alias("t")))
    strong = stage(disclosing_terms(held, texts, every_text, support, disclosure))
    wanted = held.join(strong, "e").groupBy("k1", "k2", "term").agg(F.max("ratio").alias("ratio"))
    # Every word of these texts with its place: what lies before it is the sum of the pieces and words so far.
    found, pieces = F.regexp_extract_all("t", F.lit(TERM), F.lit(0)), F.split("t", TERM, -1)
    told = texts.join(wanted.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    each = told.select("k1", "k2", F.posexplode(F.arrays_zip(pieces.alias("p"), found.alias("f"))).alias("i", "x"))
    each = each.select("k1", "k2", "i", F.length("x.p").alias("before"), F.col("x.f").alias("f"))
    so_far = Window.partitionBy("k1", "k2").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    moved = F.coalesce(F.sum(F.col("before") + F.coalesce(F.length("f"), F.lit(0))).over(so_far), F.lit(0))
    placed = each.withColumn("start", (moved + F.col("before")).cast("long")).filter("f IS NOT NULL")
    placed = placed.select("k1", "k2", F.lower("f").alias("term"), "start", (F.col("start") + F.length("f")).alias("end"))
    return placed.join(wanted, ["k1", "k2", "term"]).select("k1", "k2", "start", "end", "ratio")


def _span_rows(df: DataFrame, doc_id: str, text: str, support: int, disclosure: float) -> tuple[DataFrame, DataFrame]:
    """Staged documents (``number, doc_id``) and spans (``number, kind, start, end, ratio``)."""
    found = stage(matches(df, doc_id, text))
    numbers = found.filter("kind IS NULL OR i = 0").select("number", "doc_id", "k1", "k2").distinct()
    before = Window.partitionBy("number", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("found")
    start = F.coalesce(F.sum(F.col("before") + length).over(before), F.lit(0)) + F.col("before")
    placed = found.filter("kind IS NOT NULL").withColumn("start", start.cast("long")).withColumn("end", (F.col("start") + length).cast("long"))
    valid = stage(placed.filter(_valid(F.col("kind"), F.col("found"))))
    every_text = df.select(F.coalesce(col(text), F.lit("")).alias("t"))
    terms = stage(disclosing(valid, every_text, support, disclosure)).join(numbers.select("number", "k1", "k2"), ["k1", "k2"])
    base = valid.select("number", "kind", "start", "end", F.lit(None).cast("double").alias("ratio"))
    return numbers, base.unionByName(terms.select("number", F.lit(KINDS.index("term")).alias("kind"), "start", "end", "ratio"))


def span_report(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = 3, disclosure: float = 0.9
) -> DataFrame:
    """Per document: counts per kind, a checksum of the entities' spans, and all spans as text."""
    numbers, spans = _span_rows(df, doc_id, text, support, disclosure)
    grouped = spans.groupBy("number").agg(
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{x}") for k, x in enumerate(KINDS)],
        F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("s"),
    )
    names = F.array(*map(F.lit, KINDS))

    def said(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x.kind), x.start.cast("string"), x.end.cast("string"))), ",")

    out = numbers.join(grouped, "number", "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{x}", F.lit(0)).cast("long").alias(f"n_{x}") for x in KINDS],
        F.sha2(said(F.filter("s", lambda x: x.kind < KINDS.index("term"))), 256).alias("base_sha256"),
        said(F.col("s")).alias("spans"),
    )


def sanitised(
    df: DataFrame, text: str = "text", support: int = 3, disclosure: float = 0.9
) -> DataFrame:
    """``df`` with entities replaced by ``[KIND]``, disclosing terms cut to their first letter or removed."""
    number = fresh(df, "number")
    numbered = stage(df.withColumn(number, F.monotonically_increasing_id()))
    keyed = numbered.select(col(number).alias("key"), col(text).alias("text"))
    numbers, spans = _span_rows(keyed, "key", "text", support, disclosure)
    grouped = (
        spans.join(numbers, "number").groupBy(F.col("doc_id").alias(number))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "ratio"))).alias(fresh(df, "spans")))
    )
    s, t = F.col(fresh(df, "spans")), F.coalesce(col(text), F.lit(""))

    def label(x: Column) -> Column:
        term = F.when(x.ratio >= 1, F.lit("")).otherwise(F.concat(t.substr((x.start + 1).cast("int"), F.lit(1)), F.lit("*")))
        names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
        return F.when(x.kind == KINDS.index("term"), term).otherwise(F.get(names, x.kind))

    # Spans of different kinds may overlap: what lies before the end reached so far is not written again.
    rebuilt = F.aggregate(
        s,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a.at, x.end).alias("at"),
            F.when(x.start >= a.at, F.concat(a.out, t.substr((a.at + 1).cast("int"), (x.start - a.at).cast("int")), label(x))).otherwise(a.out).alias("out"),
        ),
        lambda a: F.concat(a.out, t.substr((a.at + 1).cast("int"), F.length(t))),
    )
    joined = numbered.join(grouped, number, "left")
    new = F.when(s.isNotNull(), rebuilt).otherwise(col(text))
    return joined.select(*[new.alias(c) if c == text else col(c) for c in df.columns])
