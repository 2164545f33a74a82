"""Benchmark decontamination by templates, in DataFrame functions only.

Texts become templates: numbers, units after numbers, and names (capitalised words inside a sentence) are
replaced by typed placeholders, other words are lower-cased and lose their punctuation. Every window of
``window`` template tokens of every document is hashed and joined with the windows of the benchmark. Windows
that lie on one diagonal (position in the document minus position in the item) align the slots of both; a
value of the item must then meet one and the same value of the document wherever it stands. A document is
contaminated by an item if it has ``coverage`` of the item's windows and ``consistency`` of its slot values
agree. So a question with other numbers and names is found, and two unlike fillings of one form are not.

Beside it stands a literal template, the lower-cased tokens themselves, which needs no slots: it finds copies whose
capitals differ, and so names look like words, and items that are mostly numbers and names. A window with fewer than
``literals`` ordinary words says too little as a template; it counts literally only. An item without any typed window
is found where all its literal windows stand; another where ``coverage`` of either kind do.

Documents are known by two hashes of their text, so copies count once and no text is shuffled to be matched. Items are
known by their text and id.

Defined cases: a null or empty text, of a document or an item, has no windows and matches nothing; items shorter than a
window are one window of their own length, so that an item of one word is found wherever the word stands; a null id
labels its item like any other; very long texts are read whole; repeated rows, copies and repeated items get one
verdict each, so there are no ties; an empty table or benchmark finds nothing. Other columns pass through
``drop_contaminated``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh
from tallyloom.sources.staging import stage

# A word after the end of a sentence keeps that mark, which tells it from a name.
TOKEN = r"""(?:[.!?:\n][\s"'(]{0,3})?[\p{L}\p{M}]++|[0-9]++(?:[.,][0-9]++)*+|[%$€£°]"""
MARKS = ".!?:\n\r\t \"'(\x0b\x0c"
# Units of measure and money that may follow a number.
UNITS = (
    "% $ € £ ° mm cm m km mg g kg t ml cl l s min h mph kmh hz w kw v a j n pa k c f mi ft in yd lb lbs oz gal "
    "meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches yard yards "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes "
    "hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees"
).split()
NUMBER, UNIT, NAME = "#number", "#unit", "#name"


def tokens(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(TOKEN), F.lit(0))


def _is_number(x: Column) -> Column:
    return (x >= "0") & (x < ":")


def _kind(all_tokens: Column, x: Column, i: Column) -> Column:
    """Placeholder of token ``x`` at index ``i``, or null for an ordinary word."""
    second = F.substring(x, 2, 1)
    return (
        F.when(_is_number(x), NUMBER)
        .when((i > 0) & F.coalesce(_is_number(F.get(all_tokens, i - 1)), F.lit(False)) & F.lower(x).isin(UNITS), UNIT)
        .when((i > 0) & (x >= "A") & (x < "[") & (second >= "a") & (second < "{"), NAME)
    )


def template(all_tokens: Column) -> Column:
    """Hashes of the template's tokens (``all_tokens``: a column)."""
    return F.transform(
        all_tokens,
        lambda x, i: F.xxhash64(F.coalesce(_kind(all_tokens, x, i), F.lower(F.ltrim(x, F.lit(MARKS))))),
    )


def slots(all_tokens: Column) -> Column:
    """Array of (pos, kind, value) of the placeholders."""
    found = F.transform(
        all_tokens, lambda x, i: F.struct(i.alias("pos"), _kind(all_tokens, x, i).alias("kind"), F.lower(x).alias("value"))
    )
    return F.filter(found, lambda s: s.kind.isNotNull())


def literal(all_tokens: Column) -> Column:
    """Hashes of the tokens as they are, but for case and marks."""
    return F.transform(all_tokens, lambda x: F.xxhash64(F.lower(F.ltrim(x, F.lit(MARKS)))))


#: Kinds of windows.
TYPED, LITERAL = 0, 1


def _windows(hashes: Column, kind: int, width: int) -> Column:
    """Array of window hashes, by position."""
    n = F.size(hashes)
    at = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(kind), F.lit(width), F.slice(hashes, i, width)))


def _text_keys(text: str) -> list[Column]:
    t = F.coalesce(col(text), F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2")]


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 6,
    literals: int = 3,
    coverage: float = 0.3,
    consistency: float = 0.5,
) -> DataFrame:
    """Per distinct text (``k1, k2``) and item: windows found and in all, slots compared and agreeing, ``verbatim``.

    For what only the literal template finds, windows are literal ones and there are no slots.
    """
    named = benchmark.select(col(item_id).alias("item_id"), col(item_text).alias("t")).distinct()
    named = named.select(F.xxhash64("item_id", "t").alias("item"), "item_id", tokens("t").alias("w")).filter(F.size("w") > 0)
    items = stage(named.select("item", "item_id", template(F.col("w")).alias("h"), literal(F.col("w")).alias("g"), slots(F.col("w")).alias("slots"),
                               F.size("w").alias("n")))
    widths = [r.width for r in items.select(F.least("n", F.lit(window)).alias("width")).distinct().collect()]  # at most `window` numbers
    if not widths:
        widths = [window]

    def exploded(frame: DataFrame, keep: list[str], at: str) -> DataFrame:
        """A row per kind, width and window; only the hashes of one kind and width are unfolded at a time."""
        kinds = [F.struct(F.lit(k).alias("kind"), F.lit(w).alias("width"), _windows(F.col(h), k, w).alias("hashes"))
                 for w in widths for k, h in ((TYPED, "h"), (LITERAL, "g"))]
        each = frame.select(*keep, F.inline(F.array(*kinds)))
        return each.select(*keep, "kind", "width", F.posexplode("hashes").alias(at, "hash"))

    own = exploded(items, ["item", "n", "slots"], "at").filter(F.col("width") == F.least("n", F.lit(window)))
    in_slots = F.size(F.filter("slots", lambda s: (s.pos >= F.col("at")) & (s.pos < F.col("at") + F.col("width"))))
    telling = (F.col("kind") == LITERAL) | (F.col("width") - in_slots >= literals)
    own = stage(own.filter(telling).select("item", "kind", "at", "width", "hash"))
    # The tokens are a column of their own: inside a lambda their expression would run once per token.
    docs = df.select(*_text_keys(text), tokens(text).alias("w")).select("k1", "k2", template(F.col("w")).alias("h"), literal(F.col("w")).alias("g"))
    found = exploded(docs, ["k1", "k2"], "pos").join(own, ["hash", "kind", "width"])
    diagonals = stage(
        found.groupBy("k1", "k2", "item", "kind", (F.col("pos") - F.col("at")).alias("shift"))
        .agg(F.collect_set("at").alias("ats"), F.min("at").alias("lo"), (F.max("at") + F.max("width")).alias("hi"))
    )
    covered = diagonals.select("k1", "k2", "item", "kind", F.explode("ats").alias("at")).groupBy("k1", "k2", "item", "kind").agg(
        F.count_distinct("at").alias("windows")
    )
    sizes = own.groupBy("item", "kind").agg(F.count(F.lit(1)).alias("item_windows"))
    typed = own.filter(F.col("kind") == TYPED).select("item").distinct().withColumn("has_typed", F.lit(True))
    counted = covered.join(sizes, ["item", "kind"]).join(typed, "item", "left")
    share = F.when(F.col("has_typed"), F.lit(coverage)).otherwise(F.lit(1.0))
    met = stage(counted.filter(
        (F.col("windows") >= F.col("item_windows") * share) & (F.col("windows") >= F.least(F.lit(2), F.col("item_windows")))
    ).drop("has_typed"))
    spoken = met.filter(F.col("kind") == LITERAL).drop("kind")
    enough = met.filter(F.col("kind") == TYPED).drop("kind")
    diagonals = diagonals.filter(F.col("kind") == TYPED).drop("kind")
    # Slots: only of the texts and items that have enough windows.
    keys = stage(enough.select("k1", "k2").distinct())
    doc_slots = (
        df.select(*_text_keys(text), col(text).alias("text")).join(keys, ["k1", "k2"], "left_semi")
        .select("k1", "k2", tokens("text").alias("w"))
        .select("k1", "k2", F.explode(slots(F.col("w"))).alias("s"))
        .select("k1", "k2", F.col("s.pos").alias("pos"), F.col("s.kind").alias("kind"), F.col("s.value").alias("value"))
        .distinct()
    )
    item_slots = items.select("item", F.explode("slots").alias("s")).select(
        "item", F.col("s.pos").alias("at"), F.col("s.kind").alias("kind"), F.col("s.value").alias("own_value")
    )
    aligned = (
        diagonals.join(enough.select("k1", "k2", "item"), ["k1", "k2", "item"], "left_semi")
        .join(item_slots, "item")
        .filter((F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi")))
        .select("k1", "k2", "item", "kind", "own_value", (F.col("at") + F.col("shift")).alias("pos"))
        .join(doc_slots, ["k1", "k2", "pos", "kind"])
    )
    values = aligned.groupBy("k1", "k2", "item", "kind", "own_value").agg(
        F.count_distinct("value").alias("values"), F.min("value").alias("value")
    )
    agreed = values.groupBy("k1", "k2", "item").agg(
        F.count(F.lit(1)).alias("slots"),
        F.sum((F.col("values") == 1).cast("long")).alias("agreeing"),
        F.sum((F.col("values") > 1).cast("long") + ((F.col("values") == 1) & (F.col("value") != F.col("own_value"))).cast("long")).alias("changed"),
    )
    judged = enough.join(agreed, ["k1", "k2", "item"], "left").na.fill(0, ["slots", "agreeing", "changed"])
    judged = judged.filter(F.col("agreeing") >= F.col("slots") * consistency).select(
        "k1", "k2", "item", "windows", "item_windows", "slots", "agreeing",
        ((F.col("changed") == 0) & (F.col("windows") == F.col("item_windows"))).alias("verbatim"), F.lit(TYPED).alias("kind"),
    )
    nothing = F.lit(0).cast("long")
    spoken = spoken.select(
        "k1", "k2", "item", "windows", "item_windows", nothing.alias("slots"), nothing.alias("agreeing"),
        (F.col("windows") == F.col("item_windows")).alias("verbatim"), F.lit(LITERAL).alias("kind"),
    )
    # Where both find an item, the typed windows and slots are told.
    told = F.struct("windows", "item_windows", "slots", "agreeing")
    both = judged.unionByName(spoken).groupBy("k1", "k2", "item").agg(F.min_by(told, "kind").alias("told"), F.max("verbatim").alias("verbatim"))
    return both.join(items.select("item", "item_id"), "item").select("k1", "k2", "item_id", "told.*", "verbatim")


def contamination_report(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """A row per contaminated document and item: ``doc_id, item_id``, windows and slots."""
    found = stage(contaminated(df, benchmark, text, **how))
    ids = df.select(col(doc_id).alias("doc_id"), *_text_keys(text))
    return ids.join(found, ["k1", "k2"]).drop("k1", "k2")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The documents that no benchmark item contaminates; all columns unchanged."""
    found = stage(contaminated(df, benchmark, text, **how).select("k1", "k2").distinct())
    a, b = fresh(df, "k1"), fresh(df, "k2")
    keys = _text_keys(text)
    keyed = df.withColumns({a: keys[0], b: keys[1]})
    clean = keyed.join(found.toDF(a, b), [a, b], "left_anti")
    return clean.select(*[col(c) for c in df.columns])
