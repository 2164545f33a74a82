"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a budget of words. A budget of at least the source's size is first met by complete epochs
over all of its documents; what remains is drawn without replacement with exponential keys, -ln(u) over the
document's quality weight, in the order of the keys until the budget is met. The uniform u is a hash of the
document, so reruns draw alike.

No source is sorted as a whole. Keys fall into ``bins`` ordered bins, whose words are summed in tasks first;
the bin in which a budget runs out is divided again, until it is a few documents, and only those are ordered.

Defined cases: a null text has no words; a null source is a source of its own, the last in order; repeated
rows share a key and are taken one by one, as rows whose keys tie are; documents without words are never drawn, and
``mix`` drops them; very long texts count with all their words, and the last one drawn is taken whole if that
comes nearer to the budget; an empty table gives an empty mix. Other columns pass through ``mix`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, col, fresh
from tallyloom.sources.staging import stage

#: Keys lie in [0, RANGE) once they are whole numbers.
RANGE = 1 << 50


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str) -> Column:
    """Between 0.1 and 1: the share of letters, digits and single spaces among the characters."""
    t = F.coalesce(col(text), F.lit(""))
    odd = F.length(F.translate(t, "#*$%&|<>!=_{}[]\\^~@", ""))
    return F.when(F.length(t) > 0, F.greatest(F.lit(0.1), odd / F.length(t))).otherwise(F.lit(1.0))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Budget per source: weights in turn by the order of names, at most ``cap`` times its size.

    ``sizes`` has one row per source (``source``, ``source_size``). What the caps cut off is shared again by
    weight until no source is above its cap; each round is an aggregate over the sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.row_number().over(order) - 1) % len(weights)
    table = stage(sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int"))))
    limit = F.col("source_size") * float(cap)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        capped = F.col("weight") * level >= limit
        used, open_weight = table.agg(F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))).first()
        raised = (share * total - (used or 0.0)) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(limit, F.col("weight") * level).alias("target"))


def _drawn(rows: DataFrame, budgets: DataFrame, bins: int, few: int) -> DataFrame:
    """Per source the key up to which documents are drawn (``edge``): those with ``key < edge``, then ``last``.

    ``budgets`` has ``source`` and ``rest``; ``rows`` has ``source``, ``size`` and a whole-number ``key``.
    """
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    state = stage(budgets.select("source", F.col("rest").cast("double"), F.lit(0).cast("long").alias("lo"), F.lit(RANGE).cast("long").alias("hi")))
    done = None
    while True:
        step = F.ceil((F.col("s.hi") - F.col("s.lo")) / bins)
        inside = rows.alias("r").join(state.alias("s"), same("r", "s") & (F.col("r.key") >= F.col("s.lo")) & (F.col("r.key") < F.col("s.hi")))
        summed = inside.groupBy(
            F.col("s.source").alias("source"), F.col("s.rest").alias("rest"), F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"),
            F.floor((F.col("r.key") - F.col("s.lo")) / step).alias("bin"), step.alias("step"),
        ).agg(F.sum("r.size").alias("words"), F.count(F.lit(1)).alias("docs"))
        upto = Window.partitionBy("source").orderBy("bin")
        cut = (
            summed.withColumn("through", F.sum("words").over(upto))
            .filter("through > rest")
            .withColumn("nth", F.row_number().over(upto))
            .filter("nth = 1")
        )
        start = F.col("lo") + F.col("bin") * F.col("step")
        cut = stage(cut.select(
            "source", (F.col("rest") - F.col("through") + F.col("words")).alias("rest"), "docs",
            start.alias("lo"), F.least(start + F.col("step"), F.col("hi")).alias("hi"),
        ))
        small = (F.col("docs") <= few) | (F.col("hi") - F.col("lo") <= 1)
        finished = cut.filter(small).drop("docs")
        done = finished if done is None else done.unionByName(finished)
        state = cut.filter(~small).drop("docs")
        if state.isEmpty():
            return done


def _key(doc_id: str, text: str, quality: Column, seed: int) -> Column:
    """The exponential key as a whole number: 1 - exp(-x) keeps the order of x = -ln(u) / quality and spreads it."""
    drawn = F.xxhash64(F.lit(seed), col(doc_id).cast("string"), col(text))
    uniform = (F.pmod(drawn, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.least(F.floor((1 - F.exp(F.ln(uniform) / quality)) * RANGE), F.lit(RANGE - 1)).cast("long")


def _plan(rows: DataFrame, weights: Sequence[float], share: float, cap: float, bins: int, few: int) -> DataFrame:
    """Per source: its size, target, complete epochs, and the last row drawn beyond them (key and number).

    ``rows``: ``number, source, size, key``, staged.
    """
    goal = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    words = rows.filter("size > 0")
    edges = stage(_drawn(words, goal.filter("rest > 0"), bins, few))
    near = words.alias("r").join(
        edges.alias("e"),
        F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.key") >= F.col("e.lo")) & (F.col("r.key") < F.col("e.hi")),
    )
    order = Window.partitionBy("r.source").orderBy("r.key", "r.number")
    # The last document is drawn whole if that comes nearer to the budget than leaving it out.
    late = near.withColumn("through", F.sum("r.size").over(order)).filter(F.col("through") - F.col("r.size") / 2 <= F.col("e.rest"))
    last = late.groupBy(F.col("e.source").alias("source")).agg(F.max(F.struct("r.key", "r.number")).alias("last"))
    return stage(
        goal.alias("g")
        .join(edges.alias("e"), F.col("g.source").eqNullSafe(F.col("e.source")), "left")
        .join(last.alias("l"), F.col("g.source").eqNullSafe(F.col("l.source")), "left")
        .select(
            F.col("g.source").alias("plan_source"), "source_size", "target", "epochs", F.col("e.lo").alias("edge"),
            F.col("l.last.key").alias("last_key"), F.col("l.last.number").alias("last_number"),
        )
    )


def _times(row: str, plan: str) -> Column:
    """How often a row is taken; ``row`` and ``plan`` are structs, the latter of the row's source."""
    key, number = F.col(f"{row}.key"), F.col(f"{row}.number")
    early = key < F.col(f"{plan}.edge")
    last_key = F.col(f"{plan}.last_key")
    late = (key < last_key) | ((key == last_key) & (number <= F.col(f"{plan}.last_number")))
    drawn = F.coalesce(early, F.lit(False)) | F.coalesce(late, F.lit(False))
    return F.when(F.col(f"{row}.size") > 0, F.col(f"{plan}.epochs") + drawn.cast("long")).otherwise(F.lit(0).cast("long"))


def mix_report(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    quality: Column | None = None,
    seed: int = 1,
    bins: int = 1024,
    few: int = 10_000,
) -> DataFrame:
    """Per document: its words, its source's words and target, and the words the mix takes of it."""
    quality = quality_weight(text) if quality is None else quality
    number = F.monotonically_increasing_id().alias("number")
    rows = stage(df.select(
        number, col(doc_id).alias("doc_id"), col(source).alias("source"), n_words(text).alias("size"), _key(doc_id, text, quality, seed).alias("key"),
    ))
    plan = _plan(rows, weights, share, cap, bins, few)
    joined = rows.select("doc_id", "source", F.struct("number", "size", "key").alias("r")).join(
        plan.select(F.struct("*").alias("p")), F.col("source").eqNullSafe(F.col("p.plan_source"))
    )
    taken = (_times("r", "p") * F.col("r.size")).cast("long")
    return joined.select("doc_id", "r.size", "p.source_size", "p.target", taken.alias("taken"))


def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    quality: Column | None = None,
    seed: int = 1,
    bins: int = 1024,
    few: int = 10_000,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as in ``df``."""
    quality = quality_weight(text) if quality is None else quality
    draw, own = fresh(df, "draw"), fresh(df, "plan")
    drawn = F.struct(
        F.monotonically_increasing_id().alias("number"), n_words(text).alias("size"), _key(doc_id, text, quality, seed).alias("key")
    )
    numbered = stage(df.withColumn(draw, drawn))
    plan = _plan(numbered.select(f"{draw}.*", col(source).alias("source")), weights, share, cap, bins, few)
    joined = numbered.join(plan.select(F.struct("*").alias(own)), col(source).eqNullSafe(F.col(f"{own}.plan_source")))
    copies = F.sequence(F.lit(1).cast("long"), _times(draw, own))
    kept = joined.filter(_times(draw, own) > 0)
    return kept.select(*[col(c) for c in df.columns], F.explode(copies).alias(own)).drop(own)
