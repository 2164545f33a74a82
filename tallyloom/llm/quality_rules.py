"""Quality rules whose cutoffs come from the corpus: quantile sketches per language and source.

Every document is measured once. Each measure's quartiles are sketched with Spark's mergeable quantile
summaries (``percentile_approx``: partial summaries per task, merged after the shuffle, so a source that
holds a third of all rows is summarised where its rows lie). A document fails a measure that lies further
than ``reach`` spreads beyond the median of its own language and source. A group's quartiles are drawn towards those
of its language, as if the language added ``min_rows`` rows to it, and a language's likewise towards the whole corpus:
large groups keep their own, and no size is a jump.

Defined cases: a null text counts as empty; an empty text has measures of zero and fails the fixed floor
on words; null languages or sources are groups of their own; very long texts are measured whole; repeated rows are
judged each by themselves and alike, and there is nothing that could tie; an empty table gives an empty result. Other
columns are never read, and whatever their names,
they pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import SPACES, col, fresh
from tallyloom.sources.staging import stage

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A share that may not exceed (or, with ``both``, differ from) the median by ``reach`` spreads."""

    name: str
    top: str
    bottom: str
    #: Least spread, so that a measure which is nearly always zero still allows a little.
    slack: float
    both: bool = False


RULES = (
    Rule("symbol_share", "n_symbols", "word_chars", 0.005),
    Rule("upper_share", "n_upper_words", "n_words", 0.05),
    Rule("dup_line_share", "n_dup_lines", "n_lines", 0.08),
    Rule("repeat_share", "n_repeat_words", "n_words", 0.06),
    Rule("word_length", "word_chars", "n_words", 0.3, both=True),
)


def repeated_words(tokens: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs at least twice in the text."""
    n = len(tokens)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.int64, n)
    pairs = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(tokens),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(tokens),
        len(lines),
        sum(map(bytes.isupper, tokens)),
    )


@F.pandas_udf(T.StructType([T.StructField(x, T.LongType()) for x in MEASURES]))
def _measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=list(MEASURES), dtype="int64")


def measures(text: str) -> Column:
    """A struct of ``MEASURES`` for a text column."""
    return _measures(F.coalesce(col(text), F.lit("")))


def _share(rule: Rule, m: str) -> Column:
    bottom = F.col(f"{m}.{rule.bottom}")
    return F.when(bottom > 0, F.col(f"{m}.{rule.top}") / bottom).otherwise(0.0)


def cutoffs(measured: DataFrame, m: str, lang: str, source: str, reach: float, min_rows: int) -> DataFrame:
    """One row per (language, source): ``lang_key, source_key`` and a low and high limit per rule."""
    base = measured.select(
        col(lang).alias("lang_key"), col(source).alias("source_key"), *[_share(r, m).alias(r.name) for r in RULES]
    )

    def sketch(*keys: str) -> DataFrame:
        quartiles = [F.percentile_approx(r.name, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias(r.name) for r in RULES]
        return base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *quartiles)

    own = sketch("lang_key", "source_key").alias("own")
    by_lang = sketch("lang_key").select("n", F.col("lang_key").alias("l"), *[r.name for r in RULES]).alias("by_lang")
    all_rows = sketch().first()  # one row
    joined = own.join(by_lang, F.col("own.lang_key").eqNullSafe(F.col("by_lang.l")))
    def towards(own: Column, n: Column, parent: Column) -> Column:
        return F.transform(own, lambda x, i: (n * x + min_rows * F.get(parent, i)) / (n + min_rows))

    limits = []
    for r in RULES:
        of_all = F.array(*[F.lit(x) for x in all_rows[r.name] or (0.0,) * 3])
        of_lang = towards(F.col(f"by_lang.{r.name}"), F.col("by_lang.n"), of_all)
        q = towards(F.col(f"own.{r.name}"), F.col("own.n"), of_lang)
        up = F.greatest(q[2] - q[1], F.lit(r.slack)) * reach
        down = F.greatest(q[1] - q[0], F.lit(r.slack)) * reach
        low = q[1] - down if r.both else F.lit(None).cast("double")
        limits += [low.alias(f"{r.name}_low"), (q[1] + up).alias(f"{r.name}_high")]
    return joined.select("lang_key", "source_key", *limits)


def base_failed(m: str) -> Column:
    """The fixed floor: under 50 words, or over half of the words in repeated 3-word windows."""
    n, repeats = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def _judged(df: DataFrame, m: str, limits: DataFrame, lang: str, source: str, verdict: str) -> DataFrame:
    """``df`` with its verdict; the limits are one row per group and joined as Spark's size check decides."""
    names = {c: fresh(df, c) for c in limits.columns}
    right = limits.select(*[F.col(c).alias(n) for c, n in names.items()])
    joined = df.join(
        right,
        col(lang).eqNullSafe(F.col(names["lang_key"])) & col(source).eqNullSafe(F.col(names["source_key"])),
        "left",
    )
    fails = base_failed(m)
    for r in RULES:
        share = _share(r, m)
        fails |= share > F.col(names[f"{r.name}_high"])
        if r.both:
            fails |= share < F.col(names[f"{r.name}_low"])
    return joined.withColumn(verdict, ~F.coalesce(fails, F.lit(True))).drop(*names.values())


def quality_report(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    reach: float = 6.0,
    min_rows: int = 200,
) -> DataFrame:
    """Per document: its id, the measures, ``base_failed`` and ``kept``."""
    measured = stage(
        df.select(col(doc_id).alias("doc_id"), col(lang).alias("lang"), col(source).alias("source"), measures(text).alias("m"))
    )
    limits = stage(cutoffs(measured, "m", "lang", "source", reach, min_rows))
    judged = _judged(measured, "m", limits, "lang", "source", "kept")
    return judged.select("doc_id", "m.*", base_failed("m").alias("base_failed"), "kept")


def keep_good(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    reach: float = 6.0,
    min_rows: int = 200,
) -> DataFrame:
    """The rows of ``df`` that pass, all their columns unchanged.

    Texts are measured once for the cutoffs and once for the verdicts: that costs processor time where
    a join back to the texts would shuffle them whole.
    """
    m, verdict = fresh(df, "measures"), fresh(df, "kept")
    measured = df.withColumn(m, measures(text))
    narrow = stage(measured.select(col(lang).alias("lang"), col(source).alias("source"), F.col(m).alias("m")))
    limits = stage(cutoffs(narrow, "m", "lang", "source", reach, min_rows))
    judged = _judged(measured, m, limits, lang, source, verdict)
    return judged.filter(F.col(verdict)).select(*[col(c) for c in df.columns])
