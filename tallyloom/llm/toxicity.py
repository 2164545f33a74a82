"""Toxicity by a weighted lexicon, matched with Aho-Corasick automata on folded texts.

Folding maps look-alike letters of other scripts, accents, case, and digits that stand for letters to one
form, and everything else that is no letter or digit to a space; i, l and 1 become one letter. Lexicon terms
are beginnings of folded words, so that ``idiot`` also finds its inflections.

The lexicon is learned from a bounded sample of labelled documents (``sample`` rows per label, by hash of the
id): beginnings of words that are far more frequent in toxic texts, weighted by log odds, cut down to the few
that cover the toxic texts twice over. Hits inside an exception phrase do not count; exceptions are given by
the caller, and learned where a hit with its neighbour recurs in clean texts only. The summed weights, also in
relation to the length, give the score through a logistic curve fitted to the same sample.

Defined cases: null and empty texts score what a text without hits scores; texts are read whole, however long; repeated
rows score alike; terms that tie in weight are ordered by their letters; without labelled rows of both kinds every
score is 0; an empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import col, held_out
from tallyloom.sources.staging import stage

# Letters of other scripts that look like Latin ones, and digits that stand for letters.
LOOKALIKES = dict(zip("авсԁеһіјкӏмнорԛѕтуԝхαβεικνορτυχɑɡ", "abcdehijklmhopqstywxabeiknoptuxag", strict=True))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
PREFIXES = range(3, 9)


class _Fold(dict):
    """Translation table that folds a character when it is first met."""

    def __missing__(self, code: int) -> str:
        c = unicodedata.normalize("NFKD", chr(code).casefold())[:1].casefold()
        c = LOOKALIKES.get(c, DIGITS.get(c, c))
        self[code] = out = "i" if c == "l" else c if c.isalnum() else " "
        return out


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """The folded text, with a space in front of its first word."""
    return " " + text.translate(_FOLD) if text else " "


def beginnings(folded: str) -> set[str]:
    """Beginnings of three to eight letters of the words of a folded text."""
    return {w[:n] for w in set(folded.split()) for n in PREFIXES if n <= len(w)}


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, exception phrases, and the curve that turns sums into scores."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = (-4.0, 8.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        a = ahocorasick.Automaton()
        for term, w in self.weights.items():
            a.add_word(f" {term}", (len(term), w))
        for phrase in self.exceptions:
            if (p := fold(phrase).rstrip()) and p not in a:
                a.add_word(p, (len(p) - 1, None))
        if not len(a):
            return None
        a.make_automaton()
        return a

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.curve:  # nothing was learned
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.curve), -30, 30)))


def hits(a: ahocorasick.Automaton | None, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the hits outside exception phrases."""
    found = [(end - n + 1, end + 1, w) for end, (n, w) in a.iter(folded)] if a else []
    spared = [(s, e) for s, e, w in found if w is None]
    # Exception phrases of a text are few; each hit is tried against those.
    return [(s, e, w) for s, e, w in found if w is not None and not any(x <= s and e <= y for x, y in spared)]


def features(a: ahocorasick.Automaton | None, text: str | None) -> tuple[float, ...]:
    """1, any hit, and the logarithms of the summed weights and of those per 1,000 words."""
    folded = fold(text)
    total = sum(w for _, _, w in hits(a, folded))
    return 1.0, float(total > 0), float(np.log1p(total)), float(np.log1p(1000 * total / (folded.count(" ") + 50)))


def training_sample(df: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, sample: int) -> DataFrame:
    """Distinct labelled texts (``text, y``), at most ``sample`` rows per label, none of the held-out rows."""
    rows = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).filter(
        ~held_out("id") & F.col("y").isin(0, 1) & F.col("id").isNotNull()
    )
    chosen = None
    for y in (0, 1):
        part = rows.filter(F.col("y") == y).dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * sample rows of two numbers: the size is bound, so it is broadcast.
    picked = df.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).join(F.broadcast(stage(chosen)), "id")
    return stage(picked.filter("text IS NOT NULL").groupBy("text").agg(F.max("y").alias("y")))


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for b in batches:
        for text, y in zip(b["text"], b["y"], strict=True):
            seen[y].update(beginnings(fold(text)))
    terms = list(seen[0].keys() | seen[1].keys())
    yield pd.DataFrame({"term": terms, "clean": [seen[0][t] for t in terms], "toxic": [seen[1][t] for t in terms]})


def learn(
    df: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = 6000,
    candidates: int = 2000,
    exceptions: Sequence[str] = (),
    least_odds: float = 3.0,
) -> Lexicon:
    """A lexicon from the labelled rows that are not held out."""
    texts = training_sample(df, labels, label, doc_id, text, sample)
    sizes = {r.y: r["count"] for r in texts.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Lexicon({}, tuple(exceptions), ())
    least = max(3, sizes[1] // 200)
    counted = texts.mapInPandas(_counts, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    top = (
        counted.withColumn("odds", odds)
        .filter((F.col("toxic") >= least) & (F.col("odds") >= least_odds))
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term")
        .limit(candidates)
        .collect()
    )
    odds_of = {r.term: r.odds for r in top}

    def which(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"terms": [sorted(beginnings(fold(t)) & odds_of.keys()) for t in b["text"]]})

    # One short list per toxic row of the sample.
    toxic = [set(r.terms) for r in texts.filter("y = 1").mapInPandas(which, "terms array<string>").collect()]
    chosen = cover(toxic, odds_of, least)
    weights = {t: odds_of[t] for t in chosen}
    draft = Lexicon(weights, tuple(exceptions))

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = draft.automaton()
        for b in batches:
            found: Counter = Counter()
            for text, y in zip(b["text"], b["y"], strict=True):
                folded = fold(text)
                found.update({(p, y) for s, e, _ in hits(a, folded) for p in around(folded, s, e)})
            yield pd.DataFrame([(p, y, n) for (p, y), n in found.items()], columns=["phrase", "y", "n"])

    by_phrase = texts.mapInPandas(neighbours, "phrase string, y int, n long").groupBy("phrase").agg(
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic")
    )
    spared = [r.phrase for r in by_phrase.filter((F.col("clean") >= 3) & (F.col("toxic") == 0)).orderBy(F.desc("clean"), "phrase").limit(candidates).collect()]
    lexicon = Lexicon(weights, (*exceptions, *spared))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = lexicon.automaton()
        for b in batches:
            yield pd.DataFrame({"x": [list(features(a, t)) for t in b["text"]], "y": b["y"]})

    rows = texts.mapInPandas(measured, "x array<double>, y int").collect()  # four numbers per row of the sample
    curve = fit(np.array([r.x for r in rows]), np.array([r.y for r in rows], float))
    return Lexicon(weights, lexicon.exceptions, tuple(map(float, curve)))


def around(folded: str, start: int, end: int) -> list[str]:
    """The hit's word with the word before it, and with the word after it."""
    end = folded.find(" ", end) if " " in folded[end : end + 64] else end
    word = folded[start:end]
    before, after = folded[max(0, start - 48) : start].split(), folded[end : end + 48].split()
    return [f"{x} {word}" for x in before[-1:]] + [f"{word} {x}" for x in after[:1] if len(after) > 1]


def cover(texts: Sequence[set[str]], odds: dict[str, float], least: int, times: int = 2) -> list[str]:
    """Few terms so that texts hold ``times`` of them where they can; each adds at least ``least`` texts."""
    where: dict[str, set[int]] = {t: set() for t in odds}
    for i, terms in enumerate(texts):
        for t in terms:
            where[t].add(i)
    need, chosen = Counter({i: times for i in range(len(texts))}), []
    while where:
        gain = {t: sum(need[i] > 0 for i in at) for t, at in where.items()}
        best = max(gain, key=lambda t: (gain[t], len(t), odds[t], t))
        if gain[best] < least:
            break
        chosen.append(best)
        for i in where[best]:
            need[i] -= 1
        # A term's own beginnings and continuations tell the same thing once more.
        where = {t: at for t, at in where.items() if not (t.startswith(best) or best.startswith(t))}
    return chosen


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method; the classes weigh the same."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curvature, gradient)
    return w


def scored(df: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted, n_hits``."""

    @F.pandas_udf(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_hits", T.LongType())]))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = lexicon.automaton()
        for b in batches:
            x = np.array([features(a, t) for t in b], float).reshape(-1, 4)
            counts = [len(hits(a, fold(t))) if row[1] else 0 for t, row in zip(b, x, strict=True)]
            yield pd.DataFrame({"score": lexicon.score(x), "n_hits": counts})

    out = df.select(col(doc_id).alias("doc_id"), score(F.coalesce(col(text), F.lit(""))).alias("s"))
    return out.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "s.score",
        (F.col("s.score") >= threshold).cast("int").alias("predicted"),
        "s.n_hits",
    )
