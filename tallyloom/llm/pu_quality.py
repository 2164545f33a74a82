"""Quality by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives and unlabelled web text are enough: with p the share of good texts among the unlabelled,
the risk of calling a text bad is estimated as (unlabelled risk) - p * (positive risk), held at zero or above
so that the model cannot profit from overfitting. p comes from the data: where only good texts lie, unlabelled
texts are p times as dense as positives, so the least ratio of the two over the texts that look best is p.

The model is linear in bounded signals of a text's form and their squares. It is fitted on the driver to at
most ``sample`` positives and ``sample`` unlabelled texts, of which only the signals leave the tasks.

Defined cases: null and empty texts have signals of zero and are scored like any other; texts are read whole, however
long; repeated rows score alike, and scores may tie, as nothing is ranked; without trusted positives every score is 0;
an empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import col, held_out
from tallyloom.llm.quality_rules import measure
from tallyloom.sources.staging import stage


def signals(text: str | None) -> tuple[float, ...]:
    """Signals of form; shares lie between 0 and 1."""
    n, chars, symbols, dup_lines, repeats, lines, upper = measure(text)
    text = text or ""
    tokens = text.split()
    words, letters = max(1, n), max(1, chars)
    ends = sum(text.count(c) for c in ".!?")
    return (
        np.log1p(n) / 10,
        min(1.0, chars / words / 20),
        min(1.0, symbols / letters),
        min(1.0, 5 * symbols / words),
        dup_lines / max(1, lines),
        repeats / words,
        upper / words,
        len(set(tokens)) / words,
        min(1.0, sum(map(text.count, "0123456789")) / letters),
        min(1.0, text.count("|") / words),
        min(1.0, text.count("!!") / words),
        min(1.0, ends / words),
        min(1.0, np.log1p(words / max(1, ends)) / 8),
        min(1.0, np.log1p(words / max(1, lines)) / 8),
        sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / words,
        min(1.0, max(map(len, tokens), default=0) / 100),
    )


@dataclass(frozen=True)
class Model:
    """Centre and scale of the signals, and weights of 1, the scaled signals and their squares."""

    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    prior: float = 0.0

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - np.array(self.centre)) / np.array(self.scale), -4, 4)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(x))
        return _sigmoid(self.design(x) @ np.array(self.weights))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of calling bad what has score ``z``, and its slope."""
    s = _sigmoid(z)
    return np.logaddexp(0, z), s


def _step(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = _sigmoid(z)
    return s, s * (1 - s)


def _descend(gradient, w: np.ndarray, steps: int = 1000, rate: float = 0.02) -> np.ndarray:
    """Adam."""
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, look_good: float = 0.8) -> float:
    """Density of the unlabelled relative to the positives, over the ``look_good`` positives with the highest scores.

    ``positive`` and ``unlabelled`` are scores of a classifier of the one against the other; bad texts, which would
    raise the ratio, have the low scores.
    """
    edge = np.quantile(positive, 1 - look_good)
    return float(np.clip((unlabelled >= edge).mean() / (positive >= edge).mean(), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, ridge: float = 1e-3) -> Model:
    """Minimise the non-negative unbiased risk: first with the convex logistic loss, from there with the sigmoid
    loss, which is nearer to the count of wrong verdicts and makes scores decided."""
    if not len(positive) or not len(unlabelled):
        return Model()
    both = np.vstack([positive, unlabelled])
    scale = np.maximum(both.std(0), 1e-3)
    model = Model(tuple(both.mean(0)), tuple(scale))
    p, u = model.design(positive), model.design(unlabelled)

    def apart(w):  # positives against unlabelled
        return p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u) + ridge * w

    first = _descend(apart, np.zeros(p.shape[1]), 300)
    prior = class_prior(p @ first, u @ first)

    def risk(loss):
        def gradient(w):
            (good, good_slope), (bad_p, bad_p_slope), (bad_u, bad_u_slope) = loss(-(p @ w)), loss(p @ w), loss(u @ w)
            bad_gradient = u.T @ bad_u_slope / len(u) - prior * (p.T @ bad_p_slope) / len(p)
            if bad_u.mean() - prior * bad_p.mean() < 0:  # step back from what the estimate cannot support
                return -bad_gradient + ridge * w
            return -prior * (p.T @ good_slope) / len(p) + bad_gradient + ridge * w

        return gradient

    start = _descend(risk(_logistic), np.zeros(p.shape[1]))
    weights = _descend(risk(_step), start)
    return Model(model.centre, model.scale, tuple(map(float, weights)), prior)


def learn(
    df: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = 6000
) -> Model:
    """A model from trusted positives and unlabelled documents, none of them held out."""
    good = labels.filter((F.col(label) == 1) & ~held_out("doc_id")).select(F.col("doc_id").cast("long").alias("id"))
    every = df.select(col(doc_id).cast("long").alias("id")).filter(~held_out("id"))
    chosen = None
    for y, rows, salt in ((1, good, 1), (0, every, 2)):
        part = rows.filter("id IS NOT NULL").select("id", F.lit(y).alias("y")).distinct().orderBy(F.xxhash64("id", F.lit(salt)), "id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [list(map(float, signals(t))) for t in b["text"]], "y": b["y"]})

    # At most 2 * sample rows of two numbers: the size is bound, so it is broadcast.
    picked = df.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).join(F.broadcast(stage(chosen)), "id")
    rows = stage(picked.select("text", "y").mapInPandas(measured, "x array<double>, y int"))
    # Repeated ids may give more rows than were chosen; as many as were asked for are used.
    got = [np.array([r.x for r in rows.filter(F.col("y") == y).limit(sample).collect()], float) for y in (1, 0)]
    return fit(*got)


def scored(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            x = np.array([signals(t) for t in b], float).reshape(len(b), -1)
            yield pd.Series(model.score(x) if len(b) else [], dtype=float)

    out = df.select(col(doc_id).alias("doc_id"), score(F.coalesce(col(text), F.lit(""))).alias("score"))
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
