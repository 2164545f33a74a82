"""Whitening of embeddings with refined eigenvectors.

1. Two passes over the vectors: exact sums, then the covariance of the centred vectors, added up per task and then by
   cell, so that only d x d numbers reach the driver, however many vectors there are.
2. ``refined``: eigenvectors in float32, corrected by Ogita and Aishima's iteration, which consists of matrix products
   in extended precision. Eigenvalues too close to be told apart by the iteration are clusters: the matrix is projected
   on a cluster's vectors, shifted by their mean eigenvalue, and the small problem is solved and rotated back.
3. The vectors are projected on the leading components. The covariance of the result is computed again over all vectors
   and compared with the identity.

Entries are integers, ``floor(scale * c) + offset``. Sums and deviations are exact. Entries and deviations that no
64-bit integer holds make an ``OverflowError``.

Defined cases: rows whose vector is null, empty or holds a null or non-finite entry are left out; vectors of another length
than the most frequent one (of equally frequent ones the longest) belong to another space and are left out too;
repeated rows and ids count each; components without variance (numerically, against the largest) are not given, so that
one vector, equal vectors, vectors without entries and empty tables give no rows; equal eigenvalues (ties) have any
orthonormal basis of their space, the same for all rows; there are no texts. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col
from tallyloom.sources.staging import stage

#: Precision of the corrections.
FINE = np.longdouble
ROUNDS = 30


def _norm(a: np.ndarray) -> float:
    """A bound of the spectral norm of a symmetric matrix."""
    return float(np.abs(a).sum(axis=1).max()) if a.size else 0.0


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Index groups of two and more values whose neighbours are within ``gap``."""
    order = np.argsort(-values)
    cuts = np.flatnonzero(-np.diff(values[order].astype(float)) > gap) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined(a: np.ndarray, tolerance: float = 1e-17) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix, corrected from float32 to about ``tolerance``."""
    d = len(a)
    size = max(_norm(a), np.finfo(float).tiny)
    a = np.asarray(a, FINE) / FINE(size)
    _, x = np.linalg.eigh(a.astype(np.float32))
    x, eye = x.astype(FINE), np.eye(d, dtype=FINE)
    solved: set[tuple[int, ...]] = set()
    best = None
    for _ in range(ROUNDS):
        r = eye - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = np.abs(s - np.diag(values)).max(initial=0) + np.abs(r).max(initial=0)
        if best is not None and (off >= best[0] / 2 and off < 1e-14):
            break
        if best is None or off < best[0]:
            best = off, values, x
        if off < tolerance:
            break
        gap = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
        apart = values[None, :] - values[:, None]  # the j-th value less the i-th
        told = np.abs(apart) > gap
        e = np.where(told, (s + values[None, :] * r) / np.where(told, apart, 1), r / 2)
        x = x + x @ e
        for g in _clusters(values, gap):
            key = tuple(sorted(g.tolist()))
            if key in solved and len(g) < d:  # its span is settled; what remains is closer than can be told
                continue
            solved.add(key)
            q = np.linalg.qr(x[:, g].astype(float))[0].astype(FINE)
            q = q + q @ (np.eye(len(g), dtype=FINE) - q.T @ q) / 2  # orthonormal to extended precision
            mean = values[g].mean()
            inner = q.T @ (a @ q - mean * q)
            w = np.linalg.eigh(((inner + inner.T) / 2 / max(_norm(inner), np.finfo(float).tiny)).astype(float))[1]
            x[:, g] = q @ w.astype(FINE)
    _, values, x = best
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return (values[order] * FINE(size)).astype(float), (x / np.sqrt((x * x).sum(axis=0))).astype(float)


def _usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v`` with doubles, of rows whose vector is whole and finite and has the usual length."""
    own = df.select(col(vec_id).alias("vec_id"), col(embedding).cast("array<double>").alias("v"))
    whole = own.filter("size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    usual = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return whole.filter(F.size("v") == (usual.d if usual else 0))


def _ints(v: pd.Series, scale: int, offset: int) -> np.ndarray:
    x = np.floor(np.stack(v.to_list()) * scale)
    if np.abs(x).max(initial=0) > 2.0**62:
        raise OverflowError("an entry does not fit in 64 bits")
    return x.astype(np.int64) + offset


def whitened(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable vector and component."""
    usable = _usable(df, vec_id, embedding)
    spark = df.sparkSession

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = None, 0
        for b in batches:
            if len(b):
                x = _ints(b["v"], scale, offset)
                fits = float(np.abs(x).max(initial=0)) * len(x) < 2.0**62
                total = x.sum(axis=0, dtype=None if fits else object).astype(object) + (0 if total is None else total)
                n += len(x)
        if total is not None:
            yield pd.DataFrame({"at": range(len(total)), "s": [str(t) for t in total], "n": n})

    cells = usable.select("v").mapInPandas(add_up, "at int, s string, n long")
    cells = cells.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("at").collect()
    id_type = dict(usable.dtypes)["vec_id"]
    columns = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    none = spark.createDataFrame([], f"vec_id {id_type}, {columns}")
    if not cells:
        return none
    n, sums = cells[0].n, [int(r.s) for r in cells]
    d = len(sums)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], object)
    part = np.array([s % n / n for s in sums])

    def centred(v: pd.Series) -> np.ndarray:
        return _ints(v, scale, offset) - whole - part

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for b in batches:
            if len(b):
                y = centred(b["v"])
                total += y.T @ y
        i, j = np.triu_indices(d)
        yield pd.DataFrame({"i": i, "j": j, "s": total[i, j]})

    covariance = np.zeros((d, d))
    by_cell = usable.select("v").mapInPandas(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    for r in by_cell.collect():
        covariance[r.i, r.j] = covariance[r.j, r.i] = r.s / n
    values, vectors = refined(covariance)
    k = min(components, int((values > max(values[0], 0) * d * np.finfo(float).eps).sum()))
    if not k:
        return none
    explained = [float(e / np.trace(covariance)) for e in values[:k]]
    project = vectors[:, :k] / np.sqrt(values[:k])

    def whiten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = _ints(b["v"], scale, offset)
            z = x - whole
            if float(np.abs(z).max()) * n + n < 2.0**62 and (float(np.abs(z).max()) * n + n) ** 2 * d < 2.0**62:
                apart = ((z * n - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                apart = [int(t) for t in ((z.astype(object) * n - rest) ** 2).sum(axis=1)]
            if max(apart) >= 1 << 63:
                raise OverflowError("a deviation does not fit in 64 bits")
            w = (z - part) @ project
            yield pd.DataFrame({"vec_id": b["vec_id"], "deviation": apart, **{f"w{c}": w[:, c] for c in range(k)}})

    out = stage(usable.mapInPandas(whiten, f"vec_id {id_type}, deviation long, " + ", ".join(f"w{c} double" for c in range(k))))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    again = out.agg(*[F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs]).first()
    error = max(abs(c - (a == b)) for c, (a, b) in zip(again, pairs, strict=True))
    each = F.array(*[
        F.struct(F.lit(c + 1).alias("component"), F.col(f"w{c}").alias("whitened"), F.lit(explained[c]).alias("explained")) for c in range(k)
    ])
    rows = out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.inline(each))
    return rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", F.lit(float(error)).alias("identity_error"))
