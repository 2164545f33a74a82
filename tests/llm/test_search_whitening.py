"""Lexical search and whitening against brute force, on small tables with every odd case."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import lexical_search, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def ranked_by_hand(docs, queries, top=10):
    counts = [(i, Counter(terms(t))) for i, t, *_ in docs]
    n_docs, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text in set(queries):
        scores = []
        for i, c in counts:
            n = sum(c.values())
            m = 25 + 75 * n * n_docs // length if length else 0
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if s > 0:
                scores.append((-s, (1 << 63) - 1 if i is None else i, i))
        out.update((item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:top], 1))
    return out


@pytest.fixture(scope="module")
def queries(rows_of_docs):
    r = random.Random(3)
    cut = [t.split()[5:25] for _, t, *_ in rows_of_docs[:12] if t]
    texts = [" ".join(w) for w in cut] + [None, "", "., !", "FEW words é", "few few few words", "nothinglikeit", "a a b", "x" * 300_000]
    rows = [(k, t) for k, t in enumerate(texts)]
    return [*rows, rows[0], (0, "few"), (None, "few words"), (77, " ".join(r.choice(cut[0] + cut[1]) for _ in range(300)))]


@pytest.mark.parametrize(("block_terms", "how"), [(1 << 17, {}), (200, {"top": 3, "query_terms": 250})])
def test_search_ranks_as_brute_force(spark, docs, rows_of_docs, queries, how, block_terms, rows):
    asked = spark.createDataFrame([(*q, 1) for q in queries], "item_id long, text string, doc_id int")
    blocks = lexical_search.index(docs, block_terms=block_terms)
    got = lexical_search.search(blocks, docs, asked, **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(rows(got)) == ranked_by_hand(rows_of_docs, queries, how.get("top", 10))


def test_search_of_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical_search.search_report(docs, none).count() == 0
    assert lexical_search.search_report(no_docs, spark.createDataFrame([(1, "few")], none.schema)).count() == 0


def test_bounds_are_never_below_the_scores(rows_of_docs):
    """What a signature says of a document, for every term of the others too."""
    block = lexical_search._Block(12)
    every, seen = {}, {}
    for i, t, *_ in rows_of_docs:
        c = Counter(lexical_search.terms(t))
        if 0 < len(c) < 400 and i is not None:
            h, tf = lexical_search._hashes(list(c), seen), np.array(list(c.values()))
            keys = [lexical_search._level(h[tf >= at], k) for k, at in enumerate(lexical_search.LEVELS)]
            block.add(i, c, np.concatenate(keys))
            every[len(every)] = c
    row = block.frame().iloc[0]
    lengths, bits, slices = row.lengths, row.bits, row.slices
    names = sorted({t for c in every.values() for t in c})
    slices = np.frombuffer(slices, np.uint8).reshape(bits, -1)
    lengths = np.frombuffer(lengths, np.int64)
    reached, impacts = lexical_search._bounds(slices, lengths, bits, lexical_search._hashes(names, seen), 50, 5000)
    wrong = 0
    for k, t in enumerate(names):
        for d, c in every.items():
            exact = lexical_search.impact(c[t], 25 + 75 * int(lengths[d]) * 50 // 5000) if t in c else 0
            bound = impacts[reached[k, d], d]
            assert bound >= exact
            wrong += bound > 0 and t not in c
    assert wrong < 0.02 * len(names) * len(every)


# -- whitening


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(1, 50, 40),
    np.r_[np.full(5, 3.0), np.linspace(0.1, 2, 20)],
    np.r_[3 + 1e-9 * np.arange(6), 1 + 1e-12 * np.arange(4), 0.5],
    np.r_[1e6, 1e6 * (1 + 1e-8), 1.0, 1e-3, 1e-6 * (1 + 1e-5 * np.arange(5))],
    np.zeros(4), np.ones(1), np.full(12, 2.0), np.r_[1.0, np.zeros(9)],
])
def test_refined_eigenvectors(values):
    a = spectrum(np.asarray(values, float))
    a = (a + a.T) / 2
    found, x = whitening.refined(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-14
    assert np.abs(a @ x - x * found).max() < 1e-14 * size


def test_refinement_improves_on_float32():
    """Without the corrections the vectors are those of float32."""
    values = np.r_[np.linspace(1, 2, 30), 5 + 1e-7 * np.arange(5)]
    a = spectrum(values)
    a = (a + a.T) / 2
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    _, x = whitening.refined(a)
    best = np.linalg.eigh(a)[1][:, ::-1]
    told = [k for k in range(30, 35)]
    error = np.abs(np.abs((best[:, [0]] * x[:, [0]]).sum()) - 1)
    assert error < 1e-9 < np.abs(a @ rough - rough * np.diag(rough.T @ a @ rough)).max() and told


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(5)
    v = r.normal(size=(400, 12)) @ r.normal(size=(12, 12)) * 0.3
    rows = [(i, [float(np.float32(c)) for c in x]) for i, x in enumerate(v)]
    odd = [(900, None), (901, [None, *rows[0][1][1:]]), (902, [math.nan, *rows[0][1][1:]]), (903, [math.inf, *rows[0][1][1:]]), (904, [1.0]), (905, [])]
    return [*rows, rows[3], rows[3], (None, rows[5][1])], odd


def test_whitening_as_brute_force(spark, vectors):
    good, odd = vectors
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + odd], "vec_id long, embedding array<float>, n string, component int").repartition(5)
    got = whitening.whitened(df).toPandas()
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in good], object)
    n, s = len(good), x.sum(axis=0)
    y = ((n * x - s) / n).astype(float)
    cov = y.T @ y / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1], vec[:, ::-1]
    want = y @ vec[:, :8] / np.sqrt(e[:8])
    assert len(got) == 8 * n and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10
    by_component = {c: g["explained"].iloc[0] for c, g in got.groupby("component")}
    assert [by_component[c] for c in range(1, 9)] == pytest.approx((e[:8] / np.trace(cov)).tolist(), rel=1e-12)
    apart = Counter((i, int(a)) for (i, _), a in zip(good, ((n * x - s) ** 2).sum(axis=1), strict=True))
    one = got[got["component"] == 1]
    assert Counter((None if np.isnan(i) else int(i), int(a)) for i, a in zip(one["vec_id"].astype(float), one["deviation"], strict=True)) == apart
    mine = {i: k for k, (i, _) in enumerate(good) if i is not None}
    for c in range(1, 9):
        g = got[(got["component"] == c) & got["vec_id"].notna()]
        hand = want[[mine[int(i)] for i in g["vec_id"]], c - 1]
        sign = np.sign((g["whitened"].to_numpy() * hand).sum())
        assert np.abs(g["whitened"].to_numpy() * sign - hand).max() < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_whitening_without_variance(spark, rows):
    assert whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_whitening_gives_no_more_components_than_there_are(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [1.5, 2.0, 0.0]), (3, [0.0, 2.0, 0.0])], "vec_id int, embedding array<double>")
    got = whitening.whitened(df)
    assert got.filter("component = 1").count() == 3 == got.count()
    with pytest.raises(Exception, match="64 bits"):
        whitening.whitened(spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id int, embedding array<double>"))
