"""Properties over random small tables, each checked against plain Python."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.operators import coverage, history, reshape, resolve, rollup

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = st.sampled_from(["a", "b", None])
SMALL = st.one_of(st.none(), st.integers(0, 3))


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@FEW
@given(st.lists(st.tuples(KEYS, SMALL, SMALL), min_size=1, max_size=25))
def test_hierarchy_keeps_the_best_and_all_its_ties(spark, data):
    data = [(*r, i) for i, r in enumerate(data)]
    df = frame(spark, data, "k string, a int, b int, ix int")
    got = sorted(r.ix for r in resolve.resolve_hierarchy(df, ["k"], [("a", "max"), ("b", "min")]).collect())
    again = resolve.resolve_hierarchy(df.orderBy(df.ix.desc()), ["k"], [("a", "max"), ("b", "min")])
    rank = lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or 0)
    best = {}
    for r in data:
        best[r[0]] = min(best.get(r[0], rank(r)), rank(r))
    assert got == [r[3] for r in data if rank(r) == best[r[0]]]
    assert got == sorted(r.ix for r in again.collect())


@FEW
@given(st.lists(st.tuples(KEYS, SMALL), min_size=1, max_size=25))
def test_keep_max_against_python(spark, data):
    data = [(*r, i) for i, r in enumerate(data)]
    got = sorted(r.ix for r in resolve.keep_max(frame(spark, data, "k string, a int, ix int"), ["k"], "a").collect())
    top = defaultdict(lambda: -1)
    for k, a, _ in data:
        top[k] = max(top[k], -1 if a is None else a)
    assert got == [i for k, a, i in data if k is not None and a is not None and a == top[k]]


@FEW
@given(st.dictionaries(st.integers(0, 5), st.tuples(*[st.one_of(st.none(), st.text("xyz", max_size=2))] * 3), min_size=1))
def test_long_then_wide_is_the_same_table(spark, table):
    df = frame(spark, [(k, *v) for k, v in table.items()], "k int, a string, b string, c string")
    back = reshape.pivot_strict(reshape.to_long(df, ["k"]), ["k"], "variable", "value", ["a", "b", "c"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


@FEW
@given(st.lists(st.tuples(st.integers(1, 3), KEYS, st.integers(0, 9)), min_size=1, max_size=25))
def test_totals_equal_sums(spark, data):
    sums = rollup.sum_by(frame(spark, data, "y int, k string, n int"), ["y", "k"], "n")
    out = rollup.with_totals(sums, ["y"], "k", ["n"]).collect()
    for y in {r[0] for r in data}:
        assert [r.n for r in out if r.y == y and r.is_total] == [sum(r[2] for r in data if r[0] == y)]
    assert len([r for r in out if not r.is_total]) == len({(r[0], r[1]) for r in data})


@FEW
@given(st.lists(st.tuples(KEYS, st.integers(1, 3)), max_size=20), st.sets(st.tuples(KEYS, st.integers(1, 3)), min_size=1))
def test_complete_has_every_expected_key_once_or_with_its_rows(spark, data, grid):
    out = coverage.complete_against(frame(spark, data, "k string, y int"), frame(spark, list(grid), "k string, y int"), ["k", "y"]).collect()
    assert {(r.k, r.y) for r in out} == grid
    for cell in grid:
        flags = [r.Missing for r in out if (r.k, r.y) == cell]
        assert flags == ([False] * data.count(cell) or [True])


@FEW
@given(st.lists(st.tuples(st.integers(1, 4), KEYS, st.integers(0, 9)), max_size=15), st.lists(st.tuples(st.integers(1, 4), KEYS, st.integers(0, 9)), min_size=1, max_size=15))
def test_history_merge_is_idempotent(spark, old, new):
    schema = "y int, k string, v int"
    a, b = frame(spark, old, schema), frame(spark, new, schema)
    once = history.merge_history(a, b, "y", b, ["y", "k"], ["v"])
    twice = history.merge_history(once, b, "y", b, ["y", "k"], ["v"])
    got = sorted(map(tuple, once.collect()), key=str)
    assert got == sorted(map(tuple, twice.collect()), key=str)
    years = {r[0] for r in new}
    assert {r[0] for r in got} == years | {r[0] for r in old}
    assert all(r in new for r in got if r[0] in years)


@FEW
@given(st.lists(st.tuples(KEYS, st.sampled_from(["p", "q", "r", None])), min_size=1, max_size=20))
def test_concat_distinct_order(spark, data):
    df = frame(spark, [(*r, i) for i, r in enumerate(data)], "k string, v string, ix int")
    want = defaultdict(list)
    for k, v in data:
        if v is not None and v not in want[k]:
            want[k].append(v)
    got = {r.k: r.v for r in rollup.concat_distinct(df, ["k"], "v", ",", ["ix"]).collect()}
    assert got == {k: ",".join(v) for k, v in want.items()}
