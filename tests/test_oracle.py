"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os

import pytest

from tallyloom.bindings import load
from tools.check import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    rows, difference = compare(spark, con, SF, QUERIES[name], ORACLES.get(name))
    assert difference is None, difference
    assert rows >= 0


def test_pages_decode_as_python_does(spark):
    import html

    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r.html for r in QUERIES["html_unescape"](spark, SF).collect()}
    assert got == {k: html.unescape(v) for k, v in raw.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_pages_hold_known_entities_only(sf):
    import re

    from tallyloom.bindings.cleaning import PAGE_ENTITIES

    path = f"{os.path.dirname(SF)}/{sf}"
    if os.path.isdir(path):
        pages = [r[0] or "" for r in connect(path).execute("SELECT html FROM pages").fetchall()]
        assert {e for p in pages for e in re.findall(r"&#?\w+;", p)} <= set(PAGE_ENTITIES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
