"""Every core query against its SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from scrivano.plans import core

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        c.sql(f"create view {p.stem} as from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_same_rows(spark, tables, name):
    got = core.QUERIES[name](spark, FOLDER)
    cols = sorted(got.columns)
    want = tables.sql(core.SQL[name])
    assert cols == sorted(want.columns)
    mine = Counter(repr(tuple(r)) for r in got.select(*cols).collect())
    theirs = Counter(repr(r) for r in tables.sql(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from want").fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_runs(spark, name):
    assert core.QUERIES[name](spark, FOLDER).count() > 0
