"""Every query that has SQL, against that SQL in DuckDB over the smallest tables."""

import datetime
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
CORE = [n for m in entry.MODULES for n in __import__(m, fromlist=["SQL"]).SQL]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f[:-8]} as select * from '{FOLDER}/{f}'")
    return c


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool | str | datetime.date):
        return str(v)
    return f"{float(v) + 0.0:.6f}" if hasattr(v, "__float__") else str(v)


@pytest.mark.parametrize("name", CORE)
def test_same_rows(spark, duck, name):
    df, out = entry.queries()[name](spark, FOLDER), duck.execute(entry.oracle_sql()[name])
    theirs = [d[0] for d in out.description]
    assert sorted(df.columns) == sorted(theirs)
    mine = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    want = Counter(tuple(plain(dict(zip(theirs, r))[c]) for c in sorted(theirs)) for r in out.fetchall())
    assert mine == want


def test_flagship(spark):
    assert entry.entry(spark).columns == ["fight_id", "fighter_id", "snapshot_id"]
