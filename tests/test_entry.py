import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v != v:
        return "-"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    r = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = sorted(tuple(cell(x[names.index(c)]) for c in cols) for x in r.fetchall())
    assert sorted(tuple(cell(x[c]) for c in cols) for x in df.collect()) == want


def test_entry_runs(spark):
    if os.path.isdir(DIR):
        assert entry.entry(spark).columns
