"""Queries against their SQL on the smallest tables, as the driver does at a larger size."""

import glob
import os

import duckdb
import pytest

from ledgerfold.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/observation.parquet"), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


def test_queries_without_sql_run(spark):
    for name in sorted(set(QUERIES) - set(ORACLE)):
        assert QUERIES[name](spark, FOLDER).count() >= 0
