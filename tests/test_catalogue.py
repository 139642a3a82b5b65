"""Every query runs, and equals its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from lodestrata.plans.catalogue import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{DIR}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


@pytest.mark.skipif(not glob.glob(DIR), reason="the test tables are elsewhere")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    if name in ORACLE_SQL:
        want = db.sql(ORACLE_SQL[name])
        names = want.columns
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
