"""Every query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tallyglass.plans.queries import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.sql(f"create view {f.removesuffix('.parquet')} as from '{D}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, D)
    rows = df.collect()
    if name not in ORACLE_SQL:
        return
    found = con.sql(ORACLE_SQL[name])
    want, columns = found.fetchall(), found.columns
    assert sorted(columns) == sorted(df.columns)
    plain = lambda v: float(v) if hasattr(v, "as_tuple") else v
    a = sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=str)
    b = sorted((tuple(map(plain, r)) for r in want), key=str)
    assert a == b
