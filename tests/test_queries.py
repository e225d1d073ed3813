"""Every query against DuckDB over the same rows."""

import os

import duckdb
import pytest

from cluelake.plans.bindings import TABLES
from cluelake.plans.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


def rows(columns, values):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda x: round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(plain(v[i]) for i in at) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        want = con.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert got == rows(want.columns, want.fetchall())
