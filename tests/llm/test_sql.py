"""Every query of this subpackage that has SQL, against DuckDB over the same rows."""

import os

import duckdb
import pytest

from cluelake.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents benchmark pages labels conversations".split()


def oracle(sql, sf_dir=SF):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return con.sql(sql)


def rows(columns, values):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda x: round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(plain(v[i]) for i in at) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    want = oracle(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got.columns, [tuple(r) for r in got.collect()]), rows(want.columns, want.fetchall())
    assert len(a) == len(b) > 0
    assert [x for x in zip(a, b) if x[0] != x[1]][:3] == []
