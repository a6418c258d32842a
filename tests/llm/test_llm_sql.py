"""The operators' queries against their SQL on the sf0.001 tables."""

import duckdb
import pytest

from carelake.llm.queries import ORACLES, QUERIES
from test_oracle import _key, _norm

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, D)
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    rel = con.sql(ORACLES[name])
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(rel.columns) == sorted(df.columns)
    assert got == sorted((tuple(_norm(r[i]) for i in at) for r in rel.fetchall()), key=_key)
