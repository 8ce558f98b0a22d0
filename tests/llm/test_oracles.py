"""The queries that SQL can express, against their oracles on the smallest tables."""

import duckdb
import pytest

from goldrec.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents embeddings pages labels".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLES[name])
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert got
