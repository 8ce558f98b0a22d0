"""Registered queries against their DuckDB oracles on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from goldrec.plans import oracles, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(set(oracles.ORACLES) & set(queries.QUERIES))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    s = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    o = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert s == o


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
