"""Registered queries against their SQL, run by another engine on the same tables."""

import os

import pytest

from strandlake.jobs import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_has_sql(name):
    assert name in registry.ORACLE


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    found = duck.sql(registry.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    at = [found.columns.index(c) for c in columns]
    assert sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(_plain(r[i]) for i in at) for r in found.fetchall())
