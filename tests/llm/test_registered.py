"""The registered queries against their SQL, and the others by their rows."""

import os

import pytest

from strandlake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    found = duck.sql(queries.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    at = [found.columns.index(c) for c in columns]
    assert sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(_plain(r[i]) for i in at) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_has_all_rows(spark, duck, name):
    got = [r["doc_id"] for r in queries.QUERIES[name](spark, SF).collect()]
    assert sorted(got) == sorted(x[0] for x in duck.sql("SELECT doc_id FROM documents").fetchall())
