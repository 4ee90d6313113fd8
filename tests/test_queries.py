"""Queries of the core against their SQL over the smallest tables."""

import pytest

from loomquill.plans import catalog

TABLES = "region nation part embeddings documents store_rows embed_payloads text_docs image_readings img_docs eval_items".split()


def rounded(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = pytest.importorskip("duckdb").connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, data, duck, name):
    df = catalog.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    result = duck.execute(catalog.SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert rounded(tuple(r) for r in df.select(*columns).collect()) == rounded(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
