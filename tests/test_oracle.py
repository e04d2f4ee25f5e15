"""Every registered query equals its DuckDB oracle on the sf0.001 fixtures."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog
from tessera.sources.tables import BASE_TABLES
from tests.util import canon

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(SQL)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = E.queries()[name](spark, sf_dir)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = canon(cols, res.fetchall())
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in cols)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "ActionPerformed" in df.columns


@pytest.mark.parametrize("name", sorted(n for n in catalog.queries() if "_upsert_" in n))
def test_merge_queries_match_oracle_on_shuffle_plans(spark, sf_dir, duck, name, monkeypatch):
    """The same merges with the batch treated as large (sort-merge plans)."""
    import tessera.operators.broadcast as bounds

    monkeypatch.setattr(bounds, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    df = E.queries()[name](spark, sf_dir)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[name])
    want = canon([d[0] for d in res.description], res.fetchall())
    assert got == want
