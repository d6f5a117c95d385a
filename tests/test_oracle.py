"""Every registered query against its DuckDB oracle SQL (the driver's check), at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from brandflow.sources.tpch import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


OWN = sorted(n for n in entry.queries() if n in entry.oracle_sql() and not n.startswith("op"))  # others are tested with their subpackage


def test_every_own_query_has_sql():
    assert len(OWN) == 30


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    rel = con.sql(sql)
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in rel.columns)
    key = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in key) for r in df.collect())
    idx = {c.lower(): i for i, c in enumerate(rel.columns)}
    want = sorted(tuple(_norm(r[idx[c.lower()]]) for c in key) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["B1", "B2", "total_gains_b1_to_b2", "total_losses_b1_to_b2"]
    assert len(rows) > 0
