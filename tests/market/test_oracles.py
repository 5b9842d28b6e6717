"""Queries against their SQL on DuckDB, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


# the whole equity panel needs a year of rows before its training days: its SQL is compared at the larger scales
@pytest.mark.parametrize("name", sorted(set(queries.ORACLES) - {"equity_alpha_panel"}))
def test_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = db.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    key = lambda row: tuple((v is None, str(v)) for v in row)
    want = sorted((tuple(plain(v) for v in (dict(zip(names, r))[c] for c in columns)) for r in cursor.fetchall()), key=key)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and x == pytest.approx(y, abs=2e-6, rel=1e-9)) for x, y in zip(a, b)), (a, b)


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
