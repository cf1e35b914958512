"""Every query with SQL against DuckDB on the smallest tables; every other one for its shape."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from textloom import catalog

SF = os.environ.get("TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if v is None or isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


def table(rows, names):
    at = [names.index(c) for c in sorted(names)]
    return sorted(tuple(norm(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = table([tuple(r) for r in df.collect()], df.columns)
    want = duck.execute(catalog.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert got == table(want.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert {"lang", "reason", "pages"} == set(entry.entry(spark).columns)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
