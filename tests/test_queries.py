"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or isinstance(v, str):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return round(float(v), 4) + 0.0
    return str(v)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, sf, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    relation = duck.sql(entry.oracle_sql()[name])
    names = list(relation.columns)
    assert columns == sorted(names)
    got = ordered(tuple(norm(r[c]) for c in columns) for r in df.collect())
    want = ordered(tuple(norm(r[names.index(c)]) for c in columns) for r in relation.fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-4 * max(1, abs(a)))


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 3
