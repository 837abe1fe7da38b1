"""Every registered query with an oracle gives DuckDB's rows on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from tallyfold import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    return str(v) if isinstance(v, decimal.Decimal) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(plain(r[i]) for i in order)) for r in data)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    got = rows(df.columns, df.collect())
    if name in catalogue.ORACLES:
        want = duck.sql(catalogue.ORACLES[name])
        assert got == rows(want.columns, want.fetchall())


def test_every_oracle_has_a_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
