"""Every query with SQL gives the same rows in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from strandline.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, data, duck, name):
    df = contract.queries()[name](spark, data)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(contract.oracle_sql()[name])
    assert got == rows([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
