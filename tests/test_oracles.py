"""Every query with an oracle gives the oracle's rows on the smallest tables; every other one runs."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def oracle(data):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query(spark, data, oracle, name):
    df = __spark_entry__.queries()[name](spark, data)
    rows = df.collect()
    sql = __spark_entry__.oracle_sql().get(name)
    if sql:
        c = oracle.execute(sql)
        assert table(df.columns, [tuple(r) for r in rows]) == table([d[0] for d in c.description], c.fetchall())


def test_oracles_belong_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
