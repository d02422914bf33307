"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return v + 0.0 if isinstance(v, float) else v

    out = [tuple(plain(r[i]) for i in order) for r in data]
    key = lambda r: tuple((v is None, "" if v is None else v) for v in r)
    return [columns[i] for i in order], sorted(out, key=key)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    cursor = duck.execute(ORACLES[key])
    expected = _table([c[0] for c in cursor.description], cursor.fetchall())
    assert _table(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 7
