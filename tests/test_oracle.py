"""Every query with SQL against DuckDB on the smallest tables; every other query makes rows."""

import os
from decimal import Decimal

import duckdb
import pytest

from mosaique.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.sql(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return c


def plain(v):
    return "NULL" if v is None else str(round(float(v), 6) + 0.0) if isinstance(v, float | Decimal) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: TYPES[t] for c, t in got.dtypes} == kinds
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
