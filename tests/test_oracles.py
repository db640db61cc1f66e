"""Every query against DuckDB on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from clauselens.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v.is_integer() else round(v, 9))
    return v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(name, spark, sf, duck):
    frame = queries()[name](spark, sf)
    columns = sorted(frame.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in frame.collect()]
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
