"""Every catalogue query against its DuckDB twin on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_canon(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert len(df.columns) == 14 and df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rows = df.collect()
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows is not None
        return
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, rows) == _bag(dcols, cur.fetchall())
