"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import collections
import datetime
import decimal
import math

import duckdb
import pytest

from affinity.plans import ORACLES, QUERIES
from affinity.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLES:
        assert len(rows) > 0
        return
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    orows = res.fetchall()
    idx = [ocols.index(c) for c in df.columns]
    a = collections.Counter(tuple(_norm(v) for v in r) for r in rows)
    b = collections.Counter(tuple(_norm(r[i]) for i in idx) for r in orows)
    assert a == b
