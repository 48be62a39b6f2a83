"""Every registered engine query equals its SQL at the smallest scale."""

import os

import duckdb
import pytest

from satellion.plans import registry

DATA = "/root/testdata/sf0.001"
NAMES = sorted(registry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    res = duck.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(repr([plain(dict(zip(cols, r))[c]) for c in sorted(cols)]) for r in res.fetchall())
    assert sorted(repr([plain(r[c]) for c in sorted(cols)]) for r in df.collect()) == want
