"""Every query with SQL gives the rows that the SQL gives, on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(D).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(D).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, decimal.Decimal | float | int):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime.date):
        return str(v)
    return tuple(plain(x) for x in v) if isinstance(v, list | tuple) else v


def rows(cols, data):
    at = [cols.index(c) for c in sorted(cols)]
    return sorted((tuple(plain(r[i]) for i in at) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql(spark, duck, name):
    df = entry.queries()[name](spark, D)
    got = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.columns, df.collect()) == rows(cols, got.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, D).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["record_id", "min_usd_year"]
