"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from docketry import catalog

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in catalog.ORACLES:
        assert rows
        return
    got = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(repr(tuple(plain(x[i]) for i in at)) for x in got.fetchall())
