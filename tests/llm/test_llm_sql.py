"""Registered queries with SQL equal DuckDB's rows; the others give one row a document where the contract asks so."""

import glob
import math
import os

import duckdb
import pytest

from docketry.llm import registry


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = registry.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    got = con.execute(registry.ORACLES[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(repr(tuple(plain(x[i]) for i in at)) for x in got.fetchall())


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, len(registry.QUERIES) + 1))
