"""Every query of records, layers and marts gives the same rows as DuckDB on the smallest tables."""

import pytest
from test_catalog import DATA, duck, plain  # noqa: F401
from test_plans import plan

from docketry import catalog_records as R

#: Queries whose operators run Python in Arrow batches.
PYTHON: set[str] = set()


@pytest.mark.parametrize("name", list(R.QUERIES))
def test_query(spark, duck, name):  # noqa: F811
    df = R.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    got = duck.execute(R.ORACLES[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(repr(tuple(plain(x[i]) for i in at)) for x in got.fetchall())
    text = plan(df)
    assert ("Python" in text or "InPandas" in text or "InArrow" in text) == (name in PYTHON)
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text
