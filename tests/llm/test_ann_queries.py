"""Queries that lie elsewhere than most rows."""

import numpy as np
from pyspark.sql import functions as F

from docketry.llm import ann


def test_queries_unlike_the_rows(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(150, 32))
    x = centres[rng.integers(0, 150, 4000)] + 0.05 * rng.normal(size=(4000, 32))
    x[::50] = rng.normal(size=(80, 32))  # the queries: no cluster's
    df = spark.createDataFrame([(i, [float(y) for y in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit[::50] @ unit.T
    near[np.arange(80), np.arange(80) * 50] = -2
    best = np.argsort(-near, axis=1, kind="stable")[:, :5]
    assert np.mean([len(got[50 * i] & set(b.tolist())) / 5 for i, b in enumerate(best)]) >= 0.97
