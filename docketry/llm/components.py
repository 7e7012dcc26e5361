"""Connected components of an edge table as Spark jobs: local stars, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


class Sets:
    """Disjoint sets over dense indices; the smallest index is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of each batch as stars around the smallest node: the same components, one edge a node at most."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        sets = Sets(len(nodes))
        for i, j in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
            sets.join(i, j)
        roots = np.array([sets.root(i) for i in range(len(nodes))], np.int64)
        far = roots != np.arange(len(nodes))
        yield pa.record_batch([pa.array(nodes[far]), pa.array(nodes[roots[far]])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of (a long, b long); label is the component's smallest node.

    Each turn links every node's larger neighbours, then its smaller ones, to the smallest node known; the number of
    turns grows with the logarithm of the longest path.  Loops are dropped; an empty table gives none.  No group is
    gathered: each turn is two aggregations to a minimum and joins with them, whose hot keys Spark can split."""
    edges = stored(edges.select("a", "b").where("a <> b").mapInArrow(_stars, "a long, b long"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "k")
        large = stored(both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("k"))
        small = small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        new = stored(small)
        # done when all edges lead to roots: no node is below two others, or below one and above another
        places = new.select(F.col("a").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(new.select("b", F.lit(0), F.lit(1)).distinct())
        again = places.groupBy("n").agg((F.sum("below") + F.max("above")).alias("k"), F.sum("below").alias("below")).where("k > 1 AND below > 0").limit(1).count()
        edges = new
        if not again:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())
