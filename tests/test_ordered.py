"""Running values across ranges equal the window over the whole group."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketry.operators import ordered as O


@pytest.mark.parametrize("group", [["g"], []])
def test_equals_windows(spark, group):
    """One group holds half of all rows; nulls in group and values; clashing column names."""
    rng = random.Random(3)
    rows = [(None if i % 50 == 3 else 0 if i % 2 else rng.randrange(40), i, rng.choice([None, 1, 2, 5]), rng.choice([None, None, "a", "b"]), "x") for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, k int, v long, s string, number string").repartition(5)
    steps = {"total": ("sum", F.col("v")), "top": ("max", F.col("v")), "low": ("min", F.col("v")), "state": ("last", F.col("s")), "start": ("first", F.col("s")), "after": ("next", F.col("v")), "earlier": ("before", F.col("s"))}
    w = (W.partitionBy(*group) if group else W.partitionBy(F.lit(1))).orderBy("k")
    run = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    want = df.select("*", F.sum("v").over(run).alias("total"), F.max("v").over(run).alias("top"), F.min("v").over(run).alias("low"), F.last("s", ignorenulls=True).over(run).alias("state"), F.first("s", ignorenulls=True).over(run).alias("start"), F.lead("v").over(w).alias("after"), F.last("s", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("earlier"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = O.running(df, group, ["k"], steps).collect()
        numbers = O.numbered(df.drop("number"), group, [F.col("k").desc()]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(repr, got)) == sorted(map(repr, want.collect()))
    back = df.drop("number").select("*", F.row_number().over((W.partitionBy(*group) if group else W.partitionBy(F.lit(1))).orderBy(F.col("k").desc())).alias("number"))
    assert sorted(map(repr, numbers)) == sorted(map(repr, back.collect()))


def test_empty(spark):
    df = spark.createDataFrame([], "g int, k int")
    assert O.numbered(df, ["g"], ["k"]).collect() == [] and O.numbered(df, [], ["k"]).columns == ["g", "k", "number"]


def test_hot_group_spans_tasks(spark):
    """A group that is the whole table is numbered by several tasks."""
    df = spark.range(20_000).select((F.lit(7)).alias("g"), F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = O.numbered(df, ["g"], ["k"])
        assert out.where("number <> k + 1").count() == 0
        most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert most < 10_000
