"""Running values over ordered groups, for groups of any size: rows are cut into ranges, each range is summed up, and what
came before a range is carried into it.  No task holds a group, so one group may be most of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import shared_folder

#: How a step runs over rows, how a range is summed up (value, place), and how the carry joins what a range has by itself.
_OVER = {"before": lambda c: F.last(c, ignorenulls=True), "sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True), "first": lambda c: F.first(c, ignorenulls=True)}
_WHOLE = {
    "before": lambda c, at: F.max_by(c, F.when(c.isNotNull(), at)),
    "sum": lambda c, at: F.sum(c), "max": lambda c, at: F.max(c), "min": lambda c, at: F.min(c),
    "last": lambda c, at: F.max_by(c, F.when(c.isNotNull(), at)), "first": lambda c, at: F.min_by(c, F.when(c.isNotNull(), at)),
}
_JOINED = {"sum": lambda own, carry: F.when(own.isNull() & carry.isNull(), own).otherwise(F.coalesce(own, F.lit(0)) + F.coalesce(carry, F.lit(0))), "max": F.greatest, "min": F.least, "last": F.coalesce, "before": F.coalesce, "first": lambda own, carry: F.coalesce(carry, own)}


def stored(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: places in it stay, whatever is computed again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def laid(df: DataFrame, group: list[str], order: list[str | Column]) -> DataFrame:
    """df range-partitioned and sorted by (group, order), stored, with each row's range (_part) and place (_at)."""
    keys = [*map(F.col, group), *[F.col(c) if isinstance(c, str) else c for c in order]]
    df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(df.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def over(rows: DataFrame, group: list[str], steps: dict[str, tuple[str, Column]]) -> DataFrame:
    """running() over rows that laid() has put in order; _part and _at stay.  The rows of a group lie together in that order:
    it may be the group that they were laid by, or a finer one that grows along it.  rows are read twice: store them
    after costly steps."""
    names, kinds, given = list(steps), [k for k, _ in steps.values()], rows.columns
    rows = rows.withColumns({f"_v{i}": c for i, (_, c) in enumerate(steps.values())})
    at, value = F.col("_at"), [F.col(f"_v{i}") for i in range(len(steps))]

    here = W.partitionBy("_part", *group).orderBy("_at")
    so_far, earlier = here.rowsBetween(W.unboundedPreceding, W.currentRow), here.rowsBetween(W.unboundedPreceding, -1)
    own = [F.lead(v).over(here) if k == "next" else _OVER[k](v).over(earlier if k == "before" else so_far) for k, v in zip(kinds, value, strict=True)]

    whole = [F.min_by(v, at) if k == "next" else _WHOLE[k](v, at) for k, v in zip(kinds, value, strict=True)]
    spans = stored(rows.groupBy("_part", *group).agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), *[w.alias(f"_w{i}") for i, w in enumerate(whole)]))
    ends = spans.groupBy("_part").agg(F.min("_lo").alias("_first"), F.max("_hi").alias("_last")).withColumnRenamed("_part", "_p")
    # only the first and the last group of a range can go on in another: two rows a range at most
    edge = spans.join(F.broadcast(ends), (F.col("_part") == F.col("_p")) & ((F.col("_lo") == F.col("_first")) | (F.col("_hi") == F.col("_last"))))
    by_part = W.partitionBy(*group).orderBy("_part") if group else W.orderBy("_part")
    before = by_part.rowsBetween(W.unboundedPreceding, -1)
    carry = [F.lead(f"_w{i}").over(by_part) if k == "next" else _OVER[k](F.col(f"_w{i}")).over(before) for i, k in enumerate(kinds)]
    carry = edge.select(F.col("_part").alias("_p"), F.col("_lo"), F.col("_hi"), *[c.alias(f"_c{i}") for i, c in enumerate(carry)])

    out = rows.withColumns({f"_o{i}": c for i, c in enumerate(own)})
    out = out.join(F.broadcast(carry), (F.col("_part") == F.col("_p")) & F.col("_at").between(F.col("_lo"), F.col("_hi")), "left")
    result = []
    for i, k in enumerate(kinds):
        mine, carried = F.col(f"_o{i}"), F.col(f"_c{i}")
        result.append((F.when(at == F.col("_hi"), carried).otherwise(mine) if k == "next" else _JOINED[k](mine, carried)).alias(names[i]))
    return out.select(*given, *result)


def running(df: DataFrame, group: list[str], order: list[str | Column], steps: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds a column for each step (kind, value), over the rows of a group up to and with each row.

    Kinds: sum, max, min, last and first (of values that are not null); before, the last value that is not null of earlier
    rows; and next, the value in the row after (null in a group's last row).  Nulls in group are one group; rows that
    are equal in group and order have no set order among themselves and are kept in one range.  Rows are range-partitioned by
    (group, order) and stored; windows run inside a range; what crosses ranges is a row or two a range, however many
    groups there are.  An empty table gives none."""
    return over(laid(df, group, order), group, steps).drop("_part", "_at")


def numbered(df: DataFrame, group: list[str], order: list[str | Column], name: str = "number") -> DataFrame:
    """Adds each row's number in its group, from 1, in the given order; see running()."""
    return running(df, group, order, {name: ("sum", F.lit(1).cast("long"))})
