"""Rebuilding a mart for the cases whose captured files changed, from the signatures of the files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIGNATURE = ("exists", "mtime", "size")


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """SRC9: (path, change) of files whose signature differs between two listings (tables.freshness): added, changed or
    removed; files that are the same give no row.  A path that a listing has several times counts by its newest entry;
    entries that say that there is no file count as none."""
    newest = lambda df: df.where("exists").groupBy("path").agg(F.max(F.struct("mtime", "size")).alias("sig"))
    a = newest(before).select(F.col("path").alias("a_path"), F.col("sig").alias("a_sig"))
    b = newest(now).select(F.col("path").alias("b_path"), F.col("sig").alias("b_sig"))
    both = a.join(b, F.col("a_path") == F.col("b_path"), "full")
    change = F.when(F.col("a_path").isNull(), "added").when(F.col("b_path").isNull(), "removed").when(~F.col("a_sig").eqNullSafe(F.col("b_sig")), "changed")
    return both.select(F.coalesce("b_path", "a_path").alias("path"), change.alias("change")).where("change IS NOT NULL")


def touched(changed: DataFrame, *captures: DataFrame, path: str = "json_path", key: str = "processo") -> DataFrame:
    """The distinct cases of changed files, by what was captured before and what is now: a file that moves from one case to
    another touches both.  A null case is a case."""
    rows = captures[0].select(path, key)
    for c in captures[1:]:
        rows = rows.union(c.select(path, key))
    return rows.join(changed.select(F.col("path").alias("_path")), F.col(path) == F.col("_path"), "left_semi").select(key).distinct()


def only(df: DataFrame, cases: DataFrame, how: str = "left_semi", key: str = "processo") -> DataFrame:
    """Rows of the cases (or, left_anti, of all others)."""
    return df.join(cases.select(F.col(key).alias("_case")), F.col(key).eqNullSafe(F.col("_case")), how)


def refreshed(mart: DataFrame, cases: DataFrame, rebuild: Callable[..., DataFrame], inputs: list[DataFrame], key: str = "processo") -> DataFrame:
    """JOI1, PRJ6: the mart with the touched cases' rows built anew by rebuild(*inputs), each input cut to these cases; rows of
    all other cases stay as they are.  Cases that have gone from the inputs lose their row."""
    fresh = rebuild(*[only(df, cases, key=key) if key in df.columns else df for df in inputs])
    return only(mart, cases, "left_anti", key).unionByName(fresh)
