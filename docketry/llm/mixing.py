"""Mixing sources to target weights by Pareto order sampling.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, stored, table

WEIGHTS, BUDGET, MOST, SEED = (5, 2, 1), 1.5, 2, 7


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """(source, source_size, source_docs, weight, target) from (source, size).

    Weights repeat over the sources in code-point order, null last.  A source's target is its weight's share of
    budget * all sizes, at most `most` times its size; what is cut is shared again by weight.  In order of
    size / weight, the sources that stop are a leading run, so one pass of running sums over the table of
    sources (one row each, already aggregated) finds the level."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    spot = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (spot + 1).cast("int")).cast("long"))
    order = W.orderBy((F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(0))
    per = per.withColumns({"_cut": F.coalesce(F.sum("source_size").over(before), F.lit(0)), "_used": F.coalesce(F.sum("weight").over(before), F.lit(0)), "_all": F.sum("source_size").over(every), "_weights": F.sum("weight").over(every)})
    level = (F.lit(float(budget)) * F.col("_all") - most * F.col("_cut")) / (F.col("_weights") - F.col("_used"))
    per = per.withColumn("_level", level).withColumn("_free", F.col("weight") * F.col("_level") <= most * F.col("source_size"))
    # the first source that keeps its whole share sets the level for all after it
    per = per.withColumn("_share", F.first(F.when(F.col("_free"), F.col("_level")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    return per.select("source", "source_size", "source_docs", "weight", F.coalesce(F.col("weight") * F.col("_share"), (most * F.col("source_size")).cast("double")).alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """In (0, 1), from 52 bits of a digest of the key and the seed."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Adds size, source_size, target, copies and taken to every row of docs (doc_id, text, source, ...).

    A source takes ratio = target / source_size copies of each of its documents on average.  The whole part is
    taken from every document; the rest is a fixed-size Pareto sample: with u uniform and inclusion chance p =
    the ratio's fraction, documents are ranked by [u / (1 - u)] / [p / (1 - p)] and the first whose sizes fill
    what is left of the target get one copy more.  The size is fixed in words, so a source ends within one
    document of its target.

    The cut is found without sorting a source: its documents fall into about sqrt(n) ranges of the rank value,
    range totals (pre-aggregated) place the cut in one range, and only that range is ordered (about sqrt(n)
    documents; equal ids and sizes are one row with a count).  A cut between equal rows takes just as many of them as
    fit.  Null ids share one u and stand in order of size.  Null texts and texts without words have size 0 and take none; a null source is a source of its own;
    repeated rows count each (equal ones are interchangeable).  Input columns of the added names are replaced."""
    docs = docs.drop(*OWN)
    sized = docs.withColumn("size", _size())
    return _mixed(sized, stored(sized.select("doc_id", "source", "size")), weights, budget, most, seed)


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, seed: int = SEED) -> DataFrame:
    """mix_sources without its texts: doc_id, source and the added columns of every row.  Texts are read once."""
    slim = stored(docs.select("doc_id", "source", _size().alias("size")))
    return _mixed(slim, slim, weights, budget, most, seed)


OWN = ["size", "source_size", "target", "copies", "taken"]


def _mixed(sized: DataFrame, slim: DataFrame, weights: tuple[int, ...], budget: float, most: int, seed: int) -> DataFrame:
    """The mix of rows with a size; slim: their (doc_id, source, size), stored."""
    kept = [c for c in sized.columns if c != "size"]
    targets = stored(source_targets(slim, weights, budget, most))
    parts = targets.select("source", "source_size", "target", (F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))).alias("ratio"), F.ceil(F.sqrt("source_docs")).alias("ranges"))
    parts = parts.select("*", F.coalesce(F.floor("ratio"), F.lit(0)).alias("whole"))
    parts = parts.withColumns({"p": F.coalesce(F.col("ratio") - F.col("whole"), F.lit(0.0)), "left": F.col("target") - F.col("whole") * F.col("source_size")})

    ranked = _with_targets(slim, parts).where("p > 0 AND size > 0").select("source", "doc_id", "size", "left", "ranges", _rank(seed).alias("q"), _range(seed).alias("range"))
    totals = ranked.groupBy("source", "range", "left").agg(F.sum("size").alias("words"))
    run = W.partitionBy("source").orderBy("range")
    totals = totals.withColumn("upto", F.sum("words").over(run))
    cut = totals.where("upto >= left AND upto - words < left").select("source", F.col("range").alias("cut_range"), (F.col("left") - (F.col("upto") - F.col("words"))).alias("room"))
    cut = stored(cut)

    inside = ranked.alias("a").join(cut.alias("c"), F.col("a.source").eqNullSafe(F.col("c.source")) & (F.col("a.range") == F.col("c.cut_range"))).select("a.source", "doc_id", "size", "q", "room")
    inside = inside.groupBy("source", "doc_id", "size", "q", "room").agg(F.count("*").alias("equal"))
    step = W.partitionBy("source").orderBy("q", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, 0)
    inside = inside.withColumn("before", F.sum(F.col("size") * F.col("equal")).over(step) - F.col("size") * F.col("equal"))
    # of n equal rows, those whose own running sum less half their size is within the room
    inside = inside.withColumn("_k", F.floor((F.col("room") - F.col("before")) / F.col("size") + 0.5).cast("long"))
    fits = lambda k: F.col("before") + k * F.col("size") - F.col("size") / 2 <= F.col("room")
    k = F.when(fits(F.col("_k") + 1), F.col("_k") + 1).when(fits(F.col("_k")), F.col("_k")).otherwise(F.col("_k") - 1)
    inside = inside.withColumn("take", F.least(k, F.col("equal"))).where("take > 0")
    last = inside.groupBy("source").agg(F.max(F.struct("q", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "size", "take", "equal")).alias("l")).select("source", F.struct("l.q", "l.id", "l.size").alias("last"), "l.take", "l.equal")
    rule = parts.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").join(last.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left").select("p.*", "cut_range", "last", "take", "equal")
    rule = stored(rule)

    out = _with_targets(sized, rule)
    mine = F.struct(_rank(seed).alias("q"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("size").alias("size"))
    extra = (F.col("p") > 0) & (F.col("size") > 0) & (F.col("cut_range").isNull() | (_range(seed) < F.col("cut_range")) | ((_range(seed) == F.col("cut_range")) & F.coalesce(mine <= F.col("last"), F.lit(False))))
    out = out.withColumn("_extra", extra)
    if rule.where("take < equal").limit(1).count():  # the cut lies between equal rows
        tied = _tied(sized, rule.where("take < equal"))
        rest = ~F.coalesce((F.col("take") < F.col("equal")) & (F.coalesce("doc_id", F.lit(2**63 - 1)) == F.col("last.id")) & (F.col("size") == F.col("last.size")), F.lit(False))
        out = out.where(rest).select(*kept, "size", "source_size", "target", "whole", "_extra").union(tied.select(*kept, "size", "source_size", "target", "whole", "_extra"))
    extra = F.col("_extra")
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.when(extra, 1).otherwise(0)).otherwise(0).cast("long"))
    out = out.withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return out.select(*kept, *OWN)


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _tied(sized: DataFrame, rule: DataFrame) -> DataFrame:
    """The rows equal to the last one of their source's cut, `take` of which get the extra copy (_extra).

    Each gets a number within the part of the input that it is read with; totals of the parts (pre-aggregated) place
    the cut in one part, and only that part's rows are ordered."""
    rows = _with_targets(sized, rule.select("source", "source_size", "target", "whole", "take", F.col("last.id").alias("_id"), F.col("last.size").alias("_size")), F.coalesce("doc_id", F.lit(2**63 - 1)) == F.col("_id"))
    rows = rows.where(F.col("size") - F.col("_size") == 0)  # no join key, so that few texts are counted
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    totals = rows.groupBy("source", "take", part.alias("part")).agg(F.count("*").alias("n"))
    totals = totals.withColumn("upto", F.sum("n").over(W.partitionBy("source").orderBy("part")))
    cut = totals.where("upto >= take AND upto - n < take").select(F.col("source").alias("_source"), F.col("part").alias("_part"), (F.col("take") - F.col("upto") + F.col("n")).alias("_left"))
    inside = rows.select("source", "_at").join(cut, F.col("source").eqNullSafe(F.col("_source")) & (part == F.col("_part")))
    inside = inside.withColumn("_k", F.row_number().over(W.partitionBy("source").orderBy("_at")))
    final = stored(inside.where("_k = _left").select("source", F.col("_at").alias("_last")))
    return _with_targets(rows, final).withColumn("_extra", F.col("_at") <= F.col("_last"))


def _rank(seed: int) -> Column:
    u, p = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), seed), F.col("p")
    return (u / (1 - u)) / (p / (1 - p))


def _range(seed: int) -> Column:
    q = _rank(seed)
    return F.floor(q / (1 + q) * F.col("ranges")).cast("long")


def _with_targets(docs: DataFrame, parts: DataFrame, also: Column | None = None) -> DataFrame:
    """Joins one row a source to the documents; a hot source's rows split, since the other side has one row."""
    parts = parts.select(F.col("source").alias("_source"), *[c for c in parts.columns if c != "source"])
    same = F.col("source").eqNullSafe(F.col("_source"))
    return docs.join(parts, same if also is None else same & also).drop("_source")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: rows that are taken, with how many copies.  Rows of null, shared and repeated ids are rows of their
    own; texts without words are taken by none; other columns of docs are left out."""
    return mix_sources(docs).where("copies > 0").select("doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "copies", "taken")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS spot
  FROM d GROUP BY source),
w AS (SELECT source, source_size, [5, 2, 1][spot % 3 + 1]::BIGINT AS weight FROM s),
level(n, cut) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT n + 1, list_concat(cut, over) FROM (
    SELECT level.n, level.cut, (
      SELECT list(coalesce(source, chr(0))) FROM w WHERE NOT list_contains(level.cut, coalesce(source, chr(0)))
      AND weight * ((SELECT 1.5 * sum(source_size) FROM w) - (SELECT coalesce(sum(2 * source_size), 0) FROM w WHERE list_contains(level.cut, coalesce(source, chr(0)))))
        / (SELECT sum(weight) FROM w WHERE NOT list_contains(level.cut, coalesce(source, chr(0)))) > 2 * source_size) AS over
    FROM level) WHERE len(over) > 0),
final AS (SELECT cut FROM level ORDER BY n DESC LIMIT 1),
t AS (
  SELECT source, source_size, weight, CASE WHEN list_contains(cut, coalesce(source, chr(0))) THEN (2 * source_size)::DOUBLE ELSE
    weight * (((SELECT 1.5 * sum(source_size) FROM w) - (SELECT coalesce(sum(2 * source_size), 0) FROM w WHERE list_contains(cut, coalesce(source, chr(0)))))::DOUBLE
      / (SELECT sum(weight) FROM w WHERE NOT list_contains(cut, coalesce(source, chr(0))))) END AS target
  FROM w, final),
p AS (SELECT *, floor(target / source_size)::BIGINT AS whole, target / source_size - floor(target / source_size) AS f FROM t WHERE source_size > 0),
q AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.f, p.target - p.whole * p.source_size AS room, CASE WHEN f > 0 AND size > 0 THEN (u / (1 - u)) / (f / (1 - f)) END AS q
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
c AS (SELECT *, sum(CASE WHEN q IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto FROM q)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN q IS NOT NULL AND upto - size / 2 <= room THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
