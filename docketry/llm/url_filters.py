"""URL filters: host-suffix and path-prefix expressions, joined to rules by a short hash prefix and
confirmed by the full digest; the longest rule wins.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: The contract's rules (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
DEFAULT = "allow"
#: Rules up to this number are broadcast (some 100 bytes each); more are joined by shuffle.
BROADCAST_RULES = 100_000
#: Hexadecimal digits of the hash prefix that urls and rules are joined on.
SHORT = 8


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _keyed(df: DataFrame, expression: Column) -> DataFrame:
    digest = F.sha2(expression, 256)
    return df.withColumns({"digest": digest, "short": F.conv(F.substring(digest, 1, SHORT), 16, 10).cast("long")})


def rule_table(rules: DataFrame) -> DataFrame:
    """One row a rule expression: hosts lower-cased, null hosts or paths dropped; of several verdicts on one
    expression, block wins."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), F.col("path"), F.col("verdict")).dropna()
    rules = rules.where("host <> ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.select(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_len"), F.length("path").alias("path_len"), F.size(F.split("host", "[.]")).alias("labels"))
    return _keyed(rules, F.col("rule"))


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """Adds host, path, rule, verdict to every row.

    A url is expanded only into the pairs of host-suffix label count and path-prefix length that some rule has, so
    the expansion grows neither with the url nor with every count times every length.  Expressions and rules meet by
    the short hash prefix alone; of those that do, the full digest decides.  Distinct (host, path) pairs are expanded, matched and reduced;
    the decisions go back by an outer join whose right side has one row a pair, so hot urls split freely.
    Null urls or urls without `://`: host and path empty, no rule, the default verdict.  Repeated rows each get
    their verdict; empty tables give empty results.  Own columns host, path, rule, verdict are replaced."""
    rules = rule_table(rules)
    shape = rules.agg(F.count("*").alias("n"), F.sort_array(F.collect_set(F.struct("labels", "path_len"))).alias("shapes")).first()
    judged = urls.withColumn("host", url_host(F.col(url_col))).withColumn("path", url_path(F.col(url_col))).drop("rule", "verdict")
    if not shape["n"]:
        return judged.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    if shape["n"] <= BROADCAST_RULES:
        rules = F.broadcast(rules)

    shapes = F.array(*[F.struct(F.lit(x["labels"]).alias("k"), F.lit(x["path_len"]).alias("n")) for x in shape["shapes"]])  # one a shape of the rules
    pairs = judged.select("host", "path").where("host <> ''").groupBy("host", "path").agg(F.count("*").alias("urls"))
    labels = F.split("host", "[.]")
    fitting = F.filter(shapes, lambda x: (F.size(labels) >= x["k"]) & (F.length("path") >= x["n"]))
    expressions = F.transform(fitting, lambda x: F.concat(F.array_join(F.slice(labels, -x["k"], x["k"]), "."), F.substring(F.col("path"), F.lit(1), x["n"])))
    expressions = F.transform(fitting, lambda x, i: F.struct(F.get(expressions, i).alias("text"), F.length(F.array_join(F.slice(labels, -x["k"], x["k"]), ".")).alias("host_len")))
    expanded = pairs.select("host", "path", F.explode(expressions).alias("e")).select("host", "path", F.col("e.host_len").alias("e_host_len"), F.col("e.text").alias("text"))
    near = _keyed(expanded, F.col("text")).select("host", "path", "e_host_len", "short", "text").alias("u").join(rules.alias("r"), "short")
    hits = near.where((F.sha2("u.text", 256) == F.col("r.digest")) & (F.col("e_host_len") == F.col("r.host_len")))
    best = hits.groupBy(F.col("u.host").alias("h"), F.col("u.path").alias("p")).agg(F.max(F.struct(F.length("r.rule").alias("n"), F.col("r.host_len").alias("m"), F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))).alias("best"))
    best = best.select("h", "p", F.xxhash64("h", "p").alias("k"), "best.rule", "best.verdict")
    out = judged.join(best, (F.xxhash64("host", "path") == F.col("k")) & (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").drop("h", "p", "k")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def rules_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) t(h, p, v)),
m AS (
  SELECT u.*, r.h || r.p AS rule, r.v FROM u LEFT JOIN r
  ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""
