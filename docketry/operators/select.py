"""First, best and canonical rows, the candidate funnel, and de-duplication (inventory SEL), with the joins that use
them (inventory JOI).  Ties are broken by row_idx, taken when a table is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_spaces, empty_to_null, fold
from . import ordered


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order (SEL1-SEL3).  The rank filter becomes a group limit, which drops
    losers before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def first_per_process(df: DataFrame) -> DataFrame:
    """SEL1."""
    return best_per_key(df, ["processo"], [F.col("row_idx").asc()])


def best_plan(df: DataFrame) -> DataFrame:
    """SEL2: gold first, then captured fields, then the longer object."""
    return best_per_key(df, ["processo"], [(F.col("publication_status") == "published_gold").desc(), F.col("captured_focus_fields").desc_nulls_last(), F.coalesce(F.length("objeto"), F.lit(0)).desc(), F.col("row_idx").asc()])


def best_agreement(df: DataFrame) -> DataFrame:
    """SEL3: gold first, then score, then the longer object."""
    return best_per_key(df, ["processo"], [(F.col("publication_status") == "published_gold").desc(), F.col("canonical_score").desc_nulls_last(), F.coalesce(F.length("objeto"), F.lit(0)).desc(), F.col("row_idx").asc()])


def choose_canonical(df: DataFrame, keys: list[str], eligible: Column, order: list[Column]) -> DataFrame:
    """SEL4: adds normalization_status, publication_status and discard_reason.

    The best eligible row of a key is published; other eligible rows lost the tie-break; the rest keep their
    discard_reason, or get their class.  Winners are found with a limit a key before the shuffle and marked on the stored
    rows by their place, so a key (the empty one, say) may hold most rows."""
    rows = ordered.stored(df.withColumns({"_ok": F.coalesce(eligible, F.lit(False)), "_id": F.monotonically_increasing_id()}))
    best = best_per_key(rows.where("_ok"), keys, order).select(F.col("_id").alias("_best"))
    won, ok = F.col("_best").isNotNull(), F.col("_ok")
    reason = F.when(won, "").when(ok, "act_final_nao_canonico").otherwise(F.coalesce(empty_to_null(F.col("discard_reason")), F.col("doc_class")))
    status = F.when(won, "publicado_canonico").when(ok, "descartado_por_desempate").otherwise("descartado_nao_canonico")
    rows = rows.join(best, F.col("_id") == F.col("_best"), "left")
    return rows.withColumns({"normalization_status": status, "publication_status": F.when(won, "published_gold").otherwise("retained_silver"), "discard_reason": reason}).drop("_ok", "_id", "_best")


def funnel(candidates: DataFrame, top: int = 5) -> DataFrame:
    """SEL5: adds to (processo, type, source, alias_ord, position, label, score, is_canonical, skip) the columns seq,
    state and outcome.

    Per alias the first `top` hits count; then tree candidates by score and label.  Skipped labels aren't opened; the
    first canonical one wins and nothing after it is opened.  Hits are limited an alias before the shuffle, numbers are
    running values over ranges, and a case's outcome is aggregated and joined back: no task holds a case."""
    rows = ordered.stored(candidates.withColumn("_id", F.monotonically_increasing_id()))
    tree = F.col("source") == "tree"
    hits = W.partitionBy("processo", "type", "source", "alias_ord").orderBy("position", "_id")
    listed = rows.where(~tree).withColumn("_k", F.row_number().over(hits)).where(F.col("_k") <= top).select(F.col("_id").alias("_hit"))
    df = rows.join(listed, F.col("_id") == F.col("_hit"), "left").withColumn("_listed", tree | F.col("_hit").isNotNull())
    order = [F.col("_listed").desc(), tree.asc(), F.when(~tree, F.col("alias_ord")).asc(), F.when(~tree, F.col("position")).asc(), F.when(tree, F.col("score")).desc_nulls_last(), F.col("label").asc(), F.col("_id").asc()]
    df = ordered.stored(ordered.numbered(df, ["processo", "type"], order, "seq"))
    opens = F.col("_listed") & ~F.col("skip")
    case = df.groupBy(F.col("processo").alias("_p"), F.col("type").alias("_t")).agg(F.min(F.when(opens & F.col("is_canonical"), F.col("seq"))).alias("_win"), F.max(F.when(opens & ~tree, 1).otherwise(0)).alias("_opened"))
    df = df.join(case, F.col("processo").eqNullSafe(F.col("_p")) & F.col("type").eqNullSafe(F.col("_t")))
    state = F.when(~F.col("_listed"), "beyond_top").when(F.col("seq") > F.col("_win"), "not_opened").when(F.col("skip"), "skipped").when(F.col("seq") == F.col("_win"), "chosen").otherwise("rejected")
    tried = F.col("type").isin("pt", "act", "ted")
    outcome = F.when(F.col("_win").isNotNull(), "found").otherwise(F.concat(F.when(F.col("_opened") == 1, "no_canonical_candidate_after_filter").otherwise("not_found_after_filter"), F.when(tried, "_and_tree").otherwise("")))
    return df.withColumns({"state": state, "outcome": outcome}).drop("_id", "_hit", "_listed", "_p", "_t", "_win", "_opened")


def best_per_text(df: DataFrame, text: str = "label", score: str = "score") -> DataFrame:
    """SEL6: of each folded text the row with the largest score."""
    best = df.groupBy(fold(F.col(text)).alias("norm")).agg(F.max(F.struct(score, text)).alias("b"))
    return best.select("norm", F.col(f"b.{score}").alias(score), F.col(f"b.{text}").alias(text)).orderBy(F.col(score).desc(), "norm")


def distinct_terms(aliases: Column, terms: Column) -> Column:
    """SEL7: aliases, or terms if there is none; of each folded form the first spelling."""
    use = F.filter(F.transform(F.when(F.size(aliases) > 0, aliases).otherwise(terms), clean_spaces), lambda x: x != "")
    keys = F.transform(use, lambda x: fold(x))
    return F.filter(use, lambda x, i: F.array_position(keys, fold(x)) == i + 1)


def distinct_rows(df: DataFrame, keys: list[str] = ["seq", "processo", "numero_act"]) -> DataFrame:  # noqa: B006
    """SEL8: the first row of each key by page and place."""
    return best_per_key(df, keys, [F.col("page").asc(), F.col("row_idx").asc()])


def repeated_pages(df: DataFrame) -> DataFrame:
    """SEL8: pages whose first case and number of rows an earlier page had."""
    pages = df.groupBy("page").agg(F.min_by("processo", "row_idx").alias("first"), F.count("*").alias("n"))
    return pages.withColumn("repeats", F.row_number().over(W.partitionBy("first", "n").orderBy("page")) > 1)


def distinct_links(df: DataFrame) -> DataFrame:
    """SEL9."""
    return df.where((F.coalesce("text", F.lit("")) != "") | (F.coalesce("href", F.lit("")) != "")).dropDuplicates(["text", "href"])


def result_signature(df: DataFrame, key: str = "result_set") -> DataFrame:
    """SEL10: state, total and the first three ids of each result set, by one aggregation of bounded state: the three
    least places are kept, not the list."""
    third = F.array_sort(F.collect_list(F.struct("position", "protocolo")))
    head = df.where(F.col("position") <= 3).groupBy(F.col(key).alias("k")).agg(F.array_join(F.transform(third, lambda x: x["protocolo"]), ",").alias("ids"))
    sizes = df.groupBy(key).agg(F.max("state").alias("state"), F.max("total").alias("total"))
    return sizes.join(head, F.col(key) == F.col("k"), "left").select(key, F.concat_ws("|", "state", "total", "ids").alias("signature"))


def ordered_distinct(c: Column) -> Column:
    """SEL11."""
    return F.array_distinct(F.filter(F.transform(c, clean_spaces), lambda x: x != ""))


def with_previews(plans: DataFrame, previews: DataFrame) -> DataFrame:
    """JOI2: plans with the first preview of their case; absent values are empty."""
    one = first_per_process(previews).select(F.col("processo").alias("_p"), *[F.col(c).alias(f"preview_{c}") for c in ("parceiro", "vigencia", "objeto", "numero_act")])
    out = plans.join(one, F.col("processo") == F.col("_p"), "left").drop("_p")
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in out.columns if c.startswith("preview_")})


def sync_from_audit(status: DataFrame, audit: DataFrame, columns: list[str], key: str = "json_path") -> DataFrame:
    """JOI3: columns of status overwritten by the audit's non-empty values; the last audit row of a key counts."""
    last = best_per_key(audit, [key], [F.col("row_idx").desc()]).select(F.col(key).alias("_k"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = status.join(last, F.col(key) == F.col("_k"), "left")
    return out.withColumns({c: F.coalesce(empty_to_null(F.col(f"_new_{c}")), F.col(c)) for c in columns}).drop("_k", *[f"_new_{c}" for c in columns])


def by_path_or_name(left: DataFrame, right: DataFrame, path: str, values: list[str]) -> DataFrame:
    """SRC8, JOI4: values of the right row with the same path, else with the same file name (the first by path)."""
    name = lambda c: F.regexp_extract(c, r"[^/\\]+$", 0)
    exact = best_per_key(right, [path], [F.col("row_idx").asc()]).select(F.col(path).alias("_p1"), *[F.col(v).alias(f"_a_{v}") for v in values])
    named = best_per_key(right.withColumn("_n2", name(F.col(path))), ["_n2"], [F.col(path).asc(), F.col("row_idx").asc()]).select("_n2", *[F.col(v).alias(f"_b_{v}") for v in values])
    out = left.join(exact, F.col(path) == F.col("_p1"), "left").join(named, name(F.col(path)) == F.col("_n2"), "left")
    return out.withColumns({v: F.coalesce(f"_a_{v}", f"_b_{v}") for v in values}).drop("_p1", "_n2", *[f"_{s}_{v}" for s in "ab" for v in values])


def match_targets(df: DataFrame, targets: list[str], text: str, mode: str = "contains") -> DataFrame:
    """JOI5: rows with target and target_ord, the first target that the folded text holds (or equals).  Targets are
    configuration; they become one CASE, not a join."""
    out = F.lit(None).cast("struct<ord:int,target:string>")
    for i, t in reversed(list(enumerate(targets))):
        hit = fold(F.col(text)) == fold(F.lit(t)) if mode == "equals" else F.contains(fold(F.col(text)), fold(F.lit(t)))
        out = F.when(hit, F.struct(F.lit(i).alias("ord"), F.lit(t).alias("target"))).otherwise(out)
    return df.withColumn("_m", out).where("_m IS NOT NULL").withColumns({"target": F.col("_m.target"), "target_ord": F.col("_m.ord")}).drop("_m")


def target_counts(df: DataFrame, targets: list[str], text: str) -> DataFrame:
    """AGG14: rows matched by each target, those without any included."""
    found = match_targets(df, targets, text).groupBy("target").count()
    every = df.sparkSession.createDataFrame([(t,) for t in targets], "t string")
    return every.join(found, F.col("t") == F.col("target"), "left").select(F.col("t").alias("target"), F.coalesce("count", F.lit(0)).alias("matched"))


def with_counts(base: DataFrame, counts: dict[str, DataFrame], key: str = "processo") -> DataFrame:
    """JOI6: distinct keys with the number of rows of each table, 0 where there is none."""
    out = base.select(key).where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").distinct()
    for name, df in counts.items():
        out = out.join(df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias(name)), F.col(key) == F.col("_k"), "left").drop("_k").na.fill(0, [name])
    return out


def explorer(tables: dict[str, DataFrame], process: str) -> DataFrame:
    """JOI7: one row with the first row of each table for one case, as JSON; null where a table has none."""
    rows = None
    for name, df in tables.items():
        own = df.where(F.col("processo") == process).select(F.lit(name).alias("_t"), F.col("row_idx").cast("long").alias("_i"), F.to_json(F.struct(*df.columns)).alias("_j"))
        rows = own if rows is None else rows.union(own)
    return rows.agg(*[F.min_by("_j", F.when(F.col("_t") == name, F.col("_i"))).alias(name) for name in tables]).withColumn("processo", F.lit(process))


def span_seconds(processes: DataFrame, spans: DataFrame) -> DataFrame:
    """JOI8: seconds of the span `processo:<id>` of each case."""
    return processes.join(spans.select(F.col("name").alias("_n"), "total_seconds"), F.concat(F.lit("processo:"), "processo") == F.col("_n"), "left").drop("_n")


def only_selected(df: DataFrame, selection: DataFrame | None, key: str = "processo") -> DataFrame:
    """JOI9, FLT2: rows of the selected keys.  None is no filter; an empty selection leaves no row."""
    return df if selection is None else df.join(selection.select(key).distinct(), key, "left_semi")


def manifest_details(manifest: DataFrame, payloads: DataFrame, path: str = "json_path") -> DataFrame:
    """EXP4: published memoranda or terms with what their snapshot or payload holds, empty where it is absent."""
    values = ["objeto", "valor_global", "situacao", "uf", "snapshot_text"]
    have = [v for v in values if v in payloads.columns]
    out = by_path_or_name(manifest, payloads, path, have)
    return out.select("processo", "documento", "snapshot_mode", path, *[F.coalesce(F.col(v).cast("string"), F.lit("")).alias(v) if v in have else F.lit("").alias(v) for v in values])
