"""Dashboard functions: typing, filters, aggregates, generators and sorts (inventory FLT, PRJ, AGG, EXP, SRT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import is_period_token, month_bucket
from ..functions.text import clean_spaces, empty_to_null, to_bool, to_float, to_int


# --- typing -----------------------------------------------------------------------------------------------------
def typed(df: DataFrame, bools: list[str] = (), ints: list[str] = (), floats: list[str] = (), dates: list[str] = (), present: dict[str, str] | None = None) -> DataFrame:
    """PRJ1, PRJ3: text columns to types, those that are there; present adds flags for columns that aren't empty."""
    has = set(df.columns)
    new = {c: to_bool(F.col(c)) for c in bools if c in has} | {c: to_int(F.col(c)) for c in ints if c in has} | {c: to_float(F.col(c)) for c in floats if c in has} | {c: F.try_to_date(F.col(c), "yyyy-MM-dd") for c in dates if c in has}
    new |= {flag: empty_to_null(F.col(c)).isNotNull() for flag, c in (present or {}).items() if c in has}
    return df.withColumns(new) if new else df


def plan_columns(df: DataFrame) -> DataFrame:
    """PRJ2: one duties column of its two spellings, and has_goals, has_actions, has_deadline."""
    names = [c for c in ("atribuições_raw", "atribuicoes_raw") if c in df.columns]
    duties = F.coalesce(*[empty_to_null(F.col(c)) for c in names], F.lit("")) if names else F.lit("")
    flag = lambda c: empty_to_null(F.col(c).cast("string")).isNotNull()
    return df.withColumns({"atribuicoes": duties, "has_goals": flag("metas"), "has_actions": flag("acoes"), "has_deadline": flag("vigencia_fim")}).drop(*names)


# --- filters ----------------------------------------------------------------------------------------------------
def presence(df: DataFrame, flag: str, choice: str = "Todos") -> DataFrame:
    """FLT1: Com (with), Sem (without), anything else all."""
    return df.where(F.col(flag)) if choice == "Com" else df.where(~F.col(flag)) if choice == "Sem" else df


def overview_filter(df: DataFrame, processes: list[str] | None = None, partners: list[str] | None = None, qualities: list[str] | None = None, **flags: str) -> DataFrame:
    """FLT1: the lists that are given (None is no filter) and presence by family, e.g. has_pt='Com'."""
    for column, values in (("processo", processes), ("parceiro", partners), ("quality_status", qualities)):
        if values is not None:
            df = df.where(F.col(column).isin(values)) if values else df.limit(0)
    for flag, choice in flags.items():
        df = presence(df, flag, choice)
    return df


def choices(df: DataFrame, column: str) -> DataFrame:
    """FLT3: distinct filled values in order."""
    return df.select(F.trim(column).alias(column)).where(F.col(column) != "").distinct().orderBy(column)


def problems(df: DataFrame) -> DataFrame:
    """FLT4: not gold, a mismatch, or several attempts."""
    return df.where((F.col("publication_status") != "published_gold") | F.col("has_mismatch") | (F.col("attempts") > 1))


def audit_or_gold(audit: DataFrame, gold: DataFrame) -> DataFrame:
    """FLT5: the audit, or gold where the audit is empty."""
    return gold if audit.isEmpty() else audit


def without_deadline(df: DataFrame) -> DataFrame:
    """FLT6."""
    return df.where(empty_to_null(F.col("vigencia_fim").cast("string")).isNull())


def gold(df: DataFrame, path: str | None = None) -> DataFrame:
    """FLT7."""
    df = df.where(F.col("publication_status") == "published_gold")
    return df.where(empty_to_null(F.col(path)).isNotNull()) if path else df


# --- projections ------------------------------------------------------------------------------------------------
def gold_else_preview(value: Column, preview: Column, name: str) -> list[Column]:
    """PRJ4: the value, else the preview's, and where it is from."""
    v, p = empty_to_null(value), empty_to_null(preview)
    return [F.coalesce(v, p, F.lit("")).alias(name), F.when(v.isNotNull(), "gold").when(p.isNotNull(), "preview").otherwise("missing").alias(f"{name}_source")]


def notes(*parts: tuple[Column, str]) -> Column:
    """PRJ5: the texts whose conditions hold, joined by `; `."""
    return F.concat_ws("; ", *[F.when(c, F.lit(t)) for c, t in parts])


def missing_fields(columns: dict[str, str]) -> Column:
    """PRJ7: names of the empty columns, joined by `, `."""
    return F.array_join(F.array_compact(F.array(*[F.when(empty_to_null(F.col(c).cast("string")).isNull(), F.lit(n)) for n, c in columns.items()])), ", ")


def tracking(attempts: DataFrame, not_found: DataFrame, failures: DataFrame) -> DataFrame:
    """PRJ8: three kinds of tracking record as one table; columns that a kind lacks are null."""
    tag = lambda df, kind: df.withColumn("record_kind", F.lit(kind))
    return tag(attempts, "attempt").unionByName(tag(not_found, "not_found"), allowMissingColumns=True).unionByName(tag(failures, "failure"), allowMissingColumns=True)


def context(found: Column, **values: Column) -> Column:
    """PRJ9."""
    return F.struct(found.alias("found"), *[F.coalesce(v.cast("string"), F.lit("")).alias(k) for k, v in values.items()])


def hits(df: DataFrame, key: str = "result_set") -> DataFrame:
    """PRJ10: place in the result set, total (the larger of the counted and the listed), and an id that is never empty."""
    listed = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    out = df.join(listed, F.col(key) == F.col("_k"))
    out = out.withColumn("position", F.row_number().over(W.partitionBy(key).orderBy("row_idx")))
    return out.withColumns({"total_resultados": F.greatest("_n", "counted"), "protocolo": F.coalesce(empty_to_null(F.col("protocolo")), clean_spaces(F.col("row_text")))}).drop("_k", "_n")


# --- aggregates -------------------------------------------------------------------------------------------------
def span_totals(df: DataFrame) -> DataFrame:
    """AGG1."""
    return df.groupBy("name").agg(F.sum("seconds").alias("total_seconds"), F.count("*").alias("calls"))


def rejection_summary(df: DataFrame, key: str, label: Column) -> DataFrame:
    """AGG2: `label(n) | label(n)` in order of the labels.  Counted before it is packed, so a key's list has one item
    a label."""
    counted = df.groupBy(key, label.alias("label")).agg(F.count("*").alias("n"))
    items = F.array_sort(F.collect_list(F.struct("label", "n")))
    return counted.groupBy(key).agg(F.array_join(F.transform(items, lambda x: F.concat(x["label"], F.lit("("), x["n"].cast("string"), F.lit(")"))), " | ").alias("summary"))


def attempts_per_process(df: DataFrame) -> DataFrame:
    """AGG3."""
    return df.groupBy("processo").agg(F.count("*").alias("attempts"))


def level_counts(df: DataFrame, levels: tuple[str, ...] = ("info", "warning", "error"), column: str = "level") -> DataFrame:
    """AGG4: one row with total and a count a level; other levels are only in the total."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(F.lower(column) == x).alias(x) for x in levels])


def runtime(selected: DataFrame, total_seconds: float) -> DataFrame:
    """AGG5: sum and mean of the positive spans of the selected cases; without any, the run's time shared by them."""
    return selected.agg(
        F.count("*").alias("selected"),
        F.coalesce(F.sum(F.when(F.col("total_seconds") > 0, F.col("total_seconds"))), F.lit(total_seconds)).alias("total"),
        F.coalesce(F.avg(F.when(F.col("total_seconds") > 0, F.col("total_seconds"))), F.lit(total_seconds) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("mean"),
    )


def group_sizes(df: DataFrame, *keys: str) -> DataFrame:
    """AGG6."""
    return df.groupBy(*keys).count()


def coverage(df: DataFrame, flags: list[str]) -> DataFrame:
    """AGG7: rows that have each flag, one row a flag."""
    sums = df.agg(*[F.count_if(F.col(c)).alias(c) for c in flags])
    return sums.selectExpr(f"stack({len(flags)}, {', '.join(f"'{c}', `{c}`" for c in flags)}) AS (family, covered)")


def distinct_where(df: DataFrame, key: str, tests: dict[str, Column]) -> DataFrame:
    """AGG8: distinct keys that meet each test; a key may meet several.  Reduced to one row a key first, so there is one
    shuffle and no expansion by test."""
    per = df.groupBy(key).agg(*[F.max(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()]).where(F.col(key).isNotNull())
    return per.agg(*[F.count_if(F.col(n)).alias(n) for n in tests])


def value_and_regions(df: DataFrame, value: str, region: str) -> DataFrame:
    """AGG9."""
    return df.agg(F.sum(value).alias("total_value"), F.count_distinct(F.col(region)).alias("regions"))


def top_groups(df: DataFrame, key: str, n: int = 10, measure: Column | None = None) -> DataFrame:
    """AGG11, SRT1: the n largest groups, ties by key."""
    return df.groupBy(key).agg((F.count("*") if measure is None else measure).alias("n")).orderBy(F.col("n").desc(), F.col(key).asc()).limit(n)


def timeline(df: DataFrame, date: str) -> DataFrame:
    """AGG12: rows a month."""
    return df.where(F.col(date).isNotNull()).groupBy(month_bucket(F.col(date)).alias("month")).agg(F.count("*").alias("n")).orderBy("month")


def screening(df: DataFrame, skip: Column, *keys: str) -> DataFrame:
    """AGG13: evaluated, skipped and the per cent skipped."""
    return df.groupBy(*keys).agg(F.count("*").alias("evaluated"), F.count_if(skip).alias("skipped")).withColumn("skipped_pct", F.round(100 * F.col("skipped") / F.nullif("evaluated", F.lit(0)), 2))


# --- generators -------------------------------------------------------------------------------------------------
def unpack(c: Column) -> Column:
    """Items of a `||` list, each its parts between `|`, trimmed, without empty ones."""
    parts = lambda x: F.filter(F.transform(F.split(x, r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|\|"), parts), lambda p: F.size(p) > 0)


def pack(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda p: F.array_join(p, " | ")), " || ")


def _without_ref(parts: Column) -> tuple[Column, Column]:
    ref = (F.size(parts) > 1) & F.get(parts, F.lit(0)).rlike(r"^\d+[.)]?$")
    return F.when(ref, F.get(parts, F.lit(0))).otherwise(""), F.when(ref, F.slice(parts, F.lit(2), F.size(parts) - 1)).otherwise(parts)


def explode_goals(df: DataFrame, column: str = "metas") -> DataFrame:
    """EXP1: one row a goal: its place, reference number and text."""
    rows = df.select(*df.columns, F.posexplode(unpack(F.col(column))).alias("item", "_p"))
    ref, rest = _without_ref(F.col("_p"))
    return rows.withColumns({"reference": ref, "description": F.array_join(rest, " | ")}).drop("_p")


def explode_actions(df: DataFrame, column: str = "acoes") -> DataFrame:
    """EXP2: as EXP1, with owner and period: the first part that names a period starts it and the part before is the
    owner; without one, the last of three or more parts is the owner."""
    rows = df.select(*df.columns, F.posexplode(unpack(F.col(column))).alias("item", "_p"))
    ref, rest = _without_ref(F.col("_p"))
    rows = rows.withColumns({"reference": ref, "_r": rest})
    at = F.array_position(F.transform(F.slice("_r", F.lit(2), F.greatest(F.size("_r") - 1, F.lit(0))), is_period_token), F.lit(True)).cast("int") + 1
    rows = rows.withColumn("_at", F.when(at > 1, at).otherwise(0)).withColumn("_n", F.size("_r"))
    owner = F.when(F.col("_at") > 2, F.get("_r", F.col("_at") - 2)).when((F.col("_at") == 0) & (F.col("_n") >= 3), F.get("_r", F.col("_n") - 1)).otherwise("")
    text = F.when(F.col("_at") > 2, F.slice("_r", F.lit(1), F.col("_at") - 2)).when(F.col("_at") == 2, F.slice("_r", F.lit(1), F.lit(1))).when(F.col("_n") >= 3, F.slice("_r", F.lit(1), F.col("_n") - 1)).otherwise(F.col("_r"))
    period = F.when(F.col("_at") > 0, F.array_join(F.slice("_r", F.greatest("_at", F.lit(1)), F.col("_n")), " | ")).otherwise("")
    return rows.withColumns({"description": F.array_join(text, " | "), "owner": owner, "period": period}).drop("_p", "_r", "_at", "_n")


def explode_rejections(df: DataFrame, key: str, column: str = "summary") -> DataFrame:
    """EXP3: `label(n)` lists back to rows."""
    items = df.select(key, F.explode(F.split(F.coalesce(column, F.lit("")), r" \| ")).alias("_i"))
    p = r"^\s*(.+)\((\d+)\)\s*$"
    return items.where(F.col("_i").rlike(p)).select(key, F.regexp_extract("_i", p, 1).alias("label"), F.regexp_extract("_i", p, 2).cast("long").alias("n"))


def span_rows(df: DataFrame, column: str = "spans") -> DataFrame:
    """EXP5: a map of spans to rows."""
    return df.select(F.explode(column).alias("name", "_v")).select("name", "_v.total_seconds", "_v.calls")


# --- sorts ------------------------------------------------------------------------------------------------------
def latest(df: DataFrame, n: int, order: str = "line_no") -> DataFrame:
    """SRT2: the last n rows in order; 0 is none."""
    return df.orderBy(F.col(order).desc()).limit(max(0, n)).orderBy(order)


def rank_by(df: DataFrame, column: str, key: str, top: int = 5) -> DataFrame:
    """SRT3: adds is_top to the `top` rows with the largest value; only these are ranked, not the table."""
    best = df.orderBy(F.col(column).desc(), F.col(key).asc()).limit(top).select(F.col(key).alias("_k"), F.lit(True).alias("_t"))
    return df.join(F.broadcast(best), F.col(key) == F.col("_k"), "left").withColumn("is_top", F.coalesce("_t", F.lit(False))).drop("_k", "_t").orderBy(F.col(column).desc(), F.col(key).asc())


def first_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """LIM1: at most n rows of each group."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")
