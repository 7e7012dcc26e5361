"""Run-log analysis: visits, stage times, attempts and counters (inventory LOG).

A run is one log file; its lines are ordered by (ts, line_no).  States that pass from line to line (the open case, the
stage, the last attempt) are running values over ranges of lines, so one run may be most of a table and spans tasks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered
from .classify import CASE_NUMBER, family_of

FAMILIES = ("PT", "ACT", "MEMORANDO", "TED")
#: Stages and their labels.
STAGES = {"abertura_processo": "abertura do processo", "busca_pt": "busca PT", "busca_act": "busca ACT", "busca_memorando": "busca MEMORANDO", "busca_ted": "busca TED", "fallback_arvore": "fallback pela arvore"}
#: The messages of a run's log.  In braces: a case number, a family, a text, a quoted text, anything.
MESSAGES = {
    "open": "Abrindo processo {case}",
    "close": "Processo {case}: fechando aba e voltando",
    "click": "clicando Pesquisar no Processo para {text}.",
    "filter_open": "filtro ja estava aberto para {text}.",
    "search": "iniciando busca do documento '{quoted}'",
    "none": "Processo {case}: {family} termo{any}sem resultado no filtro",
    "fail": "Processo {case}: {family} termo{any}falhou no filtro",
    "fall": "Processo {case}: nenhum candidato canonico de {family} consolidado no filtro; tentando fallback pela arvore",
    "fall_line": "Fallback arvore {family}:",
    "reload": "restaurando contexto base do processo",
}
_SLOTS = {"case": f"({CASE_NUMBER})", "family": f"({'|'.join(FAMILIES)})", "text": r"([^\n]+?)", "quoted": "([^']+)", "any": r"\b.*"}


def _pattern(message: str) -> str:
    """The pattern of a message: its slots as groups, any blanks between its words."""
    parts = re.split(r"\{(\w+)\}", message)
    return "(?is)" + "".join(_SLOTS[x] if k % 2 else r"\s+".join(re.escape(w) for w in x.split(" ")) for k, x in enumerate(parts))


def features(df: DataFrame, message: str = "message") -> DataFrame:
    """LOG6: what a message says, one column a slot; empty where it does not match."""
    get = lambda name, group=1: F.nullif(F.regexp_extract(message, _pattern(MESSAGES[name]), group), F.lit(""))
    both = {f"{name}_{part}": F.upper(get(name, k)) for name in ("none", "fail", "fall") for k, part in ((1, "case"), (2, "doc"))}
    return df.withColumns({
        "open_case": get("open"), "close_case": get("close"), **{name: family_of(get(name)) for name in ("click", "filter_open", "search")}, **both,
        "fall_line": F.upper(get("fall_line")), "reload": F.col(message).rlike(_pattern(MESSAGES["reload"])), "reload_doc": F.upper(F.nullif(F.regexp_extract(message, rf"(?i)\b{_SLOTS['family']}\b", 1), F.lit(""))),
    })


def visits(df: DataFrame, run: str, ts: str, order: str, opens: Column, key: Column, closes: Column) -> DataFrame:
    """LOG1: adds visit, case, next_ts and is_close; lines outside a visit are dropped.

    A line for which opens holds begins a visit of `key`; the first for which closes equals the visit's key ends it;
    else the next opening line does, or the run's last line.  Lines stay in the ranges of ordered.laid() (_part, _at), in
    which stage_seconds() and attempts() go on; df may lie in such ranges of (run; ts, order) already."""
    df = df.withColumns({"_open": F.coalesce(opens, F.lit(False)), "_close": closes, "_key": key})
    rows = df if "_part" in df.columns else ordered.laid(df, [run], [ts, order])
    opened = F.when(F.col("_open"), F.struct(F.col("_key").alias("case")))
    rows = ordered.over(rows, [run], {"visit": ("sum", F.col("_open").cast("long")), "next_ts": ("next", F.col(ts)), "_opened": ("last", opened)}).where("visit > 0")
    rows = rows.withColumn("case", F.col("_opened.case"))
    rows = ordered.stored(rows.withColumn("is_close", F.col("_close").eqNullSafe(F.col("case")) & ~F.col("_open")).drop("_open", "_close", "_key", "_opened"))
    rows = ordered.over(rows, [run, "visit"], {"_closed": ("before", F.when(F.col("is_close"), True))})
    return rows.where("_closed IS NULL").drop("_closed")


def _laid(df: DataFrame, run: str, ts: str, order: str) -> DataFrame:
    return ordered.stored(df) if "_part" in df.columns else ordered.laid(df, [run, "visit"], [ts, order])


def stage_seconds(df: DataFrame, run: str, ts: str, order: str, marker: Column, initial: str) -> DataFrame:
    """LOG2: adds stage and seconds: the time to the next line is charged to the stage in force after this line; 0 on
    the closing line and the run's last."""
    rows = ordered.over(_laid(df, run, ts, order), [run, "visit"], {"_stage": ("last", marker)})
    return rows.withColumns({"stage": F.coalesce("_stage", F.lit(initial)), "seconds": _charged(ts)}).drop("_stage")


def _charged(ts: str) -> Column:
    gap = F.greatest((F.unix_micros(F.col("next_ts").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 1e6, F.lit(0.0))
    return F.when(F.col("is_close") | F.col("next_ts").isNull(), 0.0).otherwise(gap)


def attempts(df: DataFrame, run: str, ts: str, order: str, markers: Column) -> DataFrame:
    """LOG3: rows (run, visit, doc) for each attempt that counts.  markers: array of states in the line's order, a
    family for an attempt and '' for a reset; an attempt counts when the state before isn't its family."""
    rows = ordered.over(_laid(df.withColumn("_states", F.array_compact(markers)), run, ts, order), [run, "visit"], {"_before": ("before", _last_state())})
    return _counted(rows, run)


def _last_state() -> Column:
    return F.get("_states", F.size("_states") - 1)


def _counted(rows: DataFrame, run: str) -> DataFrame:
    """Attempts of lines with their _states and the state _before each line: a look at the neighbour in the line's own array."""
    tried = F.transform("_states", lambda x, i: F.when((x != "") & ~x.eqNullSafe(F.when(i == 0, F.col("_before")).otherwise(F.get("_states", i - 1))), x))
    return rows.select(run, "visit", F.explode(F.array_compact(tried)).alias("doc"))


def summarize(lines: DataFrame, run: str = "run", ts: str = "ts", order: str = "line_no", top: int = 5) -> DataFrame:
    """LOG1-LOG5: one row a visit of (run, ts, line_no, message): times by stage, attempts and counters by family, the
    dominant stage and whether the visit is among the slowest."""
    # laid first: ranges are found by a sample, which would read every message's features once more
    laid = ordered.laid(lines.where(F.col(ts).isNotNull() & F.col("message").isNotNull()), [run], [ts, order])
    df = visits(ordered.stored(features(laid).drop("message")), run, ts, order, F.col("open_case").isNotNull(), F.col("open_case"), F.col("close_case"))
    mine = lambda kind: F.when(F.col(f"{kind}_case") == F.col("case"), F.col(f"{kind}_doc"))
    df = df.withColumns({"none_doc": mine("none"), "fail_doc": mine("fail"), "fall_doc": mine("fall")})
    search = lambda c: F.concat(F.lit("busca_"), F.lower(c))
    marker = F.coalesce(F.when(F.col("fall_line").isNotNull() | F.col("fall_doc").isNotNull(), F.lit("fallback_arvore")), *[search(F.col(c)) for c in ("fail_doc", "none_doc", "search", "filter_open", "click")])
    doc = F.coalesce(*[F.col(c) for c in ("fall_line", "fall_doc", "fail_doc", "none_doc", "search", "filter_open", "click")])
    reset = F.when(F.col("none_doc").isNotNull() | F.col("fail_doc").isNotNull() | F.col("fall_doc").isNotNull() | F.col("reload"), F.lit(""))
    df = _laid(df.withColumn("_states", F.array_compact(F.array(F.col("click"), F.col("filter_open"), F.col("search"), reset))), run, ts, order)
    df = ordered.stored(ordered.over(df, [run, "visit"], {"_stage": ("last", marker), "_doc": ("last", doc), "_before": ("before", _last_state())}))
    df = df.withColumns({"stage": F.coalesce("_stage", F.lit("abertura_processo")), "seconds": _charged(ts), "reload_of": F.when(F.col("reload"), F.coalesce(F.col("reload_doc"), F.col("_doc")))})
    tried = _counted(df, run).groupBy(run, "visit").agg(*[F.count_if(F.col("doc") == d).alias(f"{d.lower()}_attempts") for d in FAMILIES])
    per = df.groupBy(run, "visit").agg(
        F.first("case").alias("process_number"), F.min(ts).alias("started_at"), F.max(ts).alias("_last"), F.max(F.when(F.col("is_close"), F.col(ts))).alias("_closed"), F.max("next_ts").alias("_next"),
        *[F.round(F.sum(F.when(F.col("stage") == s, F.col("seconds")).otherwise(0.0)), 3).alias(f"{s}_seconds") for s in STAGES],
        *[F.count_if(F.col(c) == d).alias(f"{d.lower()}_{n}") for c, n in (("none_doc", "sem_resultado_filtro"), ("fail_doc", "falha_filtro"), ("fall_doc", "fallbacks"), ("reload_of", "reloads_contexto")) for d in FAMILIES],
        F.count_if("reload").alias("reloads_contexto_total"), F.count_if(F.col("fall_doc").isNotNull()).alias("fallbacks_total"),
    )
    per = per.withColumn("ended_at", F.coalesce("_closed", F.greatest("_last", "_next"))).drop("_last", "_closed", "_next")
    per = per.withColumn("total_seconds", F.round((F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6, 3))
    out = per.join(tried.withColumnsRenamed({run: "_r", "visit": "_v"}), (F.col(run) == F.col("_r")) & (F.col("visit") == F.col("_v")), "left").drop("_r", "_v").na.fill(0, [f"{d.lower()}_attempts" for d in FAMILIES])
    most = F.array_max(F.array(*[F.struct(F.col(f"{s}_seconds").alias("s"), F.lit(-i).alias("i"), F.lit(label).alias("label")) for i, (s, label) in enumerate(STAGES.items())]))
    out = out.withColumns({"dominant_stage": most["label"], "dominant_stage_seconds": most["s"]})
    best = out.orderBy(F.col("total_seconds").desc(), run, "visit").limit(top).select(F.col("process_number").alias("_p")).distinct()
    return out.join(F.broadcast(best), F.col("process_number") == F.col("_p"), "left").withColumn("top_5_slowest", F.when(F.col("_p").isNotNull(), "yes").otherwise("no")).drop("_p")
