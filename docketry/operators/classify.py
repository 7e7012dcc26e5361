"""Classification of captured documents and the gates before publication (inventory CLS)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, Weight, first_match, marker_score, term_score
from ..functions.text import HEADER, LEAD, OPENING, PROCESS, TAIL_MARKERS, clean_spaces, contains_any, fold, fold_upper, has_content, let, prepare_text, trim_noise, window

#: Classes with the type they resolve to, the snapshot prefix and the priority.
CLASSES = {
    "act_final": ("act", "acordo_cooperacao_tecnica", 100),
    "memorando": ("memorando_entendimentos", "memorando_entendimentos", 80),
    "ted": ("termo_execucao_descentralizada", "termo_execucao_descentralizada", 80),
    "extrato": ("act_relacionado", "acordo_cooperacao_tecnica", 30),
    "minuta": ("act_relacionado", "acordo_cooperacao_tecnica", 20),
    "termo_aditivo": ("act_relacionado", "acordo_cooperacao_tecnica", 20),
    "termo_adesao": ("act_relacionado", "acordo_cooperacao_tecnica", 20),
    "stub": ("act_relacionado", "acordo_cooperacao_tecnica", 10),
    "email_outro": ("act_relacionado", "acordo_cooperacao_tecnica", 0),
}
#: Header markers in the order of testing; the longest of two that overlap comes first.
HEADER_RULES = [
    Rule(("minuta",), "minuta", "cabecalho_minuta"),
    Rule(("extrato",), "extrato", "cabecalho_extrato"),
    Rule(("termo de adesao",), "termo_adesao", "cabecalho_termo_adesao"),
    Rule(("proposta de termo aditivo",), "termo_aditivo", "cabecalho_proposta_termo_aditivo"),
    Rule(("termo aditivo",), "termo_aditivo", "cabecalho_termo_aditivo"),
    Rule(("memorando de entendimentos",), "memorando", "cabecalho_memorando"),
    Rule(("termo de execucao descentralizada",), "ted", "cabecalho_ted"),
    Rule(("portaria",), "email_outro", "cabecalho_portaria"),
    Rule(("publicacao",), "email_outro", "cabecalho_publicacao"),
    Rule(("e-mail", "email"), "email_outro", "cabecalho_email"),
    Rule(("plano de trabalho",), "email_outro", "cabecalho_plano_trabalho"),
    Rule(("reuniao",), "email_outro", "cabecalho_reuniao"),
    Rule(("convenio",), "email_outro", "cabecalho_convenio"),
]
#: Phrases of the portal's own pages, mail headers, agreements, contracts and reports.
SEARCH_PAGE = ("pesquisar no processo", "tipos de documentos disponiveis neste processo")
VIEWER_STUB = ("clique aqui para visualizar o conteudo deste documento",)
MAIL_HEADERS = ("assunto:", "para:", "de:", "enviado:", "enviada:", "cc:", "cco:")
AGREEMENT, AGREEMENT_GENERIC = "acordo de cooperacao tecnica", "acordo de cooperacao"
CONTRACT = ("que entre si celebram", "resolvem celebrar", "uniao, representada", "participe 1", "participes", "clausula primeira")
FINAL_REPORT = ("relatorio final", "relatorio de encerramento", "relatorio conclusivo", "relatorio final de execucao")
REPORT = ("relatorio conjunto de execucao", "relatorio conjunto de atividades", "relatorio de execucao", "relatorio das atividades")
CLOSURE = ("apos o encerramento", "apos o termino", "ao termino da vigencia", "ao final da vigencia", "por ocasiao do encerramento", "encerramento da parceria", "encerramento do ajuste")
PERIODIC = ("mensal", "bimestral", "trimestral", "quadrimestral", "semestral", "anual")
PENALTIES = ("minuta", "publicacao", "extrato", "reuniao", "alterado", "plano de trabalho", " pt ")
STRONG_PENALTIES = ("portaria", "publicacao", "reuniao", "plano de trabalho", "termo aditivo", "termo de adesao")
#: Phrases that mark an agreement's wording besides CONTRACT, for its class only.
AGREEMENT_WORDING = ("objeto do presente acordo", "para os fins que especifica", "resolvem firmar", "doravante denominado", "doravante denominada")
#: Labels whose candidates are not opened.
SKIP = ("minuta", "minutas", "extrato", "email", "e-mail", "anexo", "termo aditivo", "proposta de termo aditivo", "termo de adesao", "documentacao", "planilha", "publicacao")
#: Tree labels that cost a candidate points: files and mail; then, for an agreement, its kin.
TREE_FILES = ("e-mail", "email", "correio eletronico", "planilha", "xls", "xlsx", "csv")
TREE_KIN = ("portaria", "publicacao", "reuniao", "termo aditivo", "termo de adesao", "plano de trabalho", "memorando", "termo de execucao descentralizada")
#: Beginnings of annotation labels.
METADATA_LABELS = ("GESTOR", "PORTARIA", "DOU", "DATA", "STATUS", "DESIGNACAO", "VENCIMENTO", "TERMO ADITIVO", "PARCEIRO", "PARCEIROS", "VIGENCIA", "NUMERO", "NUMERO ACT", "OBJETO", "VALOR", "TIPO", "PROCESSO")
#: Institutions whose mention makes an agreement the publisher's own; a deployment sets its own list.
INTERNAL = ("ministerio da defesa",)
ACCEPTED = {"act": ("act_final",), "memorando": ("memorando",), "ted": ("ted",)}
#: Characters of a work plan in which a draft names itself.
PLAN_HEAD = 1600
#: Characters of a long text that are prepared for its opening, and those beyond an opening that no cut of the text changes.
READ, EDGE = 3 * OPENING // 2, 100
#: A footer's marker in any case, tried only at its first letter: on long texts this costs less than their lower case.
TAIL_FOUND = rf"[{''.join(sorted({m[0] + m[0].upper() for m in TAIL_MARKERS}))}](?:{'|'.join(rf'(?<=[{m[0] + m[0].upper()}])(?i:{m[1:]})' for m in TAIL_MARKERS)})"
CASE_NUMBER = r"[0-9]{5}\.[0-9]{6}/[0-9]{4}-[0-9]{2}"


def _joined(part: Column) -> Column:
    return F.concat_ws(" ", F.nullif("_title", F.lit("")), F.nullif(part, F.lit("")), F.nullif("_chosen", F.lit("")))


def blobs(df: DataFrame, text: str = "text", title: str = "title", label: str = "chosen") -> DataFrame:
    """Folded texts that the rules read, once each as columns: rejection, header, opening and full, which hold the title and
    the label as well, and body_opening, which does not."""
    text = F.coalesce(text, F.lit(""))
    long = F.length(text) > READ
    told = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "").otherwise(fold(prepare_text(F.col(c))))
    df = df.withColumns({"_head": prepare_text(F.substring(text, 1, READ)), "_title": told(title), "_chosen": told(label)})
    # a long text's beginning is the body's if it reaches beyond the opening and no footer begins there
    sure = long & (F.length("_head") >= OPENING + EDGE) & ~F.substring("_head", 1, OPENING + EDGE).rlike(TAIL_FOUND)
    body = trim_noise(F.when(long, prepare_text(text)).otherwise(F.col("_head")))
    df = df.withColumn("_body", body)
    df = df.withColumn("body_opening", fold(window(F.when(sure, F.col("_head")).otherwise(F.col("_body")), OPENING))).drop("_head")
    joined = _joined
    first = lambda n: F.when(F.length("_body") <= n, F.col("body_opening")).otherwise(fold(window(F.col("_body"), n)))
    df = df.withColumns({"rejection": joined(first(LEAD)), "header": joined(first(HEADER)), "opening": joined(F.col("body_opening")), "folded": F.when(F.length("_body") <= OPENING, F.col("body_opening")).otherwise(fold(F.col("_body")))})
    return df.withColumn("full", F.concat_ws(" ", "header", "folded"))


def packed(df: DataFrame) -> DataFrame:
    """Rows of blobs() to be stored: without what others give, and null where a column repeats another, as short texts' do."""
    same = {"_body": "text", "folded": "body_opening", "header": _joined(F.col("body_opening")), "rejection": F.col("header")}
    return df.withColumns({c: F.nullif(F.col(c), F.col(x) if isinstance(x, str) else x) for c, x in same.items()}).drop("opening", "full")


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """What packed() has left out or made null, put back; in the order of columns."""
    df = df.withColumns({"opening": _joined(F.col("body_opening")), "_body": F.coalesce("_body", "text"), "folded": F.coalesce("folded", "body_opening")})
    df = df.withColumn("header", F.coalesce("header", "opening"))
    df = df.withColumns({"rejection": F.coalesce("rejection", "header"), "full": F.concat_ws(" ", "header", "folded")})
    return df.select(*columns)


def mail_hits(full: Column) -> Column:
    """Mail headers found; `de:` and the like count only as words of their own."""
    out = F.lit(0)
    for m in MAIL_HEADERS:
        out = out + F.when(F.contains(full, F.lit(m)), full.rlike(rf"(?:^|[^a-z]){m}").cast("int")).otherwise(0)
    return out


def classify(df: DataFrame) -> DataFrame:
    """CLS1: adds doc_class, classification_reason, resolved_document_type, snapshot_prefix, classification_priority
    to rows with the columns of blobs()."""
    answer = lambda a, b: F.struct(F.lit(a).alias("label"), F.lit(b).alias("reason"))
    act = contains_any(F.col("opening"), (*CONTRACT, *AGREEMENT_WORDING))
    found = (
        F.when(F.col("opening") == "", answer("email_outro", "snapshot_vazio"))
        .when(contains_any(F.col("opening"), SEARCH_PAGE), answer("stub", "pagina_de_pesquisa"))
        .when(contains_any(F.col("opening"), VIEWER_STUB), answer("stub", "stub_visualizacao"))
        .when((F.contains("full", F.lit(":")) & (mail_hits(F.col("full")) >= 3)) | contains_any(F.col("rejection"), ("e-mail", "email")), answer("email_outro", "email_ou_mensagem"))
        .when(contains_any(F.col("rejection"), [m for r in HEADER_RULES for m in r.any_of]), first_match(F.col("rejection"), HEADER_RULES))
        .when(F.contains("header", F.lit(AGREEMENT)) & act, answer("act_final", "cabecalho_act_tecnica_contratual"))
        .when(F.contains("header", F.lit(AGREEMENT_GENERIC)) & act, answer("act_final", "cabecalho_act_generico_contratual"))
        .otherwise(answer("email_outro", "conteudo_nao_classificado"))
    )
    df = df.withColumn("_found", found)
    known = F.create_map(*[x for k, (a, b, c) in CLASSES.items() for x in (F.lit(k), F.struct(F.lit(a).alias("type"), F.lit(b).alias("prefix"), F.lit(c).alias("priority")))])
    row = F.try_element_at(known, F.col("_found.label"))
    return df.withColumns({"doc_class": F.col("_found.label"), "classification_reason": F.col("_found.reason"), "resolved_document_type": row["type"], "snapshot_prefix": row["prefix"], "classification_priority": row["priority"]}).drop("_found")


def document_processes(title: Column, text: Column) -> Column:
    """CLS4: distinct case numbers of the title and the first 12,000 characters, in order."""
    return F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", title, F.substring(text, 1, PROCESS)), F.lit(CASE_NUMBER), F.lit(0)))


def alignment(found: Column, process: Column, internal: Column) -> Column:
    """CLS3: unknown (the text or the case has no number), aligned, external_reference (the publisher's own context is
    there) or material_mismatch."""
    process = F.coalesce(clean_spaces(process), F.lit(""))
    return F.when((F.size(found) == 0) | (process == ""), "unknown").when(F.array_contains(found, process), "aligned").when(internal, "external_reference").otherwise("material_mismatch")


def gate(df: DataFrame, internal: tuple[str, ...] = INTERNAL) -> DataFrame:
    """CLS2: canonical if the class fits requested_type; an agreement also needs an internal institution in its title, label
    or opening, and no material mismatch.  Adds validation_status, publication_status, discard_reason and what they
    rest on; a refused agreement's reason is also its classification_reason.  Only agreements that were asked for as
    such have a context, case numbers and an alignment."""
    asked = (F.col("requested_type") == "act") & (F.col("doc_class") == "act_final")
    asked = F.coalesce(asked, F.lit(False))
    none = F.array().cast("array<string>")
    df = df.withColumns({"has_internal": asked & contains_any(F.col("opening"), internal), "processes": F.when(asked, document_processes(F.col("_title"), F.col("_body"))).otherwise(none)})
    df = df.withColumn("process_alignment", alignment(F.col("processes"), F.col("processo"), F.col("has_internal")))
    accepted = F.lit(False)
    for kind, classes in ACCEPTED.items():
        accepted = accepted | ((F.col("requested_type") == kind) & F.col("doc_class").isin(*classes))
    refused = F.when(asked & ~F.col("has_internal"), "act_sem_marcador_interno").when(asked & (F.col("process_alignment") == "material_mismatch"), "processo_divergente_documento")
    canonical = F.coalesce(accepted, F.lit(False)) & refused.isNull()
    reason = F.when(canonical, "").otherwise(F.coalesce(refused, F.col("doc_class")))
    status = F.when(F.col("doc_class").isin("stub", "email_outro"), "rejected_snapshot").when(canonical, "valid_for_requested_type").otherwise("related_but_not_requested")
    # the number that the record shows: the case's own if the document has it, else the document's first
    number = F.when(F.col("process_alignment") == "aligned", clean_spaces("processo")).when(F.col("process_alignment") != "unknown", F.get("processes", F.lit(0))).otherwise("")
    return df.withColumns({
        "is_canonical": canonical, "validation_status": status, "publication_status": F.when(canonical, "published_gold").otherwise("retained_silver"), "discard_reason": reason,
        "classification_reason": F.coalesce(refused, F.col("classification_reason")), "document_processo": number,
    })


def plan_draft(title: Column, chosen: Column, text: Column) -> Column:
    """CLS5: a work plan's draft: `minuta [de] plano de trabalho` in its first 1600 characters, or
    documentation and draft both named in its title or label.  A label's `minuta` alone is none."""
    head, named = fold(F.substring(F.coalesce(text, F.lit("")), 1, PLAN_HEAD)), fold(F.concat_ws(" ", chosen, title))
    plan = F.contains(head, F.lit("plano de trabalho")) | F.contains(named, F.lit("plano de trabalho"))
    both = F.contains(named, F.lit("documentacao")) & F.contains(named, F.lit("minuta"))
    return plan & (head.rlike(r"\bminuta(?:\s+de)?\s+plano\s+de\s+trabalho\b") | both)


def reject_reason(text: Column, family: Column) -> Column:
    """CLS6: why a snapshot is no document of its family; null if it is one."""
    f = fold(F.coalesce(text, F.lit("")))
    return F.when(f == "", "snapshot_vazio").when(contains_any(F.substring(f, 1, OPENING), SEARCH_PAGE), "pagina_de_pesquisa").when((family == "pt") & ~F.contains(f, F.lit("plano de trabalho")), "pt_sem_expressao")


def split_rejected(df: DataFrame, text: str = "text", family: str = "requested_type") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with reject_reason."""
    df = df.withColumn("reject_reason", reject_reason(F.col(text), F.col(family)))
    return df.where("reject_reason IS NULL").drop("reject_reason"), df.where("reject_reason IS NOT NULL")


def same_description(c: Column, profile: str) -> Column:
    """CLS7: the folded description is the profile's."""
    return fold(c) == fold(F.lit(profile))


def skipped(label: Column, markers: tuple[str, ...] = SKIP) -> Column:
    """CLS8: a candidate's label says that it needs no opening."""
    return contains_any(fold(label), markers)


def tree_score(label: Column, terms: list[str], family: str) -> Column:
    """CLS9: the score of a tree label for a family; null where no term occurs or nothing is left, which drops it.

    Files and mail cost 200 once; for an agreement each of PENALTIES costs 120, `anexo` 40, each of TREE_KIN 180; for a work
    plan `documentacao` costs 20 and `minuta` 25 (both sides are folded, so these do count)."""
    weights = [Weight(TREE_FILES, -200)]
    if family == "act":
        weights += [Weight(("anexo",), -40), Weight(PENALTIES, -120, each=True), Weight(TREE_KIN, -180, each=True)]
    if family == "pt":
        weights += [Weight(("documentacao",), -20), Weight(("minuta",), -25)]
    score = term_score(label, terms, weights)
    found = contains_any(fold(label), [t for t in terms if t])
    return F.when(found & (score > 0), score)


def canonical_score(df: DataFrame) -> Column:
    """CLS10, over the columns of blobs(), classify() and gate() and the extracted number, object and party.

    The opening is the body's own: a title or label that names an agreement has its own points."""
    label, opening = F.concat_ws(" ", "_title", "_chosen"), F.col("body_opening")
    has = lambda c, m: F.contains(c, F.lit(m))
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    score = (
        F.when(has(opening, AGREEMENT), 140).when(has(opening, AGREEMENT_GENERIC), 100).otherwise(0)
        + F.when(has(label, AGREEMENT), 60).when(has(label, AGREEMENT_GENERIC), 30).otherwise(0)
        + marker_score(opening, [Weight(CONTRACT, 60), Weight(("para os fins que especifica",), 20)])
        + F.when(has(opening, "assinado") | has(label, "assinado"), 10).otherwise(0)
        + F.when(filled("numero_acordo"), 20).otherwise(0) + F.when(filled("objeto"), 10).otherwise(0) + F.when(filled("orgao_convenente"), 10).otherwise(0)
        + F.when(F.col("validation_status") != "valid_for_requested_type", -500).otherwise(0) + F.when(F.col("has_internal"), 0).otherwise(-400)
        + F.when(F.col("process_alignment") == "material_mismatch", -400).when(F.col("process_alignment") == "external_reference", -25).otherwise(0)
        + marker_score(label, [Weight(("anexo",), -20), Weight(PENALTIES, -80, each=True)])
        + let(F.concat_ws(" ", opening, label), lambda x: marker_score(x, [Weight(STRONG_PENALTIES, -180, each=True)]))
        + F.least(F.floor(F.length("text") / 5000), F.lit(10)).cast("int")
    )
    return F.when(F.col("doc_class") == "act_final", score).otherwise(-1000)


def closing_report(folded: Column) -> Column:
    """CLS11: a final report, or a report at the end of the partnership that isn't periodic."""
    # every report's marker begins alike
    return F.contains(folded, F.lit("relatorio")) & (contains_any(folded, FINAL_REPORT) | (contains_any(folded, REPORT) & contains_any(folded, CLOSURE) & ~contains_any(folded, PERIODIC)))


def plan_status(partner: Column, subject: Column, start: Column, end: Column, goals: Column, actions: Column) -> Column:
    """CLS12: struct (status, captured): completo_padronizado, parcial_padronizado or extraido_sem_padrao, and how many of six
    fields are there.  Texts count from 8 letters (a partner from 4), a period only if it ends no earlier than it begins."""
    p, o = has_content(partner, 4), has_content(subject)
    g, a = has_content(goals), has_content(actions)
    period = F.coalesce(end >= start, F.lit(False))
    n = sum((x.cast("int") for x in (o, start.isNotNull(), end.isNotNull(), g, a)), p.cast("int"))
    status = F.when(p & o & period & (g | a), "completo_padronizado").when(o & (p.cast("int") + period.cast("int") + (g | a).cast("int") >= 2), "parcial_padronizado").otherwise("extraido_sem_padrao")
    return F.struct(status.alias("status"), n.alias("captured"))


def outcome_status(reason: Column, error: Column, status: Column) -> Column:
    """CLS13: the status of a search without a document."""
    return F.coalesce(F.nullif(status, F.lit("")), F.when(reason == "stagnated", "stagnated").when(reason.isin("open_error", "filter_error", "reopen_error") | (F.coalesce(error, F.lit("")) != ""), "filter_error").otherwise("not_found"))


#: Up to so many profiles become one CASE; more are joined.
MOST_PROFILES = 200
#: Characters of the piece by which a text and a pattern meet.
PIECE = 4


def profile_of(df: DataFrame, profiles: DataFrame, text: str = "descricao") -> DataFrame:
    """CLS14: adds `profile`, the first enabled profile (ordinal, key, pattern, enabled) that the folded text holds; of
    profiles with one ordinal the smaller key.  A profile with an empty pattern fits every text, a null one none.

    A few profiles become one CASE without a join; tables of any size are joined with holds()."""
    on = profiles.where("enabled AND pattern IS NOT NULL").select("ordinal", "key", fold(F.col("pattern")).alias("pattern"))
    on = on.groupBy("pattern").agg(F.min(F.struct("ordinal", "key")).alias("b")).select("b.ordinal", "b.key", "pattern")  # the others never win
    rows = on.orderBy("ordinal", "key").limit(MOST_PROFILES + 1).collect()
    if len(rows) <= MOST_PROFILES:
        out = F.lit(None).cast("string")
        for r in reversed(rows):
            out = F.when(F.contains("_folded", F.lit(r["pattern"])), r["key"]).otherwise(out)
        return df.withColumn("_folded", fold(F.col(text))).withColumn("profile", out).drop("_folded")
    # texts are told apart by their folded form, so equal ones are looked up once
    texts = df.select(fold(F.col(text)).alias("folded")).where("folded IS NOT NULL").distinct()
    best = holds(texts, "folded", on, "pattern").groupBy("folded").agg(F.min(F.struct("ordinal", "key")).alias("b"))
    best = best.select(F.col("folded").alias("_f"), F.col("b.key").alias("profile"))
    return df.withColumn("_folded", fold(F.col(text))).join(best, F.col("_folded") == F.col("_f"), "left").drop("_folded", "_f")


def holds(texts: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """Rows of texts joined with the rows of patterns that they hold, for any number of patterns: an equi-join on pieces.

    Each pattern is looked for by one of its pieces of PIECE characters, the one that fewest patterns have, and a text
    by all of its own; where they meet, the whole pattern is tested.  Patterns shorter than a piece are told by their
    length: texts give their pieces of that length as well.  One pass over the texts; texts that are null hold nothing."""
    cut = lambda c, n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    rows = patterns.withColumn("_pieces", F.array_distinct(cut(F.col(pattern), PIECE)))
    counts = rows.select(F.explode("_pieces").alias("_piece")).groupBy("_piece").count()
    # told apart by the pattern, which fixes its piece: a row's number would change where rows are computed again
    best = rows.select(F.col(pattern).alias("_r"), F.explode("_pieces").alias("_piece")).join(counts, "_piece").groupBy("_r").agg(F.min(F.struct("count", "_piece")).alias("_b"))
    keyed = rows.join(best.select("_r", F.col("_b._piece").alias("_piece")), F.col(pattern) == F.col("_r")).drop("_pieces", "_r")
    sizes = [r["n"] for r in keyed.select(F.length("_piece").alias("n")).distinct().collect()]  # PIECE + 1 at most
    own = F.concat(*[cut(F.col(text), n) for n in sizes if n > 0], F.array(F.lit("")))
    given = texts.withColumn("_own", F.explode(F.array_distinct(own)))
    return given.join(keyed, F.col("_own") == F.col("_piece")).where(F.contains(F.col(text), F.col(pattern))).drop("_own", "_piece")


def family_list(c: Column, known: tuple[str, ...] = ("pt", "act", "memorando", "ted"), default: str = "pt") -> Column:
    """CLS15: distinct known families of a comma list, in order; the default if none is left."""
    found = F.array_distinct(F.filter(F.transform(F.split(F.lower(F.coalesce(c, F.lit(""))), ","), lambda x: F.trim(x)), lambda x: x.isin(*known)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def valid_description(c: Column, number: Column) -> Column:
    """CLS16: four characters or more, not the row's number, no status word."""
    f = fold(c)
    return (F.length(f) >= 4) & ~F.coalesce(F.regexp_replace(f, "[^0-9a-z]", "") == F.regexp_replace(fold(number), "[^0-9a-z]", ""), F.lit(False)) & ~f.isin("aberto", "fechado", "gerado", "recebido", "disponibilizado", "retornado", "concluido")


def first_description(cells: Column, number: Column) -> Column:
    return F.get(F.filter(cells, lambda x: valid_description(x, number)), F.lit(0))


def metadata_label(label: Column) -> Column:
    """CLS17 of a label that is folded to upper case."""
    known = F.lit(False)
    for prefix in METADATA_LABELS:
        known = known | F.startswith(label, F.lit(prefix))
    return (label != "") & (known | ((F.size(F.split(label, " ")) <= 4) & label.rlike(r"^[A-Z0-9 /().-]+$")))


def is_metadata_label(c: Column) -> Column:
    """CLS17: begins as a known label, or is up to four words of plain letters and digits; case and accents don't count."""
    return metadata_label(fold_upper(c))


def plan_quality(publication: Column, path: Column) -> Column:
    """CLS18 for work plans."""
    return F.when(publication == "published_gold", "gold").when(F.coalesce(path, F.lit("")) != "", "silver_only").otherwise("not_found")


def agreement_quality(publication: Column, fields: list[Column], attempts: Column) -> Column:
    whole = F.lit(True)
    for f in fields:
        whole = whole & (F.trim(F.coalesce(f.cast("string"), F.lit(""))) != "")
    return F.when((publication == "published_gold") & whole, "gold_complete").when(publication == "published_gold", "gold_partial").when(F.coalesce(attempts, F.lit(0)) > 0, "silver_only").otherwise("not_found")


def overall_quality(agreement: Column, mismatch: Column, any_gold: Column) -> Column:
    return F.when((agreement == "gold_complete") & ~mismatch, "high").when(any_gold, "medium").otherwise("low")


def has_mismatch(warning: Column) -> Column:
    """CLS19."""
    return F.coalesce(F.contains(warning, F.lit("processo_divergente")) | F.contains(warning, F.lit("material_mismatch")), F.lit(False))


def warnings(*parts: Column) -> Column:
    """CLS20: the warnings that are there, in order, joined by `; `."""
    return F.concat_ws("; ", *[F.nullif(p, F.lit("")) for p in parts])


def family_of(c: Column) -> Column:
    """CLS21: the family that a free text speaks of."""
    f = fold(c)
    return F.when(F.contains(f, F.lit("plano de trabalho")), "PT").when(F.contains(f, F.lit("memorando")), "MEMORANDO").when(F.contains(f, F.lit("execucao descentralizada")) | F.startswith(f, F.lit("ted")), "TED").when(F.contains(f, F.lit("acordo de cooperacao")) | F.contains(f, F.lit("act")), "ACT")


def api_analysis(df: DataFrame) -> DataFrame:
    """CLS22: rows from the API are final."""
    return df.withColumns({"doc_class": F.lit("ted"), "resolved_document_type": F.lit("termo_execucao_descentralizada"), "classification_reason": F.lit("api"), "validation_status": F.lit("valid_for_requested_type"), "publication_status": F.lit("published_gold"), "is_canonical": F.lit(True)})
