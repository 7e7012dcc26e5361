"""Registered queries of whole records, labels, layers and marts, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import _FOLD, case_number, cents, spread, t
from .functions import dates as D
from .functions import text as X
from .operators import classify as C
from .operators import dash, ordered, records, runlog, select
from .operators import extract as E
from .sources import tables as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def lit(x: str):
    return F.lit(x)


def day(c: str = "o_orderdate"):
    return F.date_format(c, "dd/MM/yyyy")


# --- text -------------------------------------------------------------------------------------------------------
@query("SELECT o_orderkey, 'Ação ' || o_orderkey AS a, ['obj ' || o_custkey, 'relação ' || o_custkey, '2020 – 2021', 'sem marca', NULL] AS b FROM orders")
def repair_payload(spark, d):
    """TXT3: every text of a nested value: order keys with letters encoded twice, once and thrice, in a struct with a list."""
    o = spread(spark, d, "orders")
    who = F.col("o_custkey").cast("string")
    wrong = lambda x: F.decode(F.encode(x, "UTF-8"), "ISO-8859-1")
    texts = F.array(F.concat(lit("obj "), who), wrong(wrong(F.concat(lit("relação "), who))), lit("2020 – 2021".encode().decode("cp1252")), lit("sem marca"), lit(None).cast("string"))
    value = F.struct(F.concat(lit("AÃ§Ã£o "), "o_orderkey").alias("a"), texts.alias("b"))
    df = o.select("o_orderkey", value.alias("v"))
    df = df.select("o_orderkey", X.repair_payload(F.col("v"), df.schema["v"].dataType).alias("v"))
    return df.select("o_orderkey", "v.a", "v.b")


@query("""SELECT o_orderkey, 'fim da Clausula ' || o_orderkey || ' em 2020' AS prepared, 'Meta 1 e Fase 2 de ' || o_custkey AS plan FROM orders""")
def prepared_texts(spark, d):
    """TXT4, TXT5: ligatures, glued words and goals stuck to numbers."""
    o = spread(spark, d, "orders").select("o_orderkey", F.concat(lit("ﬁm daClausula "), "o_orderkey", lit("\u00a0 em2020")).alias("x"), F.concat(lit("Meta1 e Fase2 de "), "o_custkey").alias("y"))
    return o.select("o_orderkey", X.prepare_text(F.col("x")).alias("prepared"), X.prepare_plan_text(F.col("y")).alias("plan"))


@query(f"""SELECT doc_id, upper(replace({_FOLD('text')}, 'ß', 'ss')) AS folded, length(regexp_replace(text, '[^A-Za-zÀ-ÿ]', '', 'g')) >= 8 AS content, doc_id % 5 = 0 AS placeholder FROM documents""")
def content_flags(spark, d):
    """TXT7, TXT9, TXT15 of whole texts; each fifth is shown as the viewer's placeholder."""
    return t(spark, d, "documents").select("doc_id", X.fold_upper(F.col("text")).alias("folded"), X.has_content(F.col("text")).alias("content"), X.is_placeholder(F.when(F.col("doc_id") % 5 == 0, F.concat(lit("Clique aqui para visualizar o conteúdo deste documento "), F.substring("text", 1, 20))).otherwise(F.col("text"))).alias("placeholder"))


@query("""SELECT o_orderkey, 'corpo ' || o_orderkey || '.' AS body, 'de ' || strftime(o_orderdate, '%d/%m/%Y') || ' em diante' AS period FROM orders""")
def footers_and_periods(spark, d):
    """TXT8, TXT11: footers go, and addresses, print times and page marks inside a period."""
    o = spread(spark, d, "orders")
    body = F.concat(lit("corpo "), "o_orderkey", lit(". Documento assinado eletronicamente por A. Criado por B"))
    period = F.concat(lit("de "), day(), lit(" https://x.org/a?b=1 pag. 3/9 em diante"))
    return o.select("o_orderkey", X.trim_noise(body, first_only=False).alias("body"), X.clean_period(period).alias("period"))


@query("""SELECT o_orderkey, lpad(o_custkey::VARCHAR, 5, '0') || '000001202101' AS digits, 2021 AS year, '12/' || o_orderkey AS number, 'r' || o_orderkey AS cell, o_custkey::VARCHAR AS seq FROM orders""")
def case_cells(spark, d):
    """TXT17-TXT20: digits and year of a case number, a bare agreement number, the sequence and the annotation of a row."""
    o = spread(spark, d, "orders").select("o_orderkey", case_number(F.col("o_custkey")).alias("case"), F.col("o_custkey").cast("string").alias("n"), F.col("o_orderkey").cast("string").alias("k"))
    cells = F.array(F.col("case"), F.col("n"), F.col("k"), F.concat(lit("Parceiro: r"), "k"))
    parts = X.process_parts(F.col("case"))
    return o.select("o_orderkey", parts["digits"].alias("digits"), parts["year"].alias("year"), X.agreement_number(F.concat(lit(" Nº 12/"), "k", lit(". "))).alias("number"), F.replace(X.annotation_cell(cells), lit("Parceiro: "), lit("")).alias("cell"), X.sequence_cell(cells, F.col("case")).alias("seq"))


# --- dates ------------------------------------------------------------------------------------------------------
@query("SELECT o_orderkey, o_orderdate::DATE AS plain, NULL::DATE AS looks_alike, strftime(o_orderdate, '%Y-%m-%d') AS shown, strftime(o_orderdate, '%Y-%m-%d') || '..' AS label FROM orders")
def plain_dates(spark, d):
    """DAT4 (look-alike digits stay unread), DAT17, DAT20."""
    o = spread(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("x"))
    written = F.date_format("x", "dd/MM/yyyy")
    return o.select("o_orderkey", D.parse_plan_date(written, ocr=False).alias("plain"), D.parse_plan_date(F.translate(written, "0129", "oizg"), ocr=False).alias("looks_alike"), D.show_date(F.col("x")).alias("shown"), D.period_label(F.col("x"), lit(None).cast("date")).alias("label"))


@query("""SELECT o_orderkey, o_orderdate::DATE AS a, (o_orderdate::DATE + to_months(24))::DATE AS b, o_orderdate::DATE AS published, CASE WHEN o_orderkey % 2 = 0 THEN 'found' ELSE 'partial' END AS status, o_orderdate::DATE AS first FROM orders""")
def stated_periods(spark, d):
    """DAT9-DAT11: `de X a Y`, the date after a marker, and labelled periods with and without an end."""
    o = spread(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("x"), F.add_months(F.to_date("o_orderdate"), 24).alias("y"))
    show = lambda c: F.date_format(c, "dd/MM/yyyy")
    p = D.explicit_period(F.concat(lit("vigora de "), show("x"), lit(" a "), show("y"), lit(".")))
    q = D.label_period(F.concat(lit("Inicio: "), show("x"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(lit(" Término: "), show("y"))).otherwise("")))
    return o.select("o_orderkey", p["start"].alias("a"), p["end"].alias("b"), D.date_after(F.concat(lit("a partir da publicação no diário de "), show("x")), "publicação").alias("published"), q["status"].alias("status"), q["start"].alias("first"))


@query("""SELECT o_orderkey, o_orderkey % 8 = 0 AS noise, o_orderkey % 8 IN (1, 4, 5, 6) AS relative, (o_custkey % 10 + 1)::INT AS n FROM orders""")
def period_words(spark, d):
    """DAT14-DAT16: placeholders, wordings that hang on the signature and some that don't, number words."""
    k = F.col("o_orderkey") % 8
    text = _of({0: "inserir previsão", 1: "imediatamente após a assinatura", 2: "assinatura do presente", 3: "a contar da publicação", 4: "na data da assinatura", 5: "Na data de sua assinatura", 6: "a partir da assinatura"}, k)
    text = F.coalesce(text, day())
    word = F.element_at(F.array(*[lit(w) for w in ("um", "dois", "Três", "quatro", "cinco", "seis", "sete", "oito", "nove", "dez")]), (F.col("o_custkey") % 10 + 1).cast("int"))
    return spread(spark, d, "orders").select("o_orderkey", D.is_period_noise(text).alias("noise"), D.is_relative(text).alias("relative"), D.number_word(word).alias("n"))


_PLAN_CASES = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (4, 10) THEN NULL ELSE o_orderdate::DATE END AS start_date,
    CASE WHEN o_orderkey % 11 IN (0, 8) THEN (o_orderdate::DATE + to_months(24))::DATE WHEN o_orderkey % 11 = 1 THEN (o_orderdate::DATE + to_months(6))::DATE WHEN o_orderkey % 11 = 2 THEN (o_orderdate::DATE + to_months(36))::DATE
      WHEN o_orderkey % 11 IN (3, 5, 6, 7, 9) THEN (o_orderdate::DATE + to_months(12))::DATE END AS end_date,
    CASE WHEN o_orderkey % 11 IN (3, 5, 6, 7, 9) THEN 'direct_label' WHEN o_orderkey % 11 = 4 THEN 'unresolved_relative' WHEN o_orderkey % 11 = 10 THEN 'missing_period' ELSE 'derived_from_signature' END AS source FROM orders"""


@query(_PLAN_CASES)
def plan_periods(spark, d):
    """DAT8, DAT13: terms in words and digits from a signature or a dated seat; labelled pairs of dates; captured labels, with
    and without dates already parsed, beside stray pairs of dates that are no period; and relative wording alone."""
    k = F.col("o_orderkey") % 11
    months = lit("|".join(D.MONTHS))
    worded = F.concat(F.dayofmonth("o_orderdate").cast("string"), lit(" de "), F.element_at(F.split(months, r"\|"), F.month("o_orderdate")), lit(" de "), F.year("o_orderdate").cast("string"))
    a, b = day(), F.date_format(F.add_months("o_orderdate", 12), "dd/MM/yyyy")
    text = (
        F.when(k == 0, F.concat(lit("vigorará pelo prazo de dois anos, a partir da data de sua assinatura. Assinado por A em "), a))
        .when(k == 1, F.concat(lit("prazo de 6 (seis) meses após a assinatura. Brasília, "), worded))
        .when(k == 2, F.concat(lit("Início: imediatamente após a assinatura. Fim: 36 meses após a assinatura. Brasília, "), a))
        .when(k == 4, lit("terá início a partir da assinatura")).when(k == 5, lit("Visitas feitas de 01/01/2010 a 31/12/2010"))
        .when(k == 6, F.concat(lit("feitas de 01/01/2010 a 31/12/2010. Período de execução: "), a, lit(" a "), b)).when(k == 7, F.concat(lit("Início (mês/ano): "), a, lit(" Término (mês/ano): "), b))
        .when(k == 8, F.concat(lit("Brasília, "), worded)).when(k == 10, lit("O prazo de prestação de contas venceu em 05/05/2015 e 06/06/2016")).otherwise("metas")
    )
    start, end = F.when(k.isin(3, 5), a).when(k == 8, lit("na data da assinatura")), F.when(k.isin(3, 5), b).when(k == 8, lit("24 meses"))
    given = F.when(k == 9, F.col("o_orderdate").cast("date").cast("string")), F.when(k == 9, F.add_months("o_orderdate", 12).cast("string"))
    o = spread(spark, d, "orders").select("o_orderkey", text.alias("x"), start.alias("s"), end.alias("e"), given[0].alias("sd"), given[1].alias("ed"))
    o = o.withColumn("folded", X.fold(F.col("x")))
    o = D.staged(o, D.plan_period_parts(F.col("x"), F.col("s"), F.col("e"), F.col("sd"), F.col("ed"), F.col("folded")), "p", D.plan_period_ladder)
    return o.select("o_orderkey", F.col("p.start").alias("start_date"), F.col("p.end").alias("end_date"), "p.source")


# --- classes ----------------------------------------------------------------------------------------------------
_CLASS_TEXTS = {
    0: ("Acordo de Cooperação Técnica 1. As partes resolvem firmar o presente", "act_final", "cabecalho_act_tecnica_contratual"),
    1: ("Acordo de Cooperação 2, doravante denominado Acordo", "act_final", "cabecalho_act_generico_contratual"),
    2: ("Portaria de designação", "email_outro", "cabecalho_portaria"),
    3: ("Termo de Execução Descentralizada", "ted", "cabecalho_ted"),
    4: ("Proposta de termo aditivo ao acordo", "termo_aditivo", "cabecalho_proposta_termo_aditivo"),
    5: ("Acordo de Cooperação Técnica sem mais", "email_outro", "conteudo_nao_classificado"),
    6: ("Constitui objeto do presente acordo de cooperação o apoio", "act_final", "cabecalho_act_generico_contratual"),
}


def _of(values: dict, c):
    out = lit(None).cast("string")
    for k, v in values.items():
        out = F.when(c == k, lit(v)).otherwise(out)
    return out


@query("SELECT o_orderkey, CASE o_orderkey % 7 " + " ".join(f"WHEN {k} THEN '{b}'" for k, (_, b, _) in _CLASS_TEXTS.items()) + " END AS doc_class, CASE o_orderkey % 7 " + " ".join(f"WHEN {k} THEN '{c}'" for k, (_, _, c) in _CLASS_TEXTS.items()) + " END AS reason FROM orders")
def classify_wordings(spark, d):
    """CLS1: each class's wordings, the agreements' own ones among them."""
    o = spread(spark, d, "orders").select("o_orderkey", _of({k: v[0] for k, v in _CLASS_TEXTS.items()}, F.col("o_orderkey") % 7).alias("text"), lit("").alias("title"), lit("").alias("chosen"))
    return C.classify(C.blobs(o)).select("o_orderkey", "doc_class", F.col("classification_reason").alias("reason"))


@query("""SELECT o_orderkey, (CASE o_orderkey % 4 WHEN 0 THEN 100 WHEN 3 THEN 0 ELSE 140 END + CASE WHEN o_orderkey % 4 = 3 THEN 60 ELSE 60 + 20 END + 20 + 10 + 10 - CASE WHEN o_orderkey % 2 = 0 THEN 180 ELSE 0 END
    - CASE WHEN o_orderkey % 5 = 0 THEN 80 ELSE 0 END - CASE WHEN o_orderkey % 7 = 0 THEN 20 ELSE 0 END + least(o_custkey % 3 * 2, 10))::INTEGER AS score FROM orders""")
def canonical_scores(spark, d):
    """CLS10: an agreement's score by its body's opening, its title's and label's points and penalties, the strong ones, and
    the whole text's length.  A title that names the agreement doesn't stand in for a body that does not."""
    k = F.col("o_orderkey")
    named = F.when(k % 4 == 0, "Acordo de Cooperação ").when(k % 4 == 3, "Anexo único ").otherwise("Acordo de Cooperação Técnica ")
    opening = F.concat(named, F.when(k % 4 == 3, "de outra coisa").otherwise("que entre si celebram, para os fins que especifica"), F.when(k % 2 == 0, " conforme a portaria").otherwise(""))
    title = F.when(k % 4 == 3, "Acordo de Cooperação Técnica 1 que entre si celebram").otherwise("")
    o = spread(spark, d, "orders").select(
        "o_orderkey", F.concat(opening, F.repeat(lit("x "), (F.col("o_custkey") % 3 * 5_000 + 50).cast("int"))).alias("text"), title.alias("title"), F.concat_ws(" ", F.when(k % 5 == 0, "alterado"), F.when(k % 7 == 0, "anexo")).alias("chosen"),
        lit("act_final").alias("doc_class"), lit("valid_for_requested_type").alias("validation_status"), lit(True).alias("has_internal"), lit("aligned").alias("process_alignment"), lit("1/2020").alias("numero_acordo"), lit("o").alias("objeto"), lit("p").alias("orgao_convenente"),
    )
    o = C.blobs(o)
    return o.select("o_orderkey", C.canonical_score(o).alias("score"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN 'act_sem_marcador_interno' WHEN 3 THEN 'extrato' ELSE '' END AS discard_reason, CASE o_orderkey % 6 WHEN 1 THEN 'act_sem_marcador_interno' WHEN 3 THEN 'cabecalho_extrato' ELSE 'cabecalho_act_tecnica_contratual' END AS reason,
    CASE o_orderkey % 6 WHEN 0 THEN 'aligned' WHEN 1 THEN 'material_mismatch' WHEN 2 THEN 'external_reference' ELSE 'unknown' END AS alignment,
    CASE o_orderkey % 6 WHEN 0 THEN '11111.000001/2021-01' WHEN 1 THEN '22222.000002/2021-02' WHEN 2 THEN '22222.000002/2021-02' ELSE '' END AS number, o_orderkey % 6 NOT IN (1, 3) AS canonical FROM orders""")
def agreement_gates(spark, d):
    """CLS2-CLS4: the institution counts in the title, label and opening only; an empty or missing case number aligns with
    nothing; the number that is shown is the case's own if the document has it."""
    k = F.col("o_orderkey") % 6
    own, other = "11111.000001/2021-01", "22222.000002/2021-02"
    head = F.concat(lit("Acordo de Cooperação Técnica 1 que entre si celebram a Fundação "), F.col("o_custkey").cast("string"), F.when(k != 1, " e o Ministério da Defesa").otherwise(" e outra"))
    cited = F.when(k == 0, f" {other} {own}").when(k == 3, "").otherwise(f" {other}")
    far = F.when(k == 1, F.concat(F.repeat(lit("texto sem mais "), 400), lit(" Ministério da Defesa"))).otherwise("")
    case = F.when(k == 4, "").when(k == 5, lit(None).cast("string")).otherwise(own)
    o = spread(spark, d, "orders").select("o_orderkey", F.concat(head, cited, far).alias("text"), F.when(k == 3, "Extrato").otherwise("").alias("title"), lit("").alias("chosen"), case.alias("processo"), lit("act").alias("requested_type"))
    o = C.gate(C.classify(C.blobs(o)))
    return o.select("o_orderkey", "discard_reason", F.col("classification_reason").alias("reason"), F.col("process_alignment").alias("alignment"), F.col("document_processo").alias("number"), F.col("is_canonical").alias("canonical"))


_SKIPPED = "contains(l, 'anexo') OR contains(l, 'planilha') OR contains(l, 'termo aditivo') OR contains(l, 'email')"


@query(f"""SELECT kind, count(*) AS evaluated, count_if(s) AS skipped, round(100.0 * count_if(s) / count(*), 2)::DOUBLE AS skipped_pct FROM (SELECT l AS kind, {_SKIPPED} AS s FROM (SELECT ['anexo', 'oficio', 'despacho', 'planilha', 'termo aditivo', 'parecer', 'portaria', 'email'][o_orderkey % 8 + 1] AS l FROM orders)) GROUP BY 1""")
def skipped_labels(spark, d):
    """CLS8, AGG13: labels that are not opened, by the library's marks."""
    kinds = F.array(*[lit(x) for x in ("anexo", "oficio", "despacho", "planilha", "termo aditivo", "parecer", "portaria", "email")])
    o = t(spark, d, "orders").select(F.element_at(kinds, (F.col("o_orderkey") % 8 + 1).cast("int")).alias("kind"))
    return dash.screening(o, C.skipped(F.initcap("kind")), "kind")


@query("""WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 20 + 40 WHEN 1 THEN 20 + 40 - 40 WHEN 2 THEN 20 + 40 - 120 WHEN 3 THEN 0 END AS s FROM orders) SELECT o_orderkey, CASE WHEN s > 0 THEN s END::INTEGER AS score FROM s""")
def tree_scores(spark, d):
    """CLS9: a label's terms less what its family holds against it; nothing left is null."""
    label = _of({0: "Acordo de Cooperacao", 1: "Anexo ao Acordo de Cooperação", 2: "Minuta de Acordo de Cooperação", 3: "Portaria"}, F.col("o_orderkey") % 4)
    return spread(spark, d, "orders").select("o_orderkey", C.tree_score(label, ["acordo de cooperacao"], "act").alias("score"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 'a' WHEN contains(lower(p_name), 'small') THEN 'b' WHEN contains(lower(p_name), 'ring') THEN 'c' END AS profile, lower(p_name) = 'small red ring' AS same FROM part""")
def block_profiles(spark, d):
    """CLS7, CLS14: the first enabled profile that a description holds."""
    profiles = spark.createDataFrame([(2, "b", "SMALL", True), (1, "a", "Réd", True), (0, "off", "ring", False), (3, "c", "ring", True)], "ordinal int, key string, pattern string, enabled boolean")
    return C.profile_of(t(spark, d, "part").select("p_partkey", "p_name"), profiles, "p_name").select("p_partkey", "profile", C.same_description(F.col("p_name"), "small réd ring").alias("same"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ['act', 'ted'] ELSE ['pt'] END AS families, CASE WHEN o_orderkey % 2 = 0 THEN 'Bloco ' || o_custkey || ' de teste' END AS description FROM orders""")
def families_and_descriptions(spark, d):
    """CLS15, CLS16: known families of a list in order, and the first cell that is a description."""
    k = F.col("o_orderkey")
    cells = F.array(lit("Aberto"), k.cast("string"), lit("x"), F.when(k % 2 == 0, F.concat(lit("Bloco "), "o_custkey", lit(" de teste"))).otherwise("gerado"))
    return spread(spark, d, "orders").select("o_orderkey", C.family_list(F.when(k % 3 == 0, " ACT, foo,ted,act").otherwise("foo")).alias("families"), C.first_description(cells, k.cast("string")).alias("description"))


@query("""SELECT o_orderkey, o_orderkey % 5 IN (0, 1, 2) AS is_label, CASE o_orderkey % 5 WHEN 0 THEN 'TED' WHEN 1 THEN 'MEMORANDO' WHEN 2 THEN 'ACT' WHEN 3 THEN 'PT' END AS family FROM orders""")
def labels_and_families(spark, d):
    """CLS17, CLS21."""
    k = F.col("o_orderkey") % 5
    label = _of({0: "Gestor do acordo com muitas outras palavras", 1: "Número", 2: "um rótulo qualquer (2)", 3: "frase longa demais para ser um rótulo", 4: "com sinal + outro"}, k)
    name = _of({0: "Termo de Execução Descentralizada", 1: "Memorando", 2: "Acordo de Cooperação", 3: "Plano de Trabalho"}, k)
    return spread(spark, d, "orders").select("o_orderkey", C.is_metadata_label(label).alias("is_label"), C.family_of(name).alias("family"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'snapshot_vazio' WHEN 1 THEN 'pagina_de_pesquisa' WHEN 2 THEN 'pt_sem_expressao' END AS reason, o_orderkey % 4 = 3 AS closing, CASE WHEN o_orderkey % 4 = 3 THEN 'a; b' ELSE 'a' END AS warned, o_orderkey % 4 = 1 AS mismatch FROM orders""")
def rejections_and_warnings(spark, d):
    """CLS6, CLS11, CLS19, CLS20."""
    k = F.col("o_orderkey") % 4
    text = _of({0: " ", 1: "Pesquisar no Processo", 2: "texto", 3: "Plano de trabalho: relatório de execução após o término"}, k)
    w = C.warnings(lit("a"), lit(""), F.when(k == 3, "b"))
    return spread(spark, d, "orders").select("o_orderkey", C.reject_reason(text, lit("pt")).alias("reason"), C.closing_report(X.fold(text)).alias("closing"), w.alias("warned"), C.has_mismatch(F.when(k == 1, "processo_divergente_documento=1").otherwise("x")).alias("mismatch"))


@query("""SELECT o_orderkey, o_orderkey % 3 <> 2 AS draft, CASE WHEN o_orderkey % 4 = 0 THEN 'completo_padronizado' WHEN o_orderkey % 4 IN (1, 2) THEN 'parcial_padronizado' ELSE 'extraido_sem_padrao' END AS status, CASE o_orderkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 5 WHEN 2 THEN 3 ELSE 3 END AS captured FROM orders""")
def plan_states(spark, d):
    """CLS5, CLS12 by content: drafts by title and by lead, and periods that end before they begin."""
    k, m = F.col("o_orderkey") % 3, F.col("o_orderkey") % 4
    draft = C.plan_draft(F.when(k == 0, "Documentação minuta").when(k == 2, "Minuta").otherwise(""), lit(""), F.when(k == 1, "MINUTA DE PLANO DE TRABALHO").otherwise("Plano de Trabalho do acordo"))
    start, end = F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), F.when(m == 1, -1).otherwise(1))
    status = C.plan_status(F.when(m < 3, "Instituto Norte").otherwise("ab"), F.when(m < 3, "vigiar florestas").otherwise("curto"), F.when(m != 2, start), F.when(m != 2, end), F.when(m != 3, "mapear a floresta toda"), F.when(m == 3, "mapear a floresta toda"))
    return spread(spark, d, "orders").select("o_orderkey", draft.alias("draft"), status["status"].alias("status"), status["captured"].alias("captured"))


@query("SELECT o_orderkey, 'ted' AS doc_class, 'published_gold' AS publication_status, 'Processo: ' || o_orderkey || chr(10) || 'Objeto: obj ' || o_custkey AS tail FROM orders")
def api_terms(spark, d):
    """SRC10, SRC11, CLS22: API bodies become snapshots that are final."""
    k = F.col("o_orderkey").cast("string")
    body = F.concat(lit('[{"numeroProcesso": "'), k, lit('", "objeto": "obj '), F.col("o_custkey").cast("string"), lit('"}]'))
    df = S.api_payload(t(spark, d, "orders").select("o_orderkey", body.alias("body")))
    df = C.api_analysis(df.withColumn("text", S.api_snapshot(F.col("payload"))["text"]))
    return df.select("o_orderkey", "doc_class", "publication_status", F.regexp_extract("text", r"(?s)Processo: .*", 0).alias("tail"))


# --- extraction -------------------------------------------------------------------------------------------------
@query("""SELECT o_orderkey, 'Do prazo ' || o_orderkey AS clause, 'PRAZO DE VIGÊNCIA: ' || o_custkey AS focus, 'abertura ' || o_orderkey AS head, 'Vigiar o segmento ' || o_custkey AS objeto, 'clausula_objeto' AS source FROM orders""")
def clauses(spark, d):
    """EXT1, EXT3-EXT5, EXT8: clauses end at the next, numbers before them included."""
    o = spread(spark, d, "orders")
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    text = F.concat(lit("abertura "), k, lit("\n1. CLÁUSULA PRIMEIRA - DO OBJETO\n- Vigiar o segmento "), c, lit("\nSubcláusula única: não\n2. CLÁUSULA SEGUNDA: Do prazo "), k, lit("\n3. CLÁUSULA TERCEIRA\nnada\nPRAZO DE VIGÊNCIA: "), c)
    subject = E.subject(text)
    return o.select("o_orderkey", E.section(text, ["CLÁUSULA SEGUNDA:"]).alias("clause"), E.focus_window(text, [r"\bPRAZO\s+DE\s+VIG[ÊE]NCIA\b"]).alias("focus"), E.preamble(text).alias("head"), subject["value"].alias("objeto"), subject["source"].alias("source")).withColumn("head", F.regexp_replace("head", r"\n1\.$", ""))


_PARTIES = {0: "a União, por intermédio do Instituto {} e o Ministério da Defesa, para os fins que especifica", 1: "a Instituto {} e o Ministério da Defesa, doravante denominados", 2: "o Ministério da Defesa e o\nInstituto {}, neste ato", 3: "a União e, de outro lado, o Instituto {}, com sede em X"}


@query("SELECT o_orderkey, 'Instituto ' || lpad(o_custkey::VARCHAR, 8, '0') AS party, 'preambulo' AS source FROM orders")
def counterparties(spark, d):
    """EXT7: the party that isn't the publisher's, first or second, on one line or two."""
    o = spread(spark, d, "orders").select("o_orderkey", F.replace(_of(_PARTIES, F.col("o_orderkey") % 4), lit("{}"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("x"))
    o = o.select("o_orderkey", E.counterparty(F.concat(lit("ACORDO que entre si celebram "), "x", lit(".\nCLÁUSULA PRIMEIRA"))).alias("p"))
    return o.select("o_orderkey", F.col("p.value").alias("party"), "p.source")


@query("""SELECT o_orderkey, 'Ana ' || c_name AS holder, 'Rui ' || c_mktsegment AS deputy, 'Divisao ' || n_name AS unit FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def named_people(spark, d):
    """EXT9: the holder, the deputy and the unit of an agreement."""
    o = spread(spark, d, "orders").join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    text = F.concat(lit("Titular: Ana "), "c_name", lit(" CPF 1\nSuplente: Rui "), "c_mktsegment", lit(", Matrícula 7\nUnidade Responsável: Divisao "), "n_name", lit("\n"))
    return o.select("o_orderkey", E.named_value(text, E.HOLDER).alias("holder"), E.named_value(text, E.DEPUTY).alias("deputy"), E.named_value(text, E.UNIT).alias("unit"))


@query("""SELECT o_orderkey, 'Instituto ' || c_name AS partner, 'vigiar a floresta do segmento ' || lower(c_mktsegment) AS objeto, 'Responsabilidades dos Partícipes: apoiar ' || c_name AS duties, 'Metas de execução Meta 1 vigiar ' || c_name AS work FROM orders JOIN customer ON c_custkey = o_custkey""")
def plan_sections(spark, d):
    """EXT2, EXT11-EXT13, EXT15: a work plan's partner, object, duties and execution by their headings."""
    o = spread(spark, d, "orders").join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    text = F.concat(lit("Partícipe 2: Instituto "), "c_name", lit(" CNPJ 1\nIdentificação do Objeto vigiar a floresta do segmento "), "c_mktsegment", lit("\nDiagnóstico x\nResponsabilidades dos Partícipes: apoiar "), "c_name", lit("\nObservações: y\n5. Metas de execução\nMeta 1 vigiar "), "c_name", lit("\n6. Fim"))
    o = o.select("o_orderkey", text.alias("x"))
    return o.select("o_orderkey", E.plan_partner(F.col("x"), lit("")).alias("partner"), E.plan_object(F.col("x"), lit("")).alias("objeto"), E.duties(F.col("x")).alias("duties"), X.clean_spaces(E.execution_section(F.col("x"))).alias("work"))


@query("""SELECT o_orderkey, '1 | Mapear || 2 | Voar || Fase A | Treinar ' || o_custkey AS goals, 'Mapear | Equipe | ' || o_custkey || ' || Treinar ' || o_custkey || ' || solta | x' AS actions FROM orders""")
def goal_tables(spark, d):
    """EXT14: numbered rows are goals and actions, named ones too, and tables with other headers are left out."""
    c = F.col("o_custkey").cast("string")
    row = lambda *x: F.array(*[lit(y) if isinstance(y, str) else y for y in x])
    table = F.struct(F.array(row("Meta", "Descrição", "Responsável", "Período"), row("1", "Mapear", "Equipe", c), row("2", "Voar", "", ""), row("Fase A", F.concat(lit("Treinar "), c), "", ""), row("solta", "x", "", ""), row("", " ", "", "")).alias("rows"))
    other = F.struct(F.array(row("Nome", "Fase", "", ""), row("1", "não", "", "")).alias("rows"))
    o = spread(spark, d, "orders").select("o_orderkey", E.routed_goals(F.array(other, table)).alias("g"))
    return o.select("o_orderkey", "g.goals", "g.actions")


@query("""SELECT o_orderkey, 'Meta 1 - vigiar ' || o_custkey || ' sempre || Meta 2 - voar' AS goals, 'Acao: mapear ' || o_orderkey || ' || Produto: mapa' AS actions FROM orders""")
def goal_fragments(spark, d):
    """EXT16, EXT17: goals and actions in running text, over line ends."""
    text = F.concat(lit("Metas de execução\nMeta 1 - vigiar "), F.col("o_custkey").cast("string"), lit("\nsempre\nAcao: mapear "), F.col("o_orderkey").cast("string"), lit("\nProduto: mapa\nMeta 2 - voar\n7. Fim"))
    none = lit(None).cast("array<struct<rows:array<array<string>>>>")
    o = spread(spark, d, "orders").select("o_orderkey", text.alias("x")).withColumns({"routed": E.routed_goals(none), "execution": E.execution_section(F.col("x"))})
    return o.select("o_orderkey", *[E.goals_of(F.col("routed"), F.col("execution"), F.col("x"), k == "actions").alias(k) for k in ("goals", "actions")])


@query("""SELECT c_custkey, c_name AS parceiro, '12/' || c_custkey AS numero_act, 'vigencia de ' || c_nationkey AS vigencia, 'saldo do segmento ' || c_mktsegment || ' e mais' AS objeto FROM customer""")
def annotation_labels(spark, d):
    """EXT19, EXT20: annotation blocks in the portal's labels, as a cell of a list row; an object ends at a mixed-case label."""
    name = F.concat(_of({0: "NÚMERO ACT", 1: "NÚMERO", 2: "NUMEROACT", 3: "Número Act"}, F.col("c_custkey") % 4), lit(": "))
    k = F.col("c_custkey").cast("string")
    block = F.concat(lit("PARCEIROS: "), "c_name", lit("\n"), name, lit("Nº 12/"), k, lit(".\nOBJETO: saldo do\n segmento "), "c_mktsegment", lit("\ne mais\nGestor: outro\nVIGÊNCIA:\nVigência: vigencia de "), F.col("c_nationkey").cast("string"))
    c = spread(spark, d, "customer").select("c_custkey", E.preview_record(F.array(k, block), lit("x")).alias("a"))
    return c.select("c_custkey", "a.parceiro", "a.numero_act", "a.vigencia", "a.objeto")


@query("""SELECT o_orderkey, f.k AS field_key, f.l AS label, f.v AS value, f.o AS origin_ref FROM (SELECT o_orderkey, unnest([{'k': 'vigencia', 'l': 'Vigencia', 'v': strftime(o_orderdate, '%d/%m/%Y'), 'o': 'table#0 row#0'}, {'k': 'periodo', 'l': 'Periodo', 'v': strftime(o_orderdate, '%d/%m/%Y') || ' | 31/12/2031', 'o': 'table#0 row#1'},
    {'k': 'inicio', 'l': 'Início', 'v': 'jan/2024', 'o': 'line#0'}, {'k': 'prazo', 'l': 'Prazo', 'v': 'a partir da assinatura', 'o': 'line#1'}, {'k': 'data', 'l': '', 'v': 'ate dez-24 ' || o_custkey, 'o': 'line#2'}]) AS f FROM orders)""")
def raw_field_tables(spark, d):
    """EXT21, SNK2: fields of tables (all cells after the label), of lines, and bare lines; page furniture is none."""
    o = spread(spark, d, "orders")
    row = lambda *x: F.array(*[lit(y) if isinstance(y, str) else y for y in x])
    table = F.array(F.struct(F.array(row("Vigencia", "", day()), row("Periodo", day(), "31/12/2031"), row("Nome", "x", "y")).alias("rows")))
    text = F.concat(lit("Início: jan/2024\n\nPrazo: a partir da assinatura\nate dez-24 "), F.col("o_custkey").cast("string"), lit("\nhttps://x.org 01/01/2020\nCliente: 12/2020"))
    df = o.select("o_orderkey", text.alias("text"), table.alias("tables"))
    return E.raw_fields(df, "o_orderkey").select("o_orderkey", "field_key", "label", "value", "origin_ref")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE o_custkey::VARCHAR END AS number, 'texto ' || o_orderkey AS snapshot_text, o_orderpriority AS unknown, CASE WHEN o_orderkey % 3 = 0 THEN '{"a":[' || o_custkey || ']}' END AS api FROM orders""")
def snapshot_texts(spark, d):
    """EXT22, EXT23: the first filled number; text and payload of the snapshot at a path, with keys that no schema names."""
    o = t(spark, d, "orders")
    text = F.concat(lit("texto "), "o_orderkey")
    api = F.when(F.col("o_orderkey") % 3 == 0, F.concat(lit(', "api_payload": {"a": ['), F.col("o_custkey").cast("string"), lit("]}"))).otherwise("")
    body = F.concat(lit('{"snapshot": {"text": "x"'), api, lit('}, "new_key": "'), "o_orderpriority", lit('"}'))
    snaps = o.select(F.concat(lit("/s/"), "o_orderkey").alias("json_path"), F.struct(text.alias("text")).alias("snapshot"), F.try_parse_json(body).alias("payload"))
    rows = o.select("o_orderkey", F.concat(lit("/s/"), "o_orderkey").alias("json_path"), E.instrument_number(F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise(" "), F.col("o_custkey").cast("string")).alias("number"))
    out = E.with_snapshot_text(rows, snaps)
    return out.select("o_orderkey", "number", "snapshot_text", S.payload_value(F.col("snapshot_payload"), "$.new_key").alias("unknown"), S.payload_value(F.col("snapshot_payload"), "$.snapshot.api_payload").alias("api"))


_ACT = """WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
    SELECT o_orderkey, 'Fundacao ' || lpad(o_custkey::VARCHAR, 8, '0') AS orgao_convenente, 'Monitorar ' || o_custkey AS objeto, 'Ana Lima' AS gestor_titular, 'Rui Melo' AS gestor_substituto, 'Divisao X' AS unidade_responsavel, 'rotulos_explicitos' AS field_source_gestao,
      'clausula_objeto' AS field_source_objeto, 'clausula_vigencia_assinatura' AS field_source_vigencia, lpad(o_custkey::VARCHAR, 5, '0') || '.000002/2021-02' AS document_processo, 'processo_referencia_externa_documento=' || lpad(o_custkey::VARCHAR, 5, '0') || '.000002/2021-02' AS validation_warning,
      'external_reference' AS process_alignment_status, o_orderdate::DATE AS data_inicio_vigencia, (o_orderdate::DATE + to_months(24) - INTERVAL 1 DAY)::DATE AS data_fim_vigencia, CASE WHEN rn = 1 THEN 'published_gold' ELSE 'retained_silver' END AS publication_status FROM o"""


@query(_ACT)
def agreement_records(spark, d):
    """EXT10: whole records of agreements that cite another case."""
    from .plans import publish

    o = spread(spark, d, "orders")
    c = F.col("o_custkey")
    text = F.concat(
        lit("ACORDO DE COOPERAÇÃO TÉCNICA Nº 7/2021 que entre si celebram a Fundacao "), F.lpad(c.cast("string"), 8, "0"), lit(" e o Ministério da Defesa, para os fins que especifica.\nProcesso "), F.lpad(c.cast("string"), 5, "0"), lit(".000002/2021-02"),
        lit("\nCLÁUSULA PRIMEIRA - DO OBJETO\nMonitorar "), c.cast("string"), lit("\nCLÁUSULA NONA - DA VIGÊNCIA\nO prazo será de 2 (dois) anos a partir da assinatura.\nCLÁUSULA DEZ\nGestor Titular: Ana Lima\nGestor Substituto: Rui Melo\nUnidade Responsável: Divisao X\nDocumento assinado eletronicamente por B em "), day(),
    )
    bronze = o.select("o_orderkey", F.format_string("%05d.000001/2021-01", c).alias("processo"), lit("act").alias("requested_type"), lit("Acordo").alias("title"), text.alias("text"), lit("").alias("chosen"), F.col("o_orderkey").cast("string").alias("json_path"), F.col("o_orderkey").alias("row_idx"))
    out = records.agreement(publish.agreements(bronze))
    return out.select(F.col("json_path").cast("long").alias("o_orderkey"), "orgao_convenente", "objeto", "gestor_titular", "gestor_substituto", "unidade_responsavel", "field_source_gestao", "field_source_objeto", "field_source_vigencia", "document_processo", "validation_warning", "process_alignment_status", "data_inicio_vigencia", "data_fim_vigencia", "publication_status")


_PLAN = """SELECT o_orderkey, 'Instituto ' || c_name AS parceiro, 'vigiar a floresta de ' || n_name AS objeto, o_orderdate::DATE AS vigencia_inicio, (o_orderdate::DATE + to_months(24))::DATE AS vigencia_fim, 'derived_from_signature' AS period_source, '1 | Mapear a floresta' AS metas_raw, 'Mapear a floresta | ' || o_orderpriority AS acoes_raw,
    'plano_trabalho' AS resolved_document_type, 'sel' AS selection_reason, CASE WHEN o_orderstatus = 'P' THEN 'pt_minuta_documentacao' ELSE 'plano_trabalho_validado_por_conteudo' END AS classification_reason, CASE WHEN o_orderstatus = 'P' THEN 'retained_silver' ELSE 'published_gold' END AS publication_status,
    'completo_padronizado' AS normalization_status, 6 AS captured_focus_fields, 'compromissos e responsabilidades: apoiar' AS atribuicoes_raw, '60 meses' AS vigencia_raw FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""


def _plan_records(spark, d):
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    previews = c.select(F.col("c_custkey").alias("row_idx"), F.col("c_custkey").cast("string").alias("processo"), F.concat(lit("Instituto "), "c_name").alias("parceiro"), lit("60 meses").alias("vigencia"), lit("").alias("numero_act"), F.concat(lit("vigiar a floresta de "), "n_name").alias("objeto"))
    text = F.concat(F.when(F.col("o_orderstatus") == "P", "Minuta de ").otherwise(""), lit("Plano de trabalho\ncompromissos e responsabilidades: apoiar\nObservações: x\npelo prazo de dois anos, a partir da data de sua assinatura.\nAssinado eletronicamente por A, em "), day(), lit("."))
    row = lambda *x: F.array(*[lit(y) if isinstance(y, str) else y for y in x])
    table = F.array(F.struct(F.array(row("Meta", "Descrição", "Período"), row("1", "Mapear a floresta", F.col("o_orderpriority"))).alias("rows")))
    bronze = spread(spark, d, "orders").select(F.col("o_orderkey").alias("row_idx"), F.col("o_custkey").cast("string").alias("processo"), text.alias("text"), table.alias("tables"), lit("").alias("title"), lit("").alias("chosen"), lit("sel").alias("selection_reason"), lit(None).cast("struct<status:string,inicio_data:string,inicio_raw:string,termino_data:string,termino_raw:string>").alias("prazos"), F.concat(lit("/p/"), "o_orderkey").alias("json_path"))
    return records.work_plan(bronze, previews)


@query(_PLAN)
def plan_records(spark, d):
    """EXT18: whole records of work plans."""
    return _plan_records(spark, d).select(F.col("row_idx").alias("o_orderkey"), "parceiro", "objeto", "vigencia_inicio", "vigencia_fim", "period_source", "metas_raw", "acoes_raw", "resolved_document_type", "selection_reason", "classification_reason", "publication_status", "normalization_status", "captured_focus_fields", "atribuicoes_raw", "vigencia_raw")


# --- selection and joins ----------------------------------------------------------------------------------------
def _attempts(spark, d):
    o = t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("row_idx"), F.col("o_custkey").cast("string").alias("processo"), F.when(F.col("o_orderstatus") == "F", "published_gold").otherwise("retained_silver").alias("publication_status"), F.col("o_totalprice").alias("canonical_score"), (F.col("o_orderkey") % 3).alias("captured_focus_fields"), F.col("o_orderpriority").alias("objeto"), F.concat(lit("/x/"), "o_orderkey").alias("json_path"))


@query("""SELECT p.o_custkey::VARCHAR AS processo, p.o_orderkey AS plan, a.o_orderkey AS agreement FROM
    (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderkey % 3 DESC, length(o_orderpriority) DESC, o_orderkey) = 1) p
    JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, length(o_orderpriority) DESC, o_orderkey) = 1) a USING (o_custkey)""")
def best_records(spark, d):
    """SEL2, SEL3: the best plan and the best agreement of each case."""
    o = _attempts(spark, d)
    plan, act = select.best_plan(o).select("processo", F.col("row_idx").alias("plan")), select.best_agreement(o).select("processo", F.col("row_idx").alias("agreement"))
    return plan.join(act, "processo")


@query("""SELECT p_partkey, [p_type, p_brand] AS terms, [p_brand, p_type] AS ordered FROM part""")
def distinct_lists(spark, d):
    """SEL7, SEL11: the first spelling of each term, and filled values in order."""
    p = t(spark, d, "part")
    return p.select("p_partkey", select.distinct_terms(F.array(F.col("p_type"), F.upper("p_type"), lit(" "), F.col("p_brand")), F.array(lit("z"))).alias("terms"), select.ordered_distinct(F.array(F.concat(lit(" "), "p_brand"), F.col("p_brand"), lit(""), F.col("p_type"))).alias("ordered"))


@query("SELECT 'c' AS kind, (SELECT count(*) FROM customer WHERE c_custkey = 7) AS n, (SELECT min(o_orderkey) FROM orders WHERE o_custkey = 7) AS first_order, (SELECT c_name FROM customer WHERE c_custkey = 7) AS name")
def case_explorer(spark, d):
    """JOI7, PRJ9: what each table holds of one case, as one row."""
    c = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("processo"), "c_name", F.col("c_custkey").alias("row_idx"))
    o = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("processo"), "o_orderkey", F.col("o_orderkey").alias("row_idx"))
    row = select.explorer({"customer": c, "orders": o}, "7")
    row = row.withColumn("x", dash.context(F.col("customer").isNotNull(), name=F.get_json_object("customer", "$.c_name")))
    return row.select(lit("c").alias("kind"), F.col("x.found").cast("long").alias("n"), F.get_json_object("orders", "$.o_orderkey").cast("long").alias("first_order"), "x.name")


@query("""SELECT o_orderkey, 'd' || o_custkey AS documento, 'obj ' || o_custkey AS objeto, '' AS uf FROM orders WHERE o_orderstatus = 'F'""")
def manifest_terms(spark, d):
    """EXP4, FLT7: published attempts with what their payload holds, found by file name."""
    o = _attempts(spark, d).withColumns({"documento": F.concat(lit("d"), "processo"), "snapshot_mode": lit("api")})
    payload = _attempts(spark, d).select(F.concat(lit("C:\\y\\"), "row_idx").alias("json_path"), F.concat(lit("obj "), "processo").alias("objeto"), "row_idx")
    out = select.manifest_details(dash.gold(o, "json_path"), payload)
    return out.select(F.regexp_extract("json_path", r"\d+$", 0).cast("long").alias("o_orderkey"), "documento", "objeto", "uf")


_OVER = """WITH a AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, length(o_orderpriority) DESC, o_orderkey) = 1),
    n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
    r AS (SELECT o_custkey, string_agg(l || '(' || k || ')', ' | ' ORDER BY l) AS r FROM (SELECT o_custkey, 'extrato:' || o_orderstatus AS l, count(*) AS k FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2) GROUP BY 1)
    SELECT c_custkey::VARCHAR AS processo, coalesce(o_orderstatus = 'F', false) AS act_gold, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 250000 THEN 'gold_complete' ELSE 'gold_partial' END WHEN o_orderstatus IS NOT NULL THEN 'silver_only' ELSE 'not_found' END AS act_quality,
      coalesce(n, 0) AS act_attempts_count, coalesce(r, '') AS act_rejection_summary, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 'gold' ELSE 'preview' END AS source_act_objeto, CASE WHEN o_orderstatus = 'F' AND NOT o_totalprice > 250000 THEN 'objeto' ELSE '' END AS act_missing_fields,
      CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 'high' WHEN o_orderstatus = 'F' THEN 'medium' ELSE 'low' END AS quality_status, 'not_found' AS ted_quality
    FROM customer LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN n ON n.o_custkey = c_custkey LEFT JOIN r ON r.o_custkey = c_custkey"""


def _overview(spark, d):
    from .plans import publish

    previews = t(spark, d, "customer").select(F.col("c_custkey").alias("row_idx"), F.col("c_custkey").cast("string").alias("processo"), F.col("c_name").alias("parceiro"), lit("").alias("vigencia"), lit("").alias("numero_act"), lit("objeto previo").alias("objeto"))
    acts = _attempts(spark, d).withColumns({"numero_acordo": F.col("json_path"), "data_inicio_vigencia": lit("2020-01-01").cast("date"), "data_fim_vigencia": lit("2021-01-01").cast("date"), "orgao_convenente": lit("Fundacao"), "validation_warning": lit("")})
    acts = acts.withColumn("objeto", F.when(F.col("canonical_score") > 250000, F.col("objeto")).otherwise(F.regexp_replace("objeto", ".", " ")))
    status = t(spark, d, "orders").select(F.col("o_orderkey").alias("row_idx"), F.col("o_custkey").cast("string").alias("processo"), F.when(F.col("o_orderstatus") == "F", "published_gold").otherwise("retained_silver").alias("publication_status"), lit("extrato").alias("doc_class"), F.col("o_orderstatus").alias("classification_reason"))
    none = previews.select("processo", F.col("parceiro").alias("json_path"), "row_idx").limit(0)
    plans = none.select("processo", "json_path", "row_idx", lit("x").alias("publication_status"), lit(None).cast("date").alias("vigencia_inicio"), lit(None).cast("date").alias("vigencia_fim"), lit(0).alias("captured_focus_fields"), lit("").alias("objeto"))
    payload = none.select("json_path", lit("").alias("objeto"), lit("").alias("valor_global"), lit("").alias("situacao"), lit("").alias("uf"), "row_idx")
    return publish.overview(previews, plans, acts, none, none, status, none.withColumn("selection_reason", lit("")), payload)


@query(_OVER)
def overview_mart(spark, d):
    """JOI1, PRJ4, PRJ5, PRJ7, CLS18: the mart of all cases from their previews and agreements."""
    return _overview(spark, d).select("processo", "act_gold", "act_quality", "act_attempts_count", "act_rejection_summary", "source_act_objeto", "act_missing_fields", "quality_status", "ted_quality")


@query(f"SELECT processo, quality_status, act_quality, act_attempts_count, c_name AS preview_parceiro FROM ({_OVER}) JOIN customer ON c_custkey::VARCHAR = processo")
def divergences(spark, d):
    """PRJ6."""
    from .plans import publish

    return publish.divergence(_overview(spark, d)).select("processo", "quality_status", "act_quality", "act_attempts_count", "preview_parceiro")


@query("""WITH h AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey) AS position, count(*) OVER (PARTITION BY l_orderkey) AS total_resultados, CASE WHEN l_linenumber % 2 = 0 THEN 'linha ' || l_suppkey ELSE l_partkey::VARCHAR END AS protocolo FROM lineitem)
    SELECT l_orderkey, 'ok|' || max(total_resultados) || '|' || string_agg(protocolo, ',' ORDER BY position) FILTER (WHERE position <= 3) AS signature FROM h GROUP BY 1""")
def hit_signatures(spark, d):
    """PRJ10, SEL10: hits get places, totals and ids that are never empty; a result set's signature is made of them."""
    odd = F.col("l_linenumber") % 2 == 1
    row = F.col("l_linenumber").cast("long") * 1000000000000 + F.col("l_partkey") * 100000 + F.col("l_suppkey")
    df = t(spark, d, "lineitem").select("l_orderkey", row.alias("row_idx"), F.when(odd, F.col("l_partkey").cast("string")).otherwise(" ").alias("protocolo"), F.concat(lit("linha  "), "l_suppkey").alias("row_text"), lit(1).cast("long").alias("counted"), lit("ok").alias("state"))
    return select.result_signature(dash.hits(df, "l_orderkey").withColumn("total", F.col("total_resultados")), "l_orderkey")


# --- dashboard --------------------------------------------------------------------------------------------------
@query("""SELECT 'attempts' AS what, o_custkey::VARCHAR AS k, count(*)::DOUBLE AS n FROM orders GROUP BY o_custkey UNION ALL SELECT 'level', l, n FROM (SELECT count(*)::DOUBLE AS total, count_if(event_type = 'view')::DOUBLE AS view, count_if(event_type = 'error')::DOUBLE AS error FROM events) UNPIVOT (n FOR l IN (total, view, error))
    UNION ALL SELECT 'value', 'total', sum(CAST(o_totalprice AS DECIMAL(18, 2)))::DOUBLE FROM orders UNION ALL SELECT 'value', 'regions', count(DISTINCT o_orderpriority)::DOUBLE FROM orders""")
def dashboard_totals(spark, d):
    """AGG3, AGG4, AGG9."""
    o = t(spark, d, "orders")
    tried = dash.attempts_per_process(o.select(F.col("o_custkey").cast("string").alias("processo"))).select(lit("attempts").alias("what"), F.col("processo").alias("k"), F.col("attempts").cast("double").alias("n"))
    levels = dash.level_counts(t(spark, d, "events"), ("view", "error"), "event_type").selectExpr("stack(3, 'total', total, 'view', view, 'error', error) AS (k, n)").select(lit("level").alias("what"), "k", F.col("n").cast("double").alias("n"))
    value = dash.value_and_regions(o.select(cents("o_totalprice").alias("v"), "o_orderpriority"), "v", "o_orderpriority").selectExpr("stack(2, 'total', CAST(total_value AS DOUBLE), 'regions', CAST(regions AS DOUBLE)) AS (k, n)").select(lit("value").alias("what"), "k", "n")
    return tried.union(levels).union(value)


@query("SELECT count(*) AS selected, sum(v)::DOUBLE AS total, round(avg(v)::DOUBLE, 4) AS mean FROM (SELECT user_id, sum(CAST(value AS DECIMAL(18, 2))) AS v FROM events GROUP BY 1 HAVING v > 0)")
def selected_runtime(spark, d):
    """AGG5: time of the selected cases."""
    spans = t(spark, d, "events").groupBy("user_id").agg(F.sum(cents("value")).alias("total_seconds")).where("total_seconds > 0")
    return dash.runtime(spans, 0.0).select("selected", F.col("total").cast("double").alias("total"), F.round(F.col("mean").cast("double"), 4).alias("mean"))


@query("""SELECT o_orderkey, 'x' || o_custkey AS atribuicoes, o_orderkey % 2 = 0 AS has_goals, true AS has_actions, false AS has_deadline, o_orderdate::DATE AS day, o_orderkey % 3 = 0 AS has_path FROM orders WHERE o_orderstatus <> 'F'""")
def plan_flags(spark, d):
    """PRJ2, PRJ3, FLT6: duties of either spelling, flags of goals, actions and deadlines, typed dates; rows
    with a deadline (closed orders) are left out."""
    o = t(spark, d, "orders").select("o_orderkey", lit("").alias("atribuições_raw"), F.concat(lit("x"), "o_custkey").alias("atribuicoes_raw"), F.when(F.col("o_orderkey") % 2 == 0, "m").otherwise(" ").alias("metas"), lit("a").alias("acoes"), F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("").alias("vigencia_fim"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(F.col("o_orderkey") % 3 == 0, "p").otherwise("").alias("json_path"))
    df = dash.without_deadline(dash.typed(dash.plan_columns(o), dates=["day"], present={"has_path": "json_path"}))
    return df.select("o_orderkey", "atribuicoes", "has_goals", "has_actions", "has_deadline", "day", "has_path")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def audit_else_gold(spark, d):
    """FLT5, FLT7: an empty audit gives the published rows."""
    o = _attempts(spark, d)
    return dash.audit_or_gold(o.where("publication_status = 'none'"), dash.gold(o)).select(F.col("row_idx").alias("o_orderkey"))


@query("SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1)::INT AS item, l_partkey::VARCHAR || '.' AS reference, 'supplier ' || l_suppkey AS description FROM lineitem")
def goal_rows(spark, d):
    """EXP1: an order's lines are packed as goals and taken apart again."""
    df = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.col("l_partkey").cast("string"), lit(". | supplier "), "l_suppkey").alias("line"))
    packed = df.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "line"))), lambda x: x["line"]), " || ").alias("metas"))
    return dash.explode_goals(packed).select("l_orderkey", "item", "reference", "description")


@query("SELECT event_type AS name, sum(CAST(value AS DECIMAL(18, 2)))::DOUBLE AS total_seconds, count(*) AS calls FROM events GROUP BY 1")
def span_rows(spark, d):
    """EXP5, AGG1: a run's map of spans, and its rows."""
    spans = dash.span_totals(t(spark, d, "events").select(F.col("event_type").alias("name"), cents("value").alias("seconds")))
    whole = spans.agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct(F.col("total_seconds").cast("double").alias("total_seconds"), "calls")))).alias("spans"))  # one entry a kind of span
    return dash.span_rows(whole)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) <= 5 AS is_top FROM orders")
def top_flags(spark, d):
    """SRT3."""
    return dash.rank_by(t(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey").select("o_orderkey", "is_top")


# --- run log ----------------------------------------------------------------------------------------------------
_LOG = """WITH e AS (SELECT user_id AS run, event_id AS line_no, ts, event_type FROM events),
    o AS (SELECT *, lead(ts) OVER w AS next_ts, sum((event_type = 'signup')::INT) OVER w AS visit FROM e WINDOW w AS (PARTITION BY run ORDER BY ts, line_no)),
    v AS (SELECT *, coalesce(last_value(CASE event_type WHEN 'click' THEN 'pt' WHEN 'view' THEN 'act' WHEN 'error' THEN 'ted' END IGNORE NULLS) OVER (PARTITION BY run, visit ORDER BY ts, line_no ROWS UNBOUNDED PRECEDING), 'open') AS stage, CASE WHEN next_ts IS NULL THEN 0 ELSE (epoch_us(next_ts) - epoch_us(ts)) / 1e6 END AS s FROM o WHERE visit > 0),
    g AS (SELECT run, visit, round(sum(CASE WHEN stage = 'open' THEN s ELSE 0 END), 3) AS a, round(sum(CASE WHEN stage = 'pt' THEN s ELSE 0 END), 3) AS p, round(sum(CASE WHEN stage = 'act' THEN s ELSE 0 END), 3) AS c, round(sum(CASE WHEN stage = 'ted' THEN s ELSE 0 END), 3) AS t, count_if(event_type = 'error') AS failed FROM v GROUP BY 1, 2)
    SELECT run, visit::BIGINT AS visit, a AS abertura_processo_seconds, p AS busca_pt_seconds, c AS busca_act_seconds, t AS busca_ted_seconds, failed AS ted_falha_filtro,
      CASE greatest(a, p, c, t) WHEN a THEN 'abertura do processo' WHEN p THEN 'busca PT' WHEN c THEN 'busca ACT' ELSE 'busca TED' END AS dominant_stage FROM g"""


@query(_LOG)
def log_visits(spark, d):
    """LOG1-LOG6: events written as a run's messages and summed up by visit."""
    e = t(spark, d, "events")
    case = case_number(F.col("user_id"))
    message = (
        F.when(F.col("event_type") == "signup", F.concat(lit("Abrindo processo "), case)).when(F.col("event_type") == "click", lit("clicando Pesquisar no Processo para Plano de Trabalho."))
        .when(F.col("event_type") == "view", lit("iniciando busca do documento 'Acordo de Cooperação'")).when(F.col("event_type") == "error", F.concat(lit("Processo "), case, lit(": TED termo 'x' falhou no filtro"))).otherwise("outra linha")
    )
    lines = e.select(F.col("user_id").alias("run"), F.col("event_id").alias("line_no"), "ts", message.alias("message"))
    out = runlog.summarize(lines)
    return out.select("run", "visit", "abertura_processo_seconds", "busca_pt_seconds", "busca_act_seconds", "busca_ted_seconds", "ted_falha_filtro", "dominant_stage")


# --- sources and sinks ------------------------------------------------------------------------------------------
@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority AS note, '' AS absent FROM orders")
def csv_round_trip(spark, d):
    """SRC1, SRC2, SNK1: orders written as CSV with a byte-order mark, blanks and line ends in cells, and read again."""
    path = S.shared_folder(spark)
    o = t(spark, d, "orders").select("o_orderkey", F.concat(lit(" "), "o_orderpriority", lit("\n ")).alias("note"))
    S.write_csv(o, path, ["o_orderkey", "note"], bom=True)
    return S.read_csv(spark, path, ["o_orderkey", "note", "absent"], collapse=True).drop("row_idx")


@query("SELECT event_id, event_type AS message, 'INFO' AS level FROM events WHERE event_id % 3 <> 0")
def log_round_trip(spark, d):
    """SRC4, SRC5: events written as log lines, some without a text, and read again."""
    path = S.shared_folder(spark)
    e = t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), lit("INFO").alias("level"), F.when(F.col("event_id") % 3 != 0, F.concat_ws(" ", "event_type", "event_id")).alias("message"))
    e.write.json(path)
    parts = F.split("message", " ")
    return S.read_log(spark, path).select(F.element_at(parts, 2).cast("long").alias("event_id"), F.element_at(parts, 1).alias("message"), "level")


@query("SELECT o_orderkey, 'run2' AS run_id, o_orderstatus, (SELECT count(*) FROM orders) AS older FROM orders WHERE o_orderstatus = 'F'")
def layer_runs(spark, d):
    """SNK4, SRC7: a run replaces its own partition only; the latest run is the default."""
    path, o = S.shared_folder(spark), t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    S.write_layer(o, path, "run1")
    S.write_layer(o, path, "run2")
    S.write_layer(o.where("o_orderstatus = 'F'"), path, "run2")
    return S.read_layer(spark, path).withColumn("older", lit(S.read_layer(spark, path, "run1").count()))


@query("""SELECT o_custkey::VARCHAR AS processo, 'acordo_' || o_custkey AS alias, '/x/' || o_orderkey AS source_path FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1 AND o_orderstatus = 'F'""")
def published_aliases(spark, d):
    """SNK6: the second publication of a run takes back the aliases of cases that lost their winner."""
    path, o = S.shared_folder(spark), t(spark, d, "orders")
    best = select.best_per_key(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])
    best = best.select(F.col("o_custkey").cast("string").alias("processo"), lit("acordo").alias("snapshot_prefix"), F.concat(lit("/x/"), "o_orderkey").alias("json_path"), "o_orderstatus")
    S.publish_aliases(best, path, "r")
    return S.publish_aliases(best.where("o_orderstatus = 'F'"), path, "r").drop("run_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE 'nada' END AS value, false AS value_is_empty, o_orderkey % 2 = 0 AS value_has_date_like FROM orders")
def raw_field_store(spark, d):
    """SNK2: appended fields carry the flags that they lack."""
    path, o = S.shared_folder(spark), t(spark, d, "orders")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, day()).otherwise("nada").alias("value"))
    S.append_raw_fields(rows.where("o_orderkey % 2 = 0"), path)
    S.append_raw_fields(rows.where("o_orderkey % 2 = 1"), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, true AS found, true AS sized FROM orders")
def source_freshness(spark, d):
    """SRC9: of each row the signature of the file that holds it; a file that isn't there is known as such."""
    name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
    files = S.freshness(spark, f"{d}/orders.parquet").unionByName(S.freshness(spark, f"{d}/orders_not_there.parquet"))
    files = files.select(name.alias("file"), "exists", (F.col("size") > 0).alias("sized"))
    rows = t(spark, d, "orders").select("o_orderkey", F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("of"))
    return rows.join(F.broadcast(files), F.col("of") == F.col("file"), "left").select("o_orderkey", F.coalesce("exists", lit(False)).alias("found"), "sized")  # one row a file


def _landings(spark, d):
    """Two landings of the attempts: the second misses some files, and others have grown."""
    o = t(spark, d, "orders")
    size = F.round("o_totalprice").cast("long")
    files = o.select(F.concat(lit("/x/"), "o_orderkey").alias("path"), lit(True).alias("exists"), F.col("o_orderdate").cast("timestamp").alias("mtime"), size.alias("size"), "o_custkey", "o_orderstatus", "o_orderpriority")
    before = files.where("o_orderstatus <> 'P'").withColumn("size", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("size") - 1).otherwise(F.col("size")))
    return before, files.where("o_orderpriority <> '5-LOW'")


@query("""WITH o AS (SELECT o_orderkey, o_orderstatus = 'P' AS new, o_orderpriority = '5-LOW' AS gone, o_orderpriority = '1-URGENT' AS grown FROM orders)
    SELECT '/x/' || o_orderkey AS path, CASE WHEN new THEN 'added' WHEN gone THEN 'removed' ELSE 'changed' END AS change FROM o WHERE (new AND NOT gone) OR (gone AND NOT new) OR (grown AND NOT new)""")
def changed_files(spark, d):
    """SRC9: what differs between the listings of two landings."""
    from .plans import refresh

    before, now = _landings(spark, d)
    return refresh.changes(before.select("path", "exists", "mtime", "size"), now.select("path", "exists", "mtime", "size"))


@query("""SELECT o_custkey::VARCHAR AS processo, max(round(o_totalprice)::BIGINT) AS largest, count(*) AS attempts FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1""")
def mart_refresh(spark, d):
    """SRC9, JOI1: a mart of cases after a second landing, built anew for the cases of changed files alone; the SQL builds all."""
    from .plans import refresh

    before, now = _landings(spark, d)
    kept = ordered.stored(before), ordered.stored(now)
    cases = lambda df: df.select(F.col("path").alias("json_path"), F.col("o_custkey").cast("string").alias("processo"), "size")
    build = lambda df: df.groupBy("processo").agg(F.max("size").alias("largest"), F.count("*").alias("attempts"))
    mart = ordered.stored(build(cases(kept[0])))
    diff = refresh.changes(*[k.select("path", "exists", "mtime", "size") for k in kept])
    touched = ordered.stored(refresh.touched(diff, *map(cases, kept)))
    return refresh.refreshed(mart, touched, build, [cases(kept[1])])


@query("""SELECT o_orderkey, o_orderstatus, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS gold, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS older FROM orders""")
def published_runs(spark, d):
    """SNK4: a run is read as a whole: one that failed between two layers is not seen, a retry is, and the run before stays."""
    from .plans import publish

    root, o = S.shared_folder(spark), t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "F", "published_gold").otherwise("retained_silver").alias("publication_status"))
    publish.publish({"act": o.where("o_orderstatus = 'O'")}, {}, root, "run1")
    try:
        publish.publish({"act": o, "pt": o.withColumn("x", F.raise_error(lit("a layer fails")))}, {}, root, "run2")
    except Exception as e:
        if "a layer fails" not in str(e):
            raise
    seen = S.read_published(spark, root, "silver/act").count()
    for _ in range(2):
        publish.publish({"act": o}, {}, root, "run2")
    out, gold = S.read_published(spark, root, "silver/act"), S.read_published(spark, root, "gold/act", "run2").count()
    return out.select("o_orderkey", "o_orderstatus", lit(gold).cast("long").alias("gold"), lit(seen).cast("long").alias("older"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'pt' WHEN 1 THEN 'act' WHEN 2 THEN 'memorando' WHEN 3 THEN 'ted' ELSE 'parecer' END AS family,
    CASE o_orderkey % 5 WHEN 0 THEN 'email_outro' WHEN 1 THEN 'act_final' WHEN 2 THEN 'memorando' WHEN 3 THEN 'ted' ELSE 'parecer_final' END AS doc_class, CASE o_orderkey % 5 WHEN 1 THEN lpad(o_custkey::VARCHAR, 8, '0') || '/2021' WHEN 4 THEN o_custkey::VARCHAR END AS number FROM orders""")
def family_dispatch(spark, d):
    """The registry: orders as captures of the four families and of a fifth that is registered here, each to its own record."""
    from .functions.rules import Rule
    from .operators.families import FamilySpec
    from .plans import publish

    k = F.col("o_orderkey") % 5
    who = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    text = (
        F.when(k == 0, lit("PLANO DE TRABALHO")).when(k == 1, F.concat(lit("ACORDO DE COOPERAÇÃO TÉCNICA Nº "), who, lit("/2021 que entre si celebram o Ministério da Defesa e a Fundacao X, para os fins que especifica.")))
        .when(k == 2, lit("Memorando de Entendimentos")).when(k == 3, lit("Termo de Execução Descentralizada")).otherwise(F.concat(lit("Parecer Jurídico "), F.col("o_custkey").cast("string")))
    )
    asked = _of({0: "pt", 1: "act", 2: "memorando", 3: "TED", 4: "parecer"}, k)
    bronze = spread(spark, d, "orders").select("o_orderkey", lit("").alias("processo"), asked.alias("requested_type"), lit("").alias("title"), text.alias("text"), lit("").alias("chosen"), lit("/p").alias("json_path"), F.col("o_orderkey").alias("row_idx"))
    numbered = lambda df: df.withColumn("numero_acordo", F.regexp_extract("text", r"(\d+)", 1))
    registry = publish.registry().add(FamilySpec("parecer", "PARECER", ("parecer_final",), (Rule(("parecer juridico",), "parecer_final", "cabecalho_parecer"),), numbered))
    out = None
    for key, df in registry.dispatch(bronze).items():
        number = F.col("numero_acordo") if "numero_acordo" in df.columns else lit(None).cast("string")
        rows = df.where("accepted").select("o_orderkey", lit(key).alias("family"), "doc_class", number.alias("number"))
        out = rows if out is None else out.union(rows)
    return out


@query("""SELECT p_partkey, min(c_custkey) AS profile FROM (SELECT p_partkey, p_partkey || ' segue ' || p_name || ' fim' AS x, p_name FROM part) p JOIN (SELECT min(p_partkey) AS c_custkey, lower(p_name) AS pattern FROM part GROUP BY 2) c ON contains(lower(p.x), c.pattern) GROUP BY 1""")
def part_profiles(spark, d):
    """CLS14, JOI5: as many profiles as there are names, each text's first one, by an equi-join on pieces."""
    p = t(spark, d, "part")
    profiles = p.select(F.col("p_partkey").alias("ordinal"), F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("key"), F.col("p_name").alias("pattern"), lit(True).alias("enabled"))
    texts = p.select("p_partkey", F.concat_ws(" ", F.col("p_partkey").cast("string"), lit("segue"), F.upper("p_name"), lit("fim")).alias("x"))
    return C.profile_of(texts, profiles, "x").select("p_partkey", F.col("profile").cast("long").alias("profile"))


@query("""SELECT o_orderkey, o_orderpriority AS priority, 'relação ' || o_custkey AS title, o_orderstatus AS unknown FROM orders""")
def snapshot_files(spark, d):
    """SRC3, SRC6, SNK3: orders written as JSON objects, read as snapshots with what no schema names, and landed."""
    path = S.shared_folder(spark)
    broken = F.decode(F.encode(F.concat(lit("relação "), F.col("o_custkey").cast("string")), "UTF-8"), "ISO-8859-1")
    o = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("processo"), F.col("o_orderpriority").alias("documento"), F.struct(broken.alias("title")).alias("snapshot"), F.col("o_orderstatus").alias("new_key"))
    rows = o.select(F.to_json(F.struct("processo", "documento", "snapshot", "new_key")).alias("value"))
    good, _ = S.snapshots_of(rows.withColumn("json_path", F.concat(lit(path), lit("/"), F.sha1("value"))))
    out = S.landing(good)
    return out.select(F.col("processo").cast("long").alias("o_orderkey"), F.col("documento").alias("priority"), "snapshot.title", S.payload_value(F.col("payload"), "$.new_key").alias("unknown"))


@query("""WITH p AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderkey % 3 DESC, length(o_orderpriority) DESC, o_orderkey) = 1),
    m AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1), h AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1)
    SELECT c_custkey::VARCHAR AS processo, coalesce(o_orderstatus = 'F', false) AS pt_gold, CASE WHEN o_orderstatus = 'F' THEN 'gold' WHEN o_orderkey IS NOT NULL THEN 'silver_only' ELSE 'not_found' END AS pt_quality,
      coalesce(o_orderdate::DATE || '..' || (o_orderdate::DATE + to_months(12))::DATE, '') AS pt_vigencia, m.k IS NOT NULL AS memorando_gold, coalesce('/m/' || m.k, '') AS memorando_json_path, h.k IS NOT NULL AS ted_gold,
      CASE WHEN h.k IS NULL THEN 'not_found' ELSE 'gold' END AS ted_quality, coalesce('obj ' || h.k, '') AS ted_objeto, CASE WHEN o_orderstatus = 'F' OR m.k IS NOT NULL OR h.k IS NOT NULL THEN 'medium' ELSE 'low' END AS quality_status
    FROM customer LEFT JOIN p ON p.o_custkey = c_custkey LEFT JOIN m ON m.o_custkey = c_custkey LEFT JOIN h ON h.o_custkey = c_custkey""")
def overview_families(spark, d):
    """JOI1, JOI4, PRJ4, CLS18: the mart of cases whose plans, memoranda and decentralised terms are there, and no agreement."""
    from .plans import publish

    previews = t(spark, d, "customer").select(F.col("c_custkey").alias("row_idx"), F.col("c_custkey").cast("string").alias("processo"), F.col("c_name").alias("parceiro"), lit("").alias("vigencia"), lit("").alias("numero_act"), lit("").alias("objeto"))
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("row_idx"), F.col("o_custkey").cast("string").alias("processo"), F.when(F.col("o_orderstatus") == "F", "published_gold").otherwise("retained_silver").alias("publication_status"))
    plans = o.select("processo", "row_idx", "publication_status", F.concat(lit("/x/"), "o_orderkey").alias("json_path"), F.col("day").alias("vigencia_inicio"), F.add_months("day", 12).alias("vigencia_fim"), (F.col("o_orderkey") % 3).alias("captured_focus_fields"), F.col("o_orderpriority").alias("objeto"))
    memos = o.where("o_orderpriority = '1-URGENT'").select("processo", "row_idx", F.concat(lit("/m/"), "o_orderkey").alias("json_path"))
    terms = o.where("o_orderpriority = '2-HIGH'").select("processo", "row_idx", F.concat(lit("C:\\t\\"), "o_orderkey", lit(".json")).alias("json_path"))
    payload = o.select(F.concat(lit("/z/"), "o_orderkey", lit(".json")).alias("json_path"), F.concat(lit("obj "), "o_orderkey").alias("objeto"), lit("1").alias("valor_global"), lit("ativa").alias("situacao"), lit("AM").alias("uf"), "row_idx")
    acts = _attempts(spark, d).limit(0).withColumns({"numero_acordo": F.col("json_path"), "data_inicio_vigencia": F.current_date(), "data_fim_vigencia": F.current_date(), "orgao_convenente": lit(""), "validation_warning": lit("")})
    status = o.limit(0).select("row_idx", "processo", "publication_status", lit("").alias("doc_class"), lit("").alias("classification_reason"))
    searched = o.limit(0).select("row_idx", "processo", lit("").alias("selection_reason"))
    out = publish.overview(previews, plans, acts, memos, terms, status, searched, payload)
    return out.select("processo", "pt_gold", "pt_quality", "pt_vigencia", "memorando_gold", "memorando_json_path", "ted_gold", "ted_quality", "ted_objeto", "quality_status")


_MESSAGES = {
    0: "Abrindo processo {}", 1: "Processo {}: fechando aba e voltando", 2: "clicando Pesquisar no Processo para Plano de Trabalho.", 3: "filtro ja estava aberto para Memorando.", 4: "iniciando busca do documento 'Acordo de Cooperacao Tecnica'",
    5: "Processo {}: TED termo 'a' sem resultado no filtro", 6: "Processo {}: PT termo 'b' falhou no filtro", 7: "Processo {}: nenhum candidato canonico de ACT consolidado no filtro; tentando fallback pela arvore", 8: "Fallback arvore TED: nada", 9: "restaurando contexto base do processo MEMORANDO", 10: "Processo {}: outra coisa",
}


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (0, 1, 5, 6, 7) THEN lpad(o_custkey::VARCHAR, 5, '0') || '.000001/2021-01' END AS case_number, CASE o_orderkey % 11 WHEN 2 THEN 'PT' WHEN 3 THEN 'MEMORANDO' WHEN 4 THEN 'ACT' WHEN 5 THEN 'TED' WHEN 6 THEN 'PT' WHEN 7 THEN 'ACT' WHEN 8 THEN 'TED' WHEN 9 THEN 'MEMORANDO' END AS doc,
    CASE o_orderkey % 11 WHEN 5 THEN 'none' WHEN 6 THEN 'fail' WHEN 7 THEN 'fall' WHEN 9 THEN 'reload' END AS event FROM orders""")
def log_messages(spark, d):
    """LOG6: what each of the ten messages says, and one that says nothing."""
    case = case_number(F.col("o_custkey"))
    o = spread(spark, d, "orders").select("o_orderkey", F.replace(_of(_MESSAGES, F.col("o_orderkey") % 11), lit("{}"), case).alias("message"))
    o = runlog.features(o)
    number = F.coalesce(*[F.nullif(c, lit("")) for c in ("open_case", "close_case", "none_case", "fail_case", "fall_case")])
    doc = F.coalesce("click", "filter_open", "search", "none_doc", "fail_doc", "fall_doc", "fall_line", F.when(F.col("reload"), F.col("reload_doc")))
    event = F.when(F.col("none_doc").isNotNull(), "none").when(F.col("fail_doc").isNotNull(), "fail").when(F.col("fall_doc").isNotNull(), "fall").when(F.col("reload"), "reload")
    return o.select("o_orderkey", number.alias("case_number"), doc.alias("doc"), event.alias("event"))


@query("SELECT c_custkey::VARCHAR AS processo, c_name || ' SA' AS parceiro, '' AS objeto FROM customer")
def preview_export(spark, d):
    """SNK3: previews written with cleaned cells and read again; an empty table writes nothing."""
    path = S.shared_folder(spark)
    c = t(spark, d, "customer").select(F.concat(lit(" "), F.col("c_custkey").cast("string")).alias("processo"), F.concat("c_name", lit("\n  SA ")).alias("parceiro"), lit(None).cast("string").alias("objeto"))
    columns = ["processo", "parceiro", "objeto"]
    if not S.write_previews(c, path, columns) or S.write_previews(c.limit(0), f"{path}-none", columns):
        raise ValueError("an empty table was written, or a filled one was not")
    return S.read_csv(spark, path, columns).drop("row_idx")


@query("SELECT event_type AS span, count(*) AS n, round(sum(value), 2)::DOUBLE AS total FROM events GROUP BY 1")
def span_export(spark, d):
    """SNK5: totals written as JSON lines and read again."""
    path = S.shared_folder(spark)
    e = t(spark, d, "events").groupBy(F.col("event_type").alias("span")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).cast("double").alias("total"))
    S.write_spans(e, path)
    return S.read_ndjson(spark, path, "span string, n long, total double")


@query("SELECT event_id, event_type AS kind FROM events WHERE event_id % 4 <> 0")
def ndjson_round_trip(spark, d):
    """SRC4: objects a line, some cut short and some blank, which are skipped."""
    path = S.shared_folder(spark)
    line = F.to_json(F.struct("event_id", F.col("event_type").alias("kind")))
    e = t(spark, d, "events").select(F.when(F.col("event_id") % 8 == 0, " ").when(F.col("event_id") % 4 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value"))
    e.write.text(path)
    return S.read_ndjson(spark, path, "event_id long, kind string")


@query("SELECT o_orderkey, 'AÇÃO ' || o_orderkey AS title, 'relação ' || o_custkey AS text, 'célula' AS cell, 'pt_' || o_custkey AS name FROM orders")
def landed_snapshots(spark, d):
    """SRC7, TXT2, TXT3: double-encoded payloads are repaired as they land, in every field."""
    o = t(spark, d, "orders")
    broken = lambda x: F.decode(F.encode(x, "UTF-8"), "ISO-8859-1")
    snapshot = F.struct(broken(F.concat(lit("AÇÃO "), "o_orderkey")).alias("title"), broken(broken(F.concat(lit("relação "), "o_custkey"))).alias("text"), F.array(F.struct(F.array(F.array(broken(lit("célula")))).alias("rows"))).alias("tables"))
    df = S.landing(o.select("o_orderkey", lit("pt").alias("document_type"), F.col("o_custkey").cast("string").alias("processo"), snapshot.alias("snapshot")))
    return df.select("o_orderkey", "snapshot.title", "snapshot.text", F.col("snapshot.tables")[0]["rows"][0][0].alias("cell"), "name")
