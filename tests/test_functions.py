"""Text, date and rule functions on small invented values."""

import datetime as dt
import unicodedata

from pyspark.sql import functions as F

from docketry.functions import dates as D
from docketry.functions import text as X
from docketry.functions.rules import Rule, Weight, first_match, marker_score, term_score


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_spaces_and_fold(spark):
    assert one(spark, X.clean_spaces(F.col("t")), t="  a  b\n\tc ") == "a b c"
    assert one(spark, X.fold(F.col("t")), t="  AÇÃO nº 1°  ") == "acao no 1o"
    assert one(spark, X.fold(F.col("t"), ""), t="1°") == "1"
    assert one(spark, X.fold(F.col("t")), t="Őrség ŠKODA 1ª ＡＢＣ n\u0303 Ǻ ệ") == "orseg skoda 1a abc n a e"
    assert one(spark, X.fold_upper(F.col("t")), t="Órgão") == "ORGAO"


def test_fold_equals_decomposition(spark, data):
    """Over all characters of the documents, and of every folded block, as unicodedata has it."""
    def plain(x):
        return "".join(y for y in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(y)).lower()

    text = {x for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect() for x in r["text"] or ""}
    every = sorted(x for x in text | set(map(chr, X.FOLDED)) if not x.isspace() and x not in "º°" and len(x.lower()) == 1 and len(plain(x)) <= 1 and unicodedata.category(x) != "Cn")
    got = spark.createDataFrame([(x,) for x in every], "x string").select("x", X.fold(F.concat(F.lit("a"), "x", F.lit("z"))).alias("f")).collect()
    assert {r["x"]: r["f"] for r in got} == {x: f"a{plain(x)}z" for x in every}


def test_repair(spark):
    broken = "Cooperação técnica".encode().decode("latin1")
    twice = broken.encode().decode("latin1")
    for t in (broken, twice):
        assert one(spark, X.repair_text(F.col("t")), t=t) == "Cooperação técnica"
    assert one(spark, X.repair_text(F.col("t")), t="Ã sozinho") == "Ã sozinho"
    for t in ("2020 – “fim” €", "relação"):
        assert one(spark, X.repair_text(F.col("t")), t=t.encode().decode("cp1252", "ignore") if "–" not in t else "2020 – fim".encode().decode("cp1252")) == ("2020 – fim" if "–" in t else t)
    df = spark.createDataFrame([(("Ã©", ["Ã£o", None, "relaÃ\u0083Â§Ã\u0083Â£o", "â€“"], {"k": "Ã©"}), 1), (None, 2)], "p struct<a:string,b:array<string>,c:map<string,string>>, n int")
    out = df.select(X.repair_payload(F.col("p"), df.schema["p"].dataType).alias("p")).collect()
    assert out[0]["p"].asDict() == {"a": "é", "b": ["ão", None, "relação", "–"], "c": {"k": "é"}} and out[1]["p"] is None


def test_prepare(spark):
    assert one(spark, X.prepare_text(F.col("t")), t="da UniãoFederal em2024\r\n\r\n\r\n\r\nﬁm – ok") == "da União Federal em 2024\n\nfim - ok"
    assert one(spark, X.prepare_plan_text(F.col("t")), t="Meta1 e Fase2") == "Meta 1 e Fase 2"


def test_noise(spark):
    text = "Texto. Criado por X. Documento assinado eletronicamente por Y"
    assert one(spark, X.trim_noise(F.col("t")), t=text).startswith("Texto. Criado por X.")
    assert one(spark, X.trim_noise(F.col("t"), first_only=False), t=text) == "Texto."
    assert one(spark, X.has_content(F.col("t")), t="abcdefgh") and not one(spark, X.has_content(F.col("t")), t="abc 12345678")
    assert one(spark, X.is_placeholder(F.col("t")), t="Clique aqui para visualizar o conteúdo deste documento")


def test_names_and_keys(spark):
    assert one(spark, X.safe_name(F.col("t")), t="__a/b c:ç.1") == "a_b_c_ç.1"
    assert one(spark, X.safe_name(F.col("t")), t="///") == "sem_valor"
    assert one(spark, X.document_key(F.col("t"), [F.col("t")], ("id",)), t="http://x/y?z=1&id=77") == "77"
    assert one(spark, X.process_parts(F.col("t")), t="12345.678901/2023-45").asDict() == {"digits": "12345678901202345", "year": 2023}
    assert one(spark, X.agreement_number(F.col("t")), t="Nº 12/2020.") == "12/2020"
    assert one(spark, X.excerpt(F.col("t"), 10), t="a" * 20) == "a" * 7 + "..."


def test_cells(spark):
    cells = F.array(*[F.lit(x) for x in ("12345.678901/2023-45", "17", "x")])
    assert one(spark, X.sequence_cell(cells, F.lit("12345.678901/2023-45"))) == "17"
    cells = F.array(F.lit("17"), F.lit("a: b\nc: d"), F.lit("Parceiro: Z"))
    assert one(spark, X.annotation_cell(cells)) == "Parceiro: Z"


def test_casts(spark):
    values = [("sim", True), ("TRUE", True), ("0", False), (None, False), ("yes ", True)]
    for v, want in values:
        assert one(spark, X.to_bool(F.lit(v).cast("string"))) is want
    assert one(spark, X.to_int(F.lit("x"))) == 0 and one(spark, X.to_int(F.lit(" 7 "))) == 7
    for v, want in (("1,5", 1.5), ("1.500.000,25", 1500000.25), ("abc", 0.0), ("1.5d", 0.0), ("2.5", 2.5)):
        assert one(spark, X.to_float(F.lit(v))) == want


def test_dates(spark):
    for t, want in (("5/3/2021", dt.date(2021, 3, 5)), ("5.3.2021", dt.date(2021, 3, 5)), ("5-3-2021", dt.date(2021, 3, 5)), ("5 de março de 2021", dt.date(2021, 3, 5)), ("31/02/2021", None), ("5/3-2021", None), ("", None)):
        assert one(spark, D.parse_date(F.lit(t))) == want, t
    for t, last, want in (("dez/2025", False, dt.date(2025, 12, 1)), ("abr/25", True, dt.date(2025, 4, 30)), ("jun2020", False, dt.date(2020, 6, 1)), ("02/2024", True, dt.date(2024, 2, 29)), ("ł5/o3/2021", False, dt.date(2021, 3, 25)), ("1º de maio de 2020", False, dt.date(2020, 5, 1))):
        assert one(spark, D.parse_plan_date(F.lit(t), last)) == want, t
    assert one(spark, D.ocr_digits(F.lit("ł5"))) == "25" and one(spark, D.ocr_digits(F.lit("123"), 2)) is None


def test_durations(spark):
    start = F.lit(dt.date(2024, 2, 29))
    assert one(spark, D.add_duration(start, F.lit(12), F.lit("meses"))) == dt.date(2025, 2, 27)
    assert one(spark, D.add_duration(start, F.lit(1), F.lit("ano"), False)) == dt.date(2025, 2, 28)
    assert one(spark, D.add_duration(start, F.lit(1), F.lit("semana"))) is None
    assert one(spark, D.number_word(F.lit("Três"))) == 3 and one(spark, D.number_word(F.lit("60"))) == 60


def test_signatures(spark):
    text = "Documento assinado eletronicamente por A em 02/03/2020. Documento assinado eletronicamente por B em 21/12/2021."
    assert one(spark, D.signature_date(F.lit(text))) == dt.date(2021, 12, 21)
    assert one(spark, D.signature_date(F.lit("Assinado eletronicamente por A, em 02/03/2020. Assinado por B em 01/01/2019"), "first")) == dt.date(2020, 3, 2)
    assert one(spark, D.explicit_period(F.lit("de 1/1/2020 a 31/12/2021"))).asDict() == {"start": dt.date(2020, 1, 1), "end": dt.date(2021, 12, 31)}


def test_validity(spark):
    def v(section, text=""):
        r = one(spark, D.validity(F.lit(section), F.lit(text)))
        return r["start"], r["end"], r["source"], r["warning"]

    signed = "Documento assinado eletronicamente por A em 20/11/2021. Documento assinado eletronicamente por B em 21/12/2021."
    assert v("vigora por 5 (cinco) anos a partir da última assinatura", signed) == (dt.date(2021, 12, 21), dt.date(2026, 12, 20), "clausula_vigencia_ultima_assinatura", "")
    assert v("por 12 meses, a contar de 10/01/2020") == (dt.date(2020, 1, 10), dt.date(2021, 1, 9), "clausula_vigencia_data_inicial_explicita", "")
    assert v("na data de sua assinatura")[3] == "vigencia_dependente_assinatura_sem_data"
    assert v("da publicação no diário")[3] == "vigencia_dependente_publicacao_sem_data"
    assert v("")[:3] == (None, None, "")


def test_plan_period(spark):
    """Each case (text, labels, dates of the labels that were parsed before) with its start, end and source."""
    far = "prazo de 3 anos " + "x " * 70 + "apos a assinatura. Assinado por A em 01/01/2020"
    day = dt.date
    cases = [
        (("periodo de execucao de 1 de janeiro de 2020 a 31 de dezembro de 2021",), (day(2020, 1, 1), day(2021, 12, 31), "direct_label")),
        (("INICIO(MES/ANO): 03/2020 TERMINO(MES/ANO): 02/2022",), (day(2020, 3, 1), day(2022, 2, 28), "direct_label")),
        (("prazo de 60 (sessenta) meses, a partir da data de sua assinatura. Assinado eletronicamente por A, em 10/05/2021",), (day(2021, 5, 10), day(2026, 5, 10), "derived_from_signature")),
        (("sem datas", "inserir previsao", "x"), (None, None, "unresolved_noise")),
        (("a partir da assinatura",), (None, None, "unresolved_relative")),
        (("metas e atividades",), (None, None, "missing_period")),
        # pairs of dates without a period's label are no period; labels whose dates were parsed before count without their text
        (("Visitas feitas de 01/01/2010 a 31/12/2010", "01/03/2021", "28/02/2023"), (day(2021, 3, 1), day(2023, 2, 28), "direct_label")),
        (("O prazo de prestacao de contas venceu em 05/05/2015 e 06/06/2016",), (None, None, "missing_period")),
        (("x", None, None, "2020-01-01", "2021-01-01"), (day(2020, 1, 1), day(2021, 1, 1), "direct_label")),
        (("Brasilia, 1 de fevereiro de 2020", "na data da assinatura", "12 meses"), (day(2020, 2, 1), day(2021, 2, 1), "derived_from_signature")),
        (("inicio imediatamente apos a assinatura e fim 6 meses apos a assinatura", None, None, "2020-01-31"), (day(2020, 1, 31), day(2020, 7, 31), "derived_from_signature")),
        (("periodo de execucao: 10/2022 ate 01/2020 e 5 meses", "na data da assinatura"), (None, None, "unresolved_relative")),
        (("previsao de inicio e termino: jan/2022 - dez/2023",), (day(2022, 1, 1), day(2023, 12, 31), "direct_label")),
        ((far,), (None, None, "unresolved_relative")),
        (("Assinado em 99/99/2020, assinado por B em l2/O5/2O2l. prazo de um ano a partir da assinatura",), (day(2021, 5, 12), day(2022, 5, 12), "derived_from_signature")),
    ]
    df = spark.createDataFrame([(i, *c, *[None] * (5 - len(c))) for i, (c, _) in enumerate(cases)], "i int, text string, a string, b string, c string, d string")
    df = D.staged(df, D.plan_period_parts(*map(F.col, ("text", "a", "b", "c", "d"))), "p", D.plan_period_ladder)
    got = {r["i"]: (r["p"]["start"], r["p"]["end"], r["p"]["source"]) for r in df.collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
    r = one(spark, D.plan_period(F.lit("INICIO: 03/2020 TERMINO: 02/2022"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert (r["start_text"], r["end_text"]) == ("03/2020", "02/2022")


def test_rules(spark):
    rules = [Rule(("aa", "bb"), "A", "first"), Rule(("b",), "B", "second")]
    for t, want in (("xbbx", "A"), ("b", "B"), ("c", "outro")):
        assert one(spark, first_match(F.lit(t), rules))["label"] == want
    assert one(spark, marker_score(F.lit("x y"), [Weight(("x", "y"), 5), Weight(("x", "y"), -1, each=True)])) == 3
    assert one(spark, term_score(F.lit("Plano de TRABALHO (minuta)"), ["plano de trabalho"], [Weight(("minuta",), -30)])) == 17 + 40 - 30
