"""Odd and larger inputs of the agreements' and plans' queries, and how often their texts are read."""

from pyspark.sql import functions as F
from test_findings_r03 import same, times

from docketry import catalog, catalog_records
from docketry.functions import text as X


def test_agreements_of_cases_with_six_digits(spark, tmp_path):
    """A cited case's number has the first five digits of its key; agreements of two keys that share them are two cases."""
    orders = "SELECT i::BIGINT AS o_orderkey, (123456 + i % 3)::BIGINT AS o_custkey, TIMESTAMP '1995-01-31' + to_days(i::INT) AS o_orderdate FROM range(9) r(i)"
    got, want = same(spark, tmp_path, "agreement_records", orders=orders)
    assert got == want


def test_texts_without_glued_words_are_not_split(spark):
    """The patterns of splitting are tried only on texts that one of them may change, and on each of these."""
    glued = ["daFundação", "em2021", "Sala12345", "PORINTERMEDIO", "parooperação", "ParaOperação de", "porıntermédio", "Meta1", "2Fase", "AÇÃO9", "até5", "12atividade", "1a Meta", "Ação de 2021", "a Fundação É", "x2021y", ""]
    df = spark.createDataFrame([(x,) for x in glued], "x string")
    for patterns, found in ((X.GLUED_AGREEMENT, X.MAY_BE_GLUED), ([*X.GLUED_AGREEMENT, *X.GLUED_PLAN], X.MAY_BE_GLUED_PLAN)):
        always = X.prepare_text(F.col("x"), patterns, "")
        rows = df.select("x", always.alias("a"), X.prepare_text(F.col("x"), patterns, found).alias("b"), F.col("x").rlike(found).alias("f")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows]
        assert not any(r["f"] for r in rows if r["x"] in ("a Fundação É", "Ação de 2021", ""))


def test_long_texts_are_folded_as_short_ones(spark):
    """Of long texts each different letter is replaced at once, if they are few; the result is that of short ones."""
    parts = ["Ação  É\tdaº 5°", "ΟΔΟΣ Σας", "ÅK İı ẞ", "😀 𐐀 x", "áàâãäåæçèéêëìíîïñòóôõö", "漢字かな", "plain TEXT\nof letters", "a b  c"]
    df = spark.createDataFrame([(x,) for x in parts], "x string")
    for degree in ("o", ""):
        row = df.select("x", X.fold(F.col("x"), degree).alias("short"), X.fold(F.concat("x", F.repeat(F.lit(" x"), X.LONG)), degree).alias("long")).collect()
        for r in row:
            assert r["long"] == r["short"] + " x" * X.LONG, r["x"]
    assert X.LONG == 1000 and X.MOST_REPLACED == 6


def test_openings_are_searched_for_footers_in_any_case(spark):
    from docketry.operators import classify as C

    texts = [*X.TAIL_MARKERS, *map(str.upper, X.TAIL_MARKERS), "xcriado por y", "crIADO POR x", "criado", "Código Verificador", "criadı por ", ""]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select("x", F.col("x").rlike(C.TAIL_FOUND).alias("f"), X.contains_any(F.lower("x"), X.TAIL_MARKERS).alias("w"))
    assert all(r["f"] == r["w"] for r in df.collect())


def test_agreements_are_stored_without_working_columns(spark, monkeypatch):
    """What classification worked on is not stored for the choice of the canonical row, and the body is not folded again."""
    from docketry.operators import extract as E
    from docketry.operators import ordered
    from docketry.plans import publish

    bronze = spark.createDataFrame([("1", "act", "", "Acordo de Cooperação Técnica que entre si celebram", "", "/p", 1)], "processo string, requested_type string, title string, text string, chosen string, json_path string, row_idx int")
    seen, real = [], ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df: seen.append(df.columns) or real(df))
    assert publish.agreements(bronze).count() == 1
    assert not set(publish.WORK_COLUMNS) & set(seen[0])
    # one use of the table for each of: the title, a body's beginning, the clause's length and dates, the party
    gated = spark.createDataFrame([("act_final", "a", "a", "t", "a")], "doc_class string, _body string, text string, title string, folded string")
    assert times(E.agreement_record(gated).select("orgao_convenente"), "translate(") < times(E.agreement_record(gated.drop("folded")).select("orgao_convenente"), "translate(")


def test_headings_are_looked_for_where_their_words_are(spark):
    """Sections and labels with the folded text at hand are those without it."""
    from docketry.operators import extract as E

    texts = ["1. Cláusula nona - do prazo e vigência\nx\nCláusula dez", "CLAUSULA DA VIGENCIA x", "PRAZO DE VIGÊNCIA: 2", "vıgêncıa: y", "vigência: z", "Cláusula 1 do objeto\na", "DO OBJETO b", "Objeto: c", "gestora: Ana Lima\nſuplente: Rui Melo\nUnıdade: Norte", "Substituta: Eva\nUnidade Responsável: Sul", "Obrıgações dos partícıpes: d\nObservações", "ATRIBUICOES e", "Plano de Ação f", "metodologia e  intervenção g\nMeta 1", "fase b h", "", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string").withColumn("f", X.fold(F.col("x")))
    x, f = F.col("x"), F.col("f")
    both = [
        (E.section(x, E.VALIDITY_HEADS), E.section(x, E.VALIDITY_HEADS, folded=f, words=E.VALIDITY_WORDS)), (E.subject(x), E.subject(x, f)), (E.duties(x), E.duties(x, f)), (E.execution_section(x), E.execution_section(x, f)),
        *[(E.named_value(x, labels), E.named_value(x, labels, folded=f)) for labels in (E.HOLDER, E.DEPUTY, [*E.UNIT, "unidade"])],
    ]
    for a, b in both:
        rows = df.select("x", a.alias("a"), b.alias("b")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows]
        assert any(r["a"] is not None for r in rows)
