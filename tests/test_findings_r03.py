"""Odd and larger inputs of registered queries, against their SQL."""

import duckdb

from docketry import catalog, catalog_records

QUERIES, ORACLES = catalog.QUERIES | catalog_records.QUERIES, catalog.ORACLES | catalog_records.ORACLES


def same(spark, folder, name, **tables):
    """The query's rows and its SQL's, over tables given as SQL."""
    con = duckdb.connect()
    for table, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [x[0] for x in want.description]
    return sorted(map(repr, map(tuple, QUERIES[name](spark, str(folder)).select(*columns).collect()))), sorted(map(repr, want.fetchall()))


def test_titles_read_three_references(spark, tmp_path):
    titles = ["a &amp;amp; b", "x &quot;y&quot;", "cut&amp", "&lt;b&gt; &amp;lt;"]
    pages = " UNION ALL ".join(f"SELECT {i}::BIGINT AS page_id, '<html><title>{x}</title><a href=u>v</a></html>' AS html" for i, x in enumerate(titles))
    got, want = same(spark, tmp_path, "html_snapshot", pages=pages)
    assert got == want


ORDERS = "SELECT i::BIGINT AS o_orderkey, (99995 + 20000 * i)::BIGINT AS o_custkey FROM range(33) r(i)"


def test_keys_of_six_digits(spark, tmp_path):
    for name in ("case_cells", "log_messages"):
        got, want = same(spark, tmp_path, name, orders=ORDERS)
        assert got == want, name


def test_numbers_of_four_digits_are_no_period(spark, tmp_path):
    lines = "SELECT (i // 3)::BIGINT AS l_orderkey, (i * 700)::BIGINT AS l_partkey, (1990 + i)::BIGINT AS l_suppkey, (i % 3)::INT AS l_linenumber, TIMESTAMP '1998-01-01' + to_days(i::INT) AS l_shipdate FROM range(60) r(i)"
    got, want = same(spark, tmp_path, "pack_explode", lineitem=lines)
    assert got == want
    from pyspark.sql import functions as F

    from docketry.functions import dates as D

    parts = {"1998-03": True, "exercício fiscal 2021": True, "2o sem 2020": True, "de 01/02/2020 até 2021": True, "marco": True, "sala 2021": False, "sala 12345 ": False, "31": False}
    df = spark.createDataFrame([(x,) for x in parts], "x string").select("x", D.is_period_token(F.col("x")))
    assert {r[0]: r[1] for r in df.collect()} == parts


def test_profiles_of_one_pattern_are_one(spark, tmp_path):
    from docketry.operators import classify as C

    profiles = spark.createDataFrame([(i, f"k{i:04}", ["Alfa", "BETA", "ação"][i % 3], True) for i in range(600)], "ordinal int, key string, pattern string, enabled boolean")
    texts = spark.createDataFrame([("x alfa",), ("beta acao",), ("nada",), (None,)], "x string")
    out = C.profile_of(texts, profiles, "x")
    assert {r["x"]: r["profile"] for r in out.collect()} == {"x alfa": "k0000", "beta acao": "k0001", "nada": None, None: None}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_openings_of_long_texts(spark):
    from pyspark.sql import functions as F

    from docketry.functions import text as X
    from docketry.operators import classify as C

    filler = "Texto daFundação em2021 e mais\r\n\n\n\n  palavras\t soltas. "
    texts = ["", filler, filler * 400, " " * 9000 + filler * 400, filler * 60 + "Criado por X " + filler * 400, filler * 20 + "Criado por X " + filler * 400 + "Documento assinado eletronicamente", "a" * 4195 + " criado por " + "b" * 9000, "c" * 6300, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumns({"title": F.lit("T"), "chosen": F.lit(None).cast("string")})
    whole = X.trim_noise(X.prepare_text(F.coalesce("text", F.lit(""))))
    out = C.blobs(df).select("i", "body_opening", X.fold(X.window(whole, X.OPENING)).alias("o"), "folded", X.fold(whole).alias("f"), "header", F.concat_ws(" ", F.lit("t"), F.nullif(X.fold(X.window(whole, X.HEADER)), F.lit(""))).alias("h"))
    for r in out.collect():
        assert (r["body_opening"], r["folded"], r["header"]) == (r["o"], r["f"], r["h"]), r["i"]
    # a long text whose opening holds no footer is not prepared beyond it
    assert C.READ < 2 * X.OPENING


def times(df, word):
    return df._jdf.queryExecution().optimizedPlan().toString().count(word)


def test_values_are_computed_once(spark):
    from pyspark.sql import functions as F

    from docketry.operators import extract as E

    df = spark.createDataFrame([("x: Norte sul leste",), (" ",), (None,)], "x string")
    found = F.regexp_extract("x", r"(\w.*)", 1)
    for one, want in ((E.filled(found), ["x: Norte sul leste", None, None]), (E.content(found), ["x: Norte sul leste", None, None]), (E.answer(F.nullif(found, F.lit("")), "s")["value"], ["x: Norte sul leste", None, None])):
        out = df.select(F.coalesce(F.lit(None).cast("string"), one).alias("v"))
        assert [r[0] for r in out.collect()] == want
    for one in (E.filled(found), E.content(found)):
        assert times(df.select(F.coalesce(F.col("x"), one).alias("v")), "regexp_extract(") == 1


def test_goals_share_their_section(spark):
    """The execution section of a plan is looked for once, for goals and actions together."""
    from docketry.operators import extract as E

    df = catalog_records.goal_fragments(spark, "/root/testdata/sf0.001")
    heads = len(E.EXECUTION_HEADS) + 1
    assert times(df, "regexp_extract(") == heads


def test_words_are_no_numbers_without_a_unit(spark):
    from pyspark.sql import functions as F

    from docketry.functions import dates as D

    words = {"12": 12, " 7 ": 7, "+3": 3, "\t5\t": 5, "doze": None, "Três": 3, "1.5": None, "99999999999": None, "": None}
    df = spark.createDataFrame([(x,) for x in words], "x string").select("x", D.number_word(F.col("x")).alias("n"))
    assert {r[0]: r[1] for r in df.collect()} == words
    assert "RLIKE" in df._jdf.queryExecution().optimizedPlan().toString()


def test_plans_of_one_case_are_dealt_over_tasks(spark):
    """Rows after the previews' join do not stay in the tasks of their cases."""
    from pyspark.sql import functions as F

    from docketry.operators import records

    bronze = spark.range(400).selectExpr("id AS row_idx", "'1' AS processo", "'Plano de trabalho' AS text", "'' AS title", "'' AS chosen", "'/p' AS json_path")
    bronze = bronze.withColumns({"tables": F.lit(None).cast("array<struct<rows:array<array<string>>>>"), "prazos": F.lit(None).cast("struct<status:string,inicio_data:string,inicio_raw:string,termino_data:string,termino_raw:string>")})
    previews = spark.createDataFrame([(1, "1", "a", "b", "c", "d")], "row_idx int, processo string, parceiro string, vigencia string, objeto string, numero_act string")
    parts = records.work_plan(bronze, previews).withColumn("_p", F.spark_partition_id()).groupBy("_p").count().collect()
    assert sum(r["count"] for r in parts) == 400 and len(parts) >= 8


def test_fold_and_blanks_at_borders(spark):
    from pyspark.sql import functions as F

    from docketry.functions import text as X

    texts = {"a  b": "a b", " a b ": "a b", "a  b": "a b", "É\tE": "e e", "X Y": "x y", " ": "", "a \n": "a", "ſK": "sk", None: None}
    df = spark.createDataFrame([(x,) for x in texts], "x string").select("x", X.fold(F.col("x")).alias("f"))
    assert {r[0]: r[1] for r in df.collect()} == texts


def test_messages_are_read_after_their_lines_are_laid(spark, monkeypatch):
    """The sample of ranges does not read what messages say."""
    from docketry.operators import runlog

    seen, real = [], runlog.features
    monkeypatch.setattr(runlog, "features", lambda df: seen.append(df.columns) or real(df))
    lines = spark.sql("SELECT 1 AS run, 1L AS line_no, TIMESTAMP '2024-01-01' AS ts, 'Abrindo processo 00001.000001/2021-01' AS message")
    assert runlog.summarize(lines).count() == 1
    assert "_part" in seen[0]


def test_labels_of_annotations_are_folded_once(spark):
    """What several fields of a line need is computed once; blanks are cleaned in the block as they were line by line."""
    from pyspark.sql import functions as F

    from docketry.functions import text as X
    from docketry.operators import extract as E

    blocks = {
        "PARCEIRO:\u00a0a \t b\r\nN\u00daMERO ACT: n\u00ba 12/3.\rOBJETO: x\x0by\r\r\n  z\x85w \nGestor: g": ("a b", None, "12/3", "x y z w"),
        "objeto:<BR />1: 2 \u00e9 longo demais para um rotulo\u2028e mais<br>V\u00edg\u00eancia: :v <br\r\n/>vigencia: w": (None, ":v", None, "1: 2 \u00e9 longo demais para um rotulo e mais"),
        "\u00a8PARCEIRO : p\nPARCEIRO: q": ("p", None, None, None), ": x": (None,) * 4, "": (None,) * 4,
    }
    df = spark.createDataFrame([(x,) for x in blocks], "x string")
    out = df.select("x", E.annotation(F.col("x")).alias("a"))
    assert {r["x"]: tuple(r["a"]) for r in out.collect()} == blocks
    cell = X.annotation_cell(F.array(F.lit("1"), F.col("x")), ("\u00c7", "PARCEIRO:"))
    # each fold is one use of the table: a label's, and a cell's
    assert times(out, "translate(") == 1 and times(df.select(cell.alias("c")), "translate(") == 1
    assert times(catalog_records.annotation_labels(spark, "/root/testdata/sf0.001"), "translate(") <= 2


def test_customers_of_one_nation_are_dealt_over_tasks(spark, tmp_path):
    """Rows are dealt after the join with nations, whichever join it is."""
    from pyspark.sql import functions as F

    con = duckdb.connect()
    con.execute(f"COPY (SELECT i::BIGINT AS c_custkey, 'c' || i AS c_name, 7 AS c_nationkey, i / 2 AS c_acctbal, 'm' AS c_mktsegment FROM range(400) r(i)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT 7 AS n_nationkey, 'n' AS n_name) TO '{tmp_path}/nation.parquet' (FORMAT parquet)")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = catalog.annotation_parse(spark, str(tmp_path)).withColumn("_p", F.spark_partition_id()).groupBy("_p").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sum(r["count"] for r in parts) == 400 and max(r["count"] for r in parts) <= 100


def test_stored_documents_hold_no_copies(spark, monkeypatch):
    """A registry stores a short text's folded forms once and gives every column of the classified rows back."""
    from docketry.operators import families
    from docketry.plans import publish

    texts = ["Memorando de Entendimentos", "Termo de Execução Descentralizada Criado por X", "Memorando de Entendimentos " + "ação e mais " * 700, "", None]
    rows = [(i, k, t, x) for i, (k, t, x) in enumerate((k, t, x) for k in ("memorando", "TED ", "act", "outro", None) for t in ("", " Título", None) for x in texts)]
    bronze = spark.createDataFrame(rows, "row_idx int, requested_type string, title string, text string").selectExpr("*", "'1' AS processo", "'rótulo' AS chosen", "'/p' AS json_path")
    seen, real = [], families.stored
    monkeypatch.setattr(families, "stored", lambda df: seen.append(df) or real(df))
    registry = families.Registry([families.FamilySpec(s.key, s.label, s.classes, s.rules, any_class=s.any_class) for s in publish.registry()])
    out = registry.dispatch(bronze)
    want = registry.classified(bronze)
    want = want.withColumn("accepted", registry.accepted()).where("family IS NOT NULL")
    got = [r for df in out.values() for r in df.select(*want.columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want.collect())) and len(got) == 45
    assert not {"full", "opening"} & set(seen[0].columns)
    short = seen[0].where("text = 'Memorando de Entendimentos'").collect()
    assert short and all(r[c] is None for r in short for c in ("_body", "folded", "header", "rejection"))
