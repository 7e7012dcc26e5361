from docketry.llm import mixing as M


def test_edges(spark, documents):
    docs = documents([(1, "a b c"), (2, ""), (3, None), (4, "  \t\n "), (5, "d " * 3000), (5, "d " * 3000), (None, "x y"), (6, "é x")])
    out = M.mix_sources(docs)
    assert out.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "size"]
    rows = out.collect()
    assert len(rows) == 8 and all(r["copies"] <= 2 for r in rows) and all(r["taken"] == r["copies"] * r["size"] for r in rows)
    assert all(r["taken"] == 0 for r in rows if not (r["text"] or "").split())
    assert sorted(map(str, rows)) == sorted(map(str, M.mix_sources(docs).collect()))
    assert M.mix_sources(docs.limit(0)).count() == 0
    assert {r["taken"] for r in M.mix_sources(documents([(1, ""), (2, None)])).collect()} == {0}


def test_targets(spark):
    sizes = spark.createDataFrame([("b", 100), ("a", 10), (None, 100), ("c", 100), ("d", 40)], "source string, size long")
    got = {r["source"]: r["target"] for r in M.source_targets(sizes).collect()}
    # weights a 5, b 2, c 1, d 5, null 2: a stops at 20 and d at 80; 425 are left for b, c and null
    assert got["a"] == 20 and got["d"] == 80
    assert got["b"] == 170 and got["c"] == 85 and got[None] == 170


def test_fixed_size(spark, data):
    out = M.op10_mixing(spark, data).toPandas()
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "source").toPandas()
    per = out.merge(docs, on="doc_id").groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((per.taken - per.target).abs() <= per.most).all()
    assert (out.taken <= 2 * out["size"]).all()


def test_cut_between_equal_rows(spark):
    """Rows that repeat, null ids of one size and a null source: every source ends within one document of its target."""
    rows = [(i, "w " * (1 + i % 5), "a") for i in range(40)] + [(7, "x y z", "b")] * 90 + [(None, "x y", "c")] * 70 + [(i, "w", "c") for i in range(40)] + [(3, "v w", None)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    for seed in (7, 8, 9):
        out = M.mix_sources(docs, seed=seed).toPandas()
        assert len(out) == len(rows)
        for _, g in out.groupby("source", dropna=False):
            assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
            assert g.taken.sum() == (g.copies * g["size"]).sum() and g.copies.max() - g.copies.min() <= 1


def test_equal_rows_follow_the_sql(spark, tmp_path):
    import duckdb

    rows = [(i, "w " * (1 + i % 5), "a") for i in range(40)] + [(7, "x y z", "b")] * 90 + [(None, "x y", "c")] * 70 + [(i, "w", "c") for i in range(40)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = con.execute(f"SELECT doc_id, size, taken FROM ({M.OP10_SQL})").fetchall()
    got = [tuple(r) for r in M.op10_mixing(spark, str(tmp_path)).select("doc_id", "size", "taken").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_inclusion_rates(spark):
    """Over seeds, documents of a source are taken about equally often."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "a" if i < 60 else "b") for i in range(120)], "doc_id long, text string, source string")
    runs = [M.mix_sources(docs, seed=s).select("doc_id", "copies").toPandas().set_index("doc_id").copies for s in range(6)]
    a = sum(r[r.index < 60].mean() for r in runs) / 6
    b = sum(r[r.index >= 60].mean() for r in runs) / 6
    assert abs(a - 2) < 0.05 and abs(b - 1) < 0.12


def test_native_plan(spark, data):
    plan = M.op10_mixing(spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_stage_takes_rows_not_ids(spark, documents):
    rows = [(None, "a b c")] * 4 + [(5, "d e")] * 3 + [(5, "f g h i")] + [(6, ""), (7, None)]
    out = M.pipeline_stage(spark, documents(rows), "")
    got = out.toPandas()
    assert (got.copies > 0).all() and got.text.isin(["a b c", "d e", "f g h i"]).all() and (got.taken == got.copies * got["size"]).all()
    assert abs(got.taken.sum() - got.groupby("source").target.first().sum()) <= 4 * got.source.nunique()
    assert M.pipeline_stage(spark, documents(rows).limit(0), "").count() == 0
