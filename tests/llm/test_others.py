import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketry.llm import ann as A
from docketry.llm import licenses as L
from docketry.llm import tokens as K
from docketry.llm import warc as R


# --- licences ---------------------------------------------------------------------------------------------------
def test_licenses(spark, documents):
    rows = [
        (1, "prose here.\nReleased under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."), (3, "a license to kill"), (4, None), (5, ""), (6, "RELEASED UNDER THE MIT LICENSE!"),
        (7, "x " * 30_000 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 30_000), (8, "Licensed under the Apache License, Version 1.1."), (1, "Released under the MIT License."), (None, "Licensed under CC BY 4.0."),
        (9, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this document except in compliance with the License."),
    ]
    got = sorted((str(r["doc_id"]), r["license"], len(r["differences"])) for r in L.scan_licenses(documents(rows)).collect())
    assert got == sorted([("1", "MIT", 0), ("1", "MIT", 0), ("2", "CC-BY-NC-4.0", 0), ("2", "Apache-2.0", 0), ("6", "MIT", 0), ("7", "GPL-3.0", 0), ("None", "CC-BY-4.0", 0), ("9", "Apache-2.0", 2)])
    r = [r for r in L.scan_licenses(documents(rows)).collect() if r["doc_id"] == 7][0]
    assert rows[6][1][r["start"] : r["end"]].startswith("This work is licensed") and r["given_size"] < r["plain_size"]
    assert L.scan_licenses(documents(rows).limit(0)).count() == 0


def test_wrapped_and_neighbouring_notices():
    scan = L.Scanner(L.TEMPLATES).scan
    for i, (name, notice) in enumerate(L.TEMPLATES):
        words = notice.split()
        for wrap in ("\n", "\n# ", "\r\n * "):
            text = f"permission of the author{wrap}" + "".join(w + (wrap if k % 4 == 2 else " ") for k, w in enumerate(words)) + f"{wrap}more of the work"
            found = scan(text)
            assert (name, []) in [(f.license, f.differences) for f in found], (i, text)
            assert any(text[f.start : f.end].split()[0].strip('"') == words[0].strip('"') for f in found)
    both = "Released under the MIT License. Licensed under CC BY-NC 4.0."
    assert [f.license for f in scan(both)] == ["MIT", "CC-BY-NC-4.0"]
    assert [f.license for f in scan("y " * 900 + both + " z" * 20 + " Licensed under CC BY 4.0. All rights reserved." + " x" * 900)] == ["MIT", "CC-BY-NC-4.0", "CC-BY-4.0", "Proprietary"]
    assert scan("Released under\n\nthe MIT License.") == [] and scan("license" * 3000) == []
    changed = "the license needs a permission of its own\n" + L.TEMPLATES[5][1].replace("Permission is", "Leave is").replace("charge, to", "charge,\nto")
    assert [(f.license, f.differences) for f in scan(changed)] == [("MIT", ["-permission"])]


def test_licenses_against_exact_search(spark, data):
    """Notices that stand word for word in a document are found, and nothing else is."""
    import re

    flat = lambda t: " ".join(w.lower() for w in re.findall(r"[^\W_]+(?:[.\-'][^\W_]+)*", t or ""))
    docs = {r["doc_id"]: flat(r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    want = {(d, name) for d, t in docs.items() for name, w in L.TEMPLATES if flat(w) in t}
    assert {(r["doc_id"], r["license"]) for r in L.op4_license_scan(spark, data).collect()} == want


# --- tokens -----------------------------------------------------------------------------------------------------
def reference(pieces, bytes_too=True):
    from tokenizers import Tokenizer, models
    from tokenizers import pre_tokenizers as P

    tk = Tokenizer(models.Unigram(pieces, 0, bytes_too))
    tk.pre_tokenizer = P.Sequence([P.WhitespaceSplit(), P.Metaspace(replacement="▁", prepend_scheme="always", split=True)])
    return lambda texts: [len(e.ids) for e in tk.encode_batch(texts, add_special_tokens=False)]


def test_tokens_equal_the_library(spark, data):
    pieces = K.vocabulary()
    rows = K.op7_token_counts(spark, data).toPandas().set_index("doc_id").n_tokens
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").toPandas()
    assert list(rows[docs.doc_id]) == reference(pieces)(docs.text.fillna("").tolist())


@pytest.mark.parametrize("bytes_too", [True, False])
def test_ties_and_unknowns(bytes_too):
    """Random small vocabularies with many equal scores."""
    rng = random.Random(7)
    for _ in range(30):
        pieces = [("<unk>", -9.0), *[(p, float(-rng.randint(1, 3))) for p in sorted({"".join(rng.choices("▁abé", k=rng.randint(1, 4))) for _ in range(25)})]]
        if bytes_too:
            pieces[1:1] = [(f"<0x{i:02X}>", -9.0) for i in range(256)]
        count = K.Counter(pieces)
        texts = ["".join(rng.choices("abéc▁ \n", k=rng.randint(0, 30))) for _ in range(60)]
        assert [count.count(t)[0] for t in texts] == reference(pieces, bytes_too)(texts)


def test_tokens_edges(spark, documents):
    out = K.count_tokens(documents([(1, None), (2, ""), (3, " \n"), (4, "a" * 20_000), (4, "a" * 20_000), (None, "x")]), K.vocabulary(), ["doc_id", "c"]).collect()
    by = {r["doc_id"]: (r["n_tokens"], r["n_words"], r["c"]) for r in out}
    assert len(out) == 6 and by[1] == by[2] == by[3] == (0, 0, "x") and by[4][1] == 1
    assert K.count_tokens(documents([(1, "a")]).limit(0), K.vocabulary()).count() == 0
    assert K.Counter([]).count("ab c") == (2, 2)


# --- fixity -----------------------------------------------------------------------------------------------------
def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, file int, seq string")


def tree(df):
    return R.merkle(R.with_offsets(R.archive(df)))


def test_fixity(spark):
    rows = [(i, f"http://h/{i}", "text " * (i % 7), 1, "s") for i in range(1300)] + [(None, None, None, 1, "s"), (5, "http://h/5", "text " * 5, 1, "s"), (6, "again", "", 1, "s")]
    a = pages(spark, rows)
    assert R.audit(tree(a), tree(a.repartition(5))).count() == 0
    changed = pages(spark, [(i, u, h + "!" if i in (0, 700, 1299) else h, f, s) for i, u, h, f, s in rows])
    offsets = {(r["file"], r["seq"]): r["page_id"] for r in R.with_offsets(R.archive(a)).collect()}
    bad = {offsets[r["file"], r["node"]] for r in R.audit(tree(a), tree(changed)).collect()}
    # a record that grew moves the offsets of the rest of its file; its own leaf is the first that differs
    assert {0, 700, 1299} <= bad
    same_length = pages(spark, [(i, u, "x" + h[1:] if i in (3, 800) else h, f, s) for i, u, h, f, s in rows])
    got = R.audit(tree(a), tree(same_length)).collect()
    assert {offsets[r["file"], r["node"]] for r in got} == {3, 800} and all(r["end_offset"] > r["first_offset"] for r in got)
    lost = R.audit(tree(a), tree(pages(spark, rows[:-200]))).collect()
    assert lost and any(r["right_hash"] is None for r in lost)
    assert R.audit(tree(a.limit(0)), tree(a.limit(0))).count() == 0 and R.audit(tree(a), tree(a.limit(0))).count() == R.with_offsets(R.archive(a)).count()


def test_record_round_trip(spark):
    raw = bytes(pages(spark, [(7, "http://h", "é\r\n\r\nx", 1, "s")]).select(R.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("r")).first()["r"])
    head, _, rest = raw.partition(b"\r\n\r\n")
    n = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    assert rest[:n].decode() == "é\r\n\r\nx" and rest[n:] == b"\r\n\r\n"


# --- nearest neighbours -----------------------------------------------------------------------------------------
def exact(ids, x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = np.round(u @ u[i], 12)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


def test_recall(spark, data):
    got = A.op9_ann(spark, "/root/testdata/sf0.1").toPandas()
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    want = exact(e.vec_id.to_numpy(), np.array(e.embedding.tolist(), float), 5)
    found = got.groupby("query_id").vec_id.apply(set).to_dict()
    assert sum(len(found[q] & set(w)) for q, w in want.items()) >= 0.9 * 5 * len(want)
    assert list(got.columns) == ["query_id", "rank", "vec_id", "score"] and (got.groupby("query_id").size() == 5).all()


@pytest.mark.parametrize("fan", [16, 2])
def test_recall_of_clustered_vectors(spark, monkeypatch, fan):
    """50,000 vectors in clusters of very unequal sizes, answers of units merged in one level and in several."""
    monkeypatch.setattr(A, "FAN", fan)
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(60, 24)) * 3
    own = np.minimum(rng.geometric(0.06, 50_000), 60) - 1
    x = (centres[own] + rng.normal(size=(50_000, 24))).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(50_000)), "embedding": pa.array(list(x))})).repartition(8)
    found = A.nearest(df, F.col("vec_id") % 500 == 0).toPandas()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = 0
    for q, g in found.groupby("query_id"):
        s = u @ u[q]
        s[q] = -2
        hit += len(set(np.argpartition(-s, 5)[:5]) & set(g.vec_id))
        assert np.allclose(g.sort_values("rank").score, s[g.sort_values("rank").vec_id])
    assert hit >= 0.9 * 5 * 100 and len(found) == 500


def test_ann_edges(spark, monkeypatch):
    v = lambda *x: [float(i) for i in x]
    rows = [(0, v(1, 0, 0)), (50, v(0, 2, 0)), (1, v(1, 1, 0)), (2, v(2, 2, 0)), (3, v(1, 1, 0)), (4, None), (5, v(0, 0, 0)), (6, [1.0, None, 0.0]), (7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]), (9, []), (None, v(1, 0, 0)), (100, v(0, 0, 0))]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<float>, list int, codes string")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in A.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 50), (50, 1, 1), (50, 2, 2), (50, 3, 3), (50, 4, 0)]
    assert A.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    monkeypatch.setattr(A, "BLOCK", 40)
    rng = np.random.default_rng(8)
    x = np.concatenate([np.tile(rng.random((1, 8)), (150, 1)), rng.normal(size=(250, 8))])
    df = spark.createDataFrame([(i, [float(k) for k in e]) for i, e in enumerate(x)], "vec_id long, embedding array<double>")
    found = A.nearest(df, F.col("vec_id") % 50 == 0).toPandas()
    want = exact(np.arange(400), x, 5)
    assert found[found.query_id == 0].sort_values("rank").vec_id.tolist() == [1, 2, 3, 4, 5]
    assert sum(len(set(want[q]) & set(g.vec_id)) for q, g in found.groupby("query_id")) >= 0.9 * 5 * len(want)


def test_null_ids_are_dealt_over_files_and_long_records(spark):
    rows = [(None, f"http://h/{i}", f"t{i}", 1, "s") for i in range(600)] + [(3, "http://long", "x" * 3_000_000, 1, "s")]
    a = R.with_offsets(R.archive(pages(spark, rows)))
    assert a.groupBy("file").count().agg(F.max("count")).first()[0] < 20 and a.agg(F.max("length")).first()[0] > 3_000_000
    worse = R.with_offsets(R.archive(pages(spark, [(i, u, "y" + h[1:], f, s) if u.endswith("long") else (i, u, h, f, s) for i, u, h, f, s in rows])))
    got = R.audit(R.merkle(a), R.merkle(worse)).collect()
    assert len(got) == 1 and got[0]["file"] == 0


def test_realign(spark):
    """One lost, one grown and one new record: the rest of their file only moved."""
    rows = [(i, f"http://h/{i}", "text " * (i % 7), 1, "s") for i in range(400)]
    changed = [(i, u, h + "!" if i == 50 else h, f, s) for i, u, h, f, s in rows if i != 20] + [(450, "http://h/new", "n", 1, "s")]
    a, b = (R.with_offsets(R.archive(pages(spark, x))) for x in (rows, changed))
    out = R.realign(a, b, R.audit(R.merkle(a), R.merkle(b))).collect()
    assert {(r["page_id"], r["change"]) for r in out if r["change"] != "moved"} == {(20, "lost"), (50, "corrupt"), (450, "added")}
    assert sum(r["change"] == "moved" for r in out) == 400 - 20 - 2


def test_templates_without_a_usual_trigger(spark, documents):
    own = [("House", "Free for all good uses under the house terms of this site."), *L.TEMPLATES]
    rows = [(1, "a b. Free for all good uses under the house terms\nof this site. c"), (2, "free for none"), (3, "Released under the MIT License. Free for all fine uses under the house terms of this site.")]
    got = sorted((r["doc_id"], r["license"], tuple(r["differences"])) for r in L.scan_licenses(documents(rows), own).collect())
    assert got == [(1, "House", ()), (3, "MIT", ())]
