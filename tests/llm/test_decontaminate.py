import random

import numpy as np
import pyarrow as pa

from docketry.llm import decontaminate as D
from docketry.llm.common import Words


def make(rng, n=60):
    vocabulary = [f"w{i}" for i in range(400)]
    return [(i, ". ".join(" ".join(rng.choices(vocabulary, k=rng.randint(6, 15))) for _ in range(3)) + ".") for i in range(n)], vocabulary


def scores(index, words):
    """Every item's score for every passage, without bounds."""
    out = {}
    for r in range(len(words.rows) - 1):
        h = words.hashes[words.rows[r] : words.rows[r + 1]]
        for first in range(0, max(1, len(h) - index.passage // 2), index.passage // 2):
            terms = np.unique(np.searchsorted(index.terms, [x for x in h[first : first + index.passage] if x in index.terms]))
            s = np.zeros(len(index.items))
            for t in terms.astype(int):
                p = slice(index.start[t], index.start[t + 1])
                s[index.item[p]] += index.impact[p]
            out |= {(r, first, i): s[i] for i in range(len(s))}
    return out


def test_wand_equals_exhaustive_scores():
    rng = random.Random(1)
    items, vocabulary = make(rng)
    index = D.build([i for i, _ in items], [t for _, t in items])
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 64, 200]))) + " " + rng.choice(items)[1] for _ in range(40)]
    words = Words(pa.array([*texts, None, ""]), D._BREAK, latin=True)
    for threshold in (0.2, 0.5):
        got = {(r, f, i): s for r, f, i, s in D.retrieve(index, words, threshold)}
        want = {k: s for k, s in scores(index, words).items() if s >= threshold}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_leaks(spark, documents):
    rng = random.Random(2)
    items, vocabulary = make(rng, 30)
    filler = lambda k: " ".join(rng.choices(vocabulary, k=k))
    whole = items[3][1]
    rows = [(1, filler(500) + " " + whole.upper() + " " + filler(300)), (2, filler(400)), (3, whole), (3, whole), (4, None), (5, ""), (6, " ".join(whole.split()[:8])), (7, filler(40_000) + " " + items[9][1]), (None, items[4][1]), (8, items[5][1].replace(" ", " *** "))]
    bench = spark.createDataFrame([*items, (99, None), (98, ""), (None, "w1 w2"), (97, whole)], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in D.leaks(documents(rows), bench).collect())
    assert got == sorted([("1", 3), ("1", 97), ("3", 3), ("3", 3), ("3", 97), ("3", 97), ("7", 9), ("None", 4), ("8", 5)])
    one = [r for r in D.leaks(documents(rows), bench).collect() if r["doc_id"] == 7][0]
    assert one["overlap"] == one["question_overlap"] == one["answer_overlap"] == 1.0
    assert D.leaks(documents(rows).limit(0), bench).count() == 0 and D.leaks(documents(rows), bench.limit(0)).count() == 0


def test_questions_without_answers(spark, documents):
    """A whole question is a leak without its answer, however long that is; an answer alone is none."""
    rng = random.Random(5)
    pool, answers = [f"w{i}" for i in range(300)], [f"a{i}" for i in range(300)]
    text = lambda words, k: " ".join(rng.sample(words, k))
    items = [(i, text(pool, 12), text(answers, k)) for i, k in enumerate([1, 2, 4, 8, 30, 40])] + [(10, "w1 w2 w3", text(answers, 12))]
    bench = spark.createDataFrame([(i, f"{q}. {a}.") for i, q, a in items], "item_id long, text string")
    rows = [(100 + i, f"b c {q}, d e") for i, q, _ in items] + [(200 + i, f"b c {a}, d e") for i, _, a in items] + [(300 + i, f"b c {q}. {a}. d e") for i, q, a in items]
    got = {(r["doc_id"], r["item_id"]): (r["question_overlap"], r["answer_overlap"]) for r in D.leaks(documents(rows), bench).collect()}
    assert {k for k in got if k[0] < 200} == {(100 + i, i) for i in range(6)} and not {k for k in got if 200 <= k[0] < 300}
    assert {k: v for k, v in got.items() if k[0] >= 300} == {(300 + i, i): (1.0, 1.0) for i, _, _ in items}


def test_shards(spark, documents, monkeypatch):
    rng = random.Random(3)
    items, _ = make(rng, 20)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = documents([(i, t) for i, t in items])
    whole = {(r["doc_id"], r["item_id"]) for r in D.leaks(rows, bench).collect()}
    monkeypatch.setattr(D, "INDEX_ITEMS", 6)
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(rows, bench).collect()} == whole == {(i, i) for i in range(20)}


def test_brute_force_on_tables(spark, data):
    """Documents that hold all of an item's 5-word shingles are found, and no others."""
    import re

    cut = lambda t: [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (t or "").lower()) if w]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    items = {r["item_id"]: grams(cut(r["text"])) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: grams(cut(r["text"])) for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    want = {(d, i) for d, g in docs.items() for i, s in items.items() if s and len(s & g) >= 0.8 * len(s)}
    assert {(r["doc_id"], r["item_id"]) for r in D.op2_decontamination(spark, data).collect()} == want


def test_items_of_all_lengths(spark, documents):
    """Long items have an index of their own, so short ones keep short passages; all are found in one pass."""
    rng = random.Random(6)
    pool = [f"w{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(pool, k=k)) + ".") for i, k in enumerate([3, 5, 20, 64, 65, 130, 900, 3000])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [[s.value.passage for s in sent] for sent in D._passes(bench)][0][0] == D.PASSAGE
    filler = " ".join(rng.choices(pool, k=2000))
    rows = documents([(i, f"{filler} {t} {filler}") for i, t in items] + [(50, filler)])
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(rows, bench).collect()} == {(i, i) for i, _ in items}


def test_stage_judges_rows_not_ids(spark, documents, tmp_path):
    rng = random.Random(7)
    items, vocabulary = make(rng, 12)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = " ".join(rng.choices(vocabulary, k=80))
    rows = [(None, items[1][1]), (None, clean), (4, items[2][1]), (4, clean), (5, clean), (5, clean), (6, None), (7, ""), (8, clean * 200 + items[3][1])]
    kept = D.pipeline_stage(spark, documents(rows), str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == sorted([("None", clean), ("4", clean), ("5", clean), ("5", clean), ("6", ""), ("7", "")])
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    assert D.pipeline_stage(spark, documents(rows).limit(0), str(tmp_path)).count() == 0
