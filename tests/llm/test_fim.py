import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketry.llm import fim
from docketry.llm.common import text_bytes


def expected(doc_id, text):
    """The contract, in plain Python."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


TEXTS = [None, "", "a", "é", "abc", "ab cd", "  ", "x<P>y", "<S>", "<M", "a<", "<<P", "𝒳y𝒳", "日本語 text", "zebra@[`{", "A" * 40, "ñ" * 40, "\x00a\x00", "a\nb\r\n", "\u007f\u0080"]


def test_brute_force(spark, documents):
    rng = random.Random(1)
    letters = "abzAZ@[`{ <>PSM\n\téß日𝒳\u0000\u007f"
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "".join(rng.choice(letters) for _ in range(rng.choice([1, 7, 8, 9, 15, 16, 17, 300])))) for i in range(400)]
    rows += [(None, "no id here"), (5, "ab cd"), (5, "ab cd"), (-3, "below zero"), (9000, "".join(rng.choice("abc é日") for _ in range(400_000)))]
    out = fim.fill_in_middle(documents(rows)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((str(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in out), key=str)
    assert got == sorted(((str(i), *expected(i, t), t or "") for i, t in rows), key=str)
    assert {"plain", "psm", "spm"} == {r["form"] for r in out}


def test_empty_table(spark, documents):
    assert fim.fill_in_middle(documents([(1, "a")]).limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_select(seed):
    """Every rank's byte equals a scan of the marks, also over words without any."""
    rng = np.random.default_rng(seed)
    texts = ["".join(rng.choice(list("ab é日"), rng.integers(0, 60))) for _ in range(50)] + [" a" * 20, "a" * 100]
    raw, at = text_bytes(pa.array(texts))
    x, first = fim.words64(raw, at)
    marks = fim.unit_ends(x)
    before = fim._counts(marks)
    for i, t in enumerate(texts):
        ends = [0]
        for u in re.findall("[A-Za-z]+|[^A-Za-z]", t):
            ends.append(ends[-1] + len(u.encode()))
        at_word = np.full(len(ends), first[i])
        assert (fim.select(marks, before, at_word, np.arange(len(ends))) - first[i] * 8).tolist() == ends


def test_query(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in fim.op11_fill_in_middle(spark, data).collect()}
    want = {i: (n, form, p, m, sha(out), sha(t or "")) for i, t in rows for n, form, p, m, out in [expected(i, t)]}
    assert got == want
