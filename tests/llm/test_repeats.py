import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from docketry.llm import repeats


def brute(rows, length, first=False):
    """Spans of each row by a dictionary of all windows; rows are (doc_id, text)."""
    texts = [(t or "").encode() for _, t in rows]
    seen = defaultdict(list)
    for r, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]].append((r, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        places = sorted(places, key=lambda p: (rows[p[0]][0] is None, rows[p[0]][0] or 0, p[1]))
        for r, i in places[1:] if first else places if len(places) > 1 else []:
            gone[r][i : i + length] = True
    out = []
    for (doc_id, _), t, g in zip(rows, texts, gone, strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~g])
        out.append((str(doc_id), len(t), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(docs, **kind):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.repeats_digest(docs, **kind).collect())


def words(rng, n):
    return " ".join(rng.choice("abcdefghé") * rng.randint(1, 4) + str(rng.randrange(10**5)) for _ in range(n))


def corpus(seed):
    """Texts that share passages in the middle, at their ends, shifted, within themselves, and copies."""
    rng = random.Random(seed)
    shared = [words(rng, rng.choice([4, 7, 12, 40])) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [words(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            cut = rng.randrange(len(p))
            parts += [p if rng.random() < 0.6 else p[cut:], words(rng, rng.randint(0, 12))]
        rows.append((i, " ".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "x" * 500), (103, "ab" * 200 + "c"), (104, None), (105, ""), (106, "short"), (107, "y" * 61), (None, rows[5][1] + "!"), (108, words(rng, 20) * 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length", [60, 23])
def test_brute_force(spark, documents, length):
    rows = corpus(length)
    assert found(documents(rows), length=length) == brute(rows, length)


def test_keep_first(spark, documents):
    """Places are ordered by id, so ids here are all different."""
    rows = corpus(7)
    assert found(documents(rows), length=60, keep="first") == brute(rows, 60, first=True)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_large_blocks_are_split(spark, documents, keep):
    """One passage in every text, with other neighbours each time, in blocks of 4 contexts at most."""
    rng = random.Random(3)
    passage, other = words(rng, 14), words(rng, 9)
    rows = [(i, f"{words(rng, 6)} {passage if i % 3 else passage[:70] + other} {words(rng, rng.randint(0, 9))}") for i in range(40)]
    assert found(documents(rows), length=60, keep=keep, block=4) == brute(rows, 60, keep == "first")


def test_repeated_rows_and_outputs(spark, documents):
    """Rows repeated with one id are copies of each other; with keep="first" they are one place."""
    text = "a passage that two rows share " * 2
    rows = [(1, text + "1"), (1, text + "1"), (2, "no " + text), (None, text), (None, None)]
    assert found(documents(rows), length=40) == brute(rows, 40)
    out = {(r["doc_id"], bytes(r["kept"]).decode(), str(r["spans"])) for r in repeats.without_repeats(documents(rows), 40).collect()}
    firsts = {r for r in out if r[0] == 1}
    assert len(firsts) == 1 and (2, "no ", "[Row(start=3, end=63)]") in out
    assert repeats.repeats_digest(documents(rows).limit(0)).collect() == []


def test_long_text(spark, documents):
    """A text of many steps, cut inside runs, against a copy that starts elsewhere."""
    rng = random.Random(11)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_200_000))
    rows = [(1, long), (2, "shift" + long[500_000:1_100_000]), (3, long[:399])]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeats.repeats_digest(documents(rows)).collect()}
    assert got == {1: (600_000, 1), 2: (600_000, 1), 3: (0, 0)}


@pytest.mark.parametrize("seed", range(4))
def test_previous_factors(seed):
    """Against all pairs, with the least lcp between them."""
    rng = np.random.default_rng(seed)
    lcp, place = rng.integers(0, 9, 60).astype(np.int32), rng.permutation(60)
    lcp[0] = 0
    want = [max([0, *(lcp[min(i, j) + 1 : max(i, j) + 1].min() for j in range(60) if place[j] < place[i])]) for i in range(60)]
    assert repeats.previous_factors(lcp, place).tolist() == want


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.op13_repeated_passages(spark, data).collect())
    assert got == brute(rows, 400) and sum(r[2] for r in got) > 0
