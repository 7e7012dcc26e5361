import random

import numpy as np
import pytest

from docketry.llm import components as K
from docketry.llm import neardup as N


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]


def shingle_set(text):
    w = words(text)
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets}


def near(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"z{rng.random()}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows, i = [], 0
    for _ in range(40):
        base = " ".join(rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(rng.choice([3, 6, 40, 200])))
        for n in range(rng.randint(1, 5)):
            rows.append((i, near(rng, base, rng.randint(0, 3)) if n else base))
            i += 1
    rows += [(i, ""), (i + 1, None), (i + 2, " \n"), (i + 3, "One two"), (i + 4, "one TWO"), (i + 5, "one two three"), (i + 6, "É a b c d"), (i + 7, "é a b c d")]
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_brute_force(spark, documents, corpus, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(documents(corpus), percent).collect()}
    assert got == brute(corpus, percent)


def test_dense_regions(spark, documents, monkeypatch):
    """A hot group is cut into blocks; the texts outside its largest component still meet all others."""
    monkeypatch.setattr(N, "DENSE", 12)
    rng = random.Random(5)
    base = " ".join(str(rng.randrange(10**6)) for _ in range(120))
    rows = [(i, near(rng, base, rng.choice([1, 2, 2, 3]))) for i in range(70)] + [(100 + i, base) for i in range(5)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(documents(rows), 85).collect()}
    assert got == brute(rows, 85)


def test_edges(spark, documents):
    text = " ".join(str(i) for i in range(30_000))
    rows = [(7, text), (3, text), (None, text), (None, "x"), (9, "same words here and there"), (9, "same words here and there")]
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"], r["n_shingles"]) for r in N.near_duplicates(documents(rows)).collect())
    assert got == [("3", 3, True, 29996), ("7", 3, False, 29996), ("9", 9, True, 1), ("9", 9, True, 1), ("None", None, True, 1), ("None", None, True, 29996)]
    assert N.near_duplicates(documents(rows).limit(0)).count() == 0
    kept = N.one_of_each(spark, documents(rows), "").collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["3", "9", "None"] and kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_stage_keeps_a_unique_text_of_a_shared_id(spark, documents):
    """An id with a duplicate and a unique text loses the duplicate only; so does an id with an empty text."""
    rows = [(3, "same words here and there"), (9, "same words here and there"), (9, "quite another text of its own"), (8, "same words here and there"), (7, "same words here and there"), (7, None)]
    kept = N.one_of_each(spark, documents(rows), "").collect()
    assert sorted((r["doc_id"], str(r["text"])) for r in kept) == [(3, "same words here and there"), (7, "None"), (9, "quite another text of its own")]


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000 + rng.randrange(50), 1000 + rng.randrange(50)) for _ in range(60)] + [(5000, k) for k in range(5001, 5200)] + [(9, 9)]
    got = {r["node"]: r["label"] for r in K.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    assert got == {i: root(i) for a, b in edges if a != b for i in (a, b)}
    assert K.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_borders_between_parts(spark, documents, monkeypatch, percent):
    """Orders cut into many small parts: neighbours on both sides of a border meet."""
    monkeypatch.setattr(N, "PART", 16)
    monkeypatch.setattr(N, "DENSE", 24)
    rng = random.Random(8)
    rows = []
    for k in range(6):
        base = " ".join(str(rng.randrange(10**6)) for _ in range(100))
        rows += [(100 * k + i, near(rng, base, rng.choice([1, 1, 2, 3]))) for i in range(25)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(documents(rows), percent).collect()}
    assert got == brute(rows, percent)


def test_region_without_links(spark, documents):
    """Texts that share boilerplate but no link stay apart, one pair among them is found."""
    rng = random.Random(9)
    shared = [str(rng.randrange(10**6)) for _ in range(80)]
    rows = [(i, " ".join(shared + [f"own{i}x{k}" for k in range(20)])) for i in range(400)]
    rows.append((1000, rows[77][1] + " end"))
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(documents(rows), 85).where("NOT kept").collect()}
    assert got == {1000: 77}


def templated(rng, n, template, own, pairs, more=1):
    """n texts that share a template of some shingles, with `own` shingles each; texts 2k and 2k + 1, for k < pairs, share `more` of these."""
    shared = [f"t{rng.randrange(10**9)}" for _ in range(template + 4)]
    rows = []
    for i in range(n):
        mate = i // 2 if i < 2 * pairs else None
        tail = [f"p{mate}x{k}" for k in range(more)] if mate is not None else [f"o{i}y{k}" for k in range(more)]
        rows.append((i, " ".join(shared + tail + [f"w{i}z{k}" for k in range(own - more)])))
    return rows


@pytest.mark.parametrize(("percent", "template", "own", "more"), [(85, 400, 36, 1), (80, 100, 13, 2)])
def test_links_just_above_a_template(spark, documents, percent, template, own, more):
    """All texts of a dense region are nearly linked by what they share; the pairs that are linked are all found."""
    rows = templated(random.Random(12), 500, template, own, 60, more)
    a, b, c = (shingle_set(rows[i][1]) for i in (0, 1, 2))
    assert 100 * len(a & b) >= percent * len(a | b) and 100 * len(a & c) < percent * len(a | c)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(documents(rows), percent).collect()}
    assert got == {i: i - i % 2 if i < 120 else i for i, _ in rows}


@pytest.mark.parametrize("together", [20_000, 7])
def test_rare_pairs_are_complete(spark, monkeypatch, together):
    """The exact join proposes every link between labels: random sets over few shingles, sizes apart, hot shingles dealt out."""
    monkeypatch.setattr(N, "TOGETHER", together)
    rng = random.Random(13)
    pool = [rng.randrange(1 << 62) for _ in range(60)]
    sets = []
    for i in range(150):
        base = rng.sample(pool, rng.randint(3, 40)) if i % 3 or not sets else list(rng.choice(sets))
        sets.append(sorted(set(base) ^ set(rng.sample(pool, rng.randint(0, 2)))))
    sets = [x for x in sets if x]
    texts = spark.createDataFrame([(i, i % 50, bytearray(np.array(x, np.uint64).tobytes())) for i, x in enumerate(sets)], "c long, label long, items binary")
    for percent in (80, 85):
        got = {(r["a"], r["b"]) for r in N._rare_pairs(texts, percent).collect()}
        want = {(i, j) for j in range(len(sets)) for i in range(j) if i % 50 != j % 50 and 100 * len(set(sets[i]) & set(sets[j])) >= percent * len(set(sets[i]) | set(sets[j]))}
        assert want <= got and want


def test_one_of_each(spark, documents):
    """One row of a group stays, whatever its id: repeated, shared and null ids, texts without words, other columns."""
    text = " ".join(str(i) for i in range(300))
    rows = [(7, text), (3, text), (None, text), (None, "x"), (None, "X"), (9, "same words here and there"), (9, "same words here and there"), (9, "a text of its own"), (5, None), (5, ""), (6, text + " end")]
    kept = N.one_of_each(spark, documents(rows), "").collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "").lower()[:9]) for r in kept) == [("3", "0 1 2 3 4"), ("5", ""), ("5", ""), ("9", "a text of"), ("9", "same word"), ("None", "x")]
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    assert N.one_of_each(spark, documents(rows).limit(0), "").count() == 0
