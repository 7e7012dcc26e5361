"""Benchmark decontamination: a BM25 inverted index of test items with block maxima; every training passage is a
query, block-max WAND skips what can't reach the threshold, and hits are verified by question and answer overlap."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _SHINGLE, Words, mix, pieces, shingles, table
from .toxicity import _BREAK, _STOP

#: BM25's constants; least words of a passage (longer if an item is: passages overlap by half, so three quarters of
#: an item lie in one at least); ranges of items with a bound of their own.
K1, B, PASSAGE, RANGES = 1.2, 0.75, 64, 64
#: A passage retrieves an item from this share of the score that the item gets from itself; share of the 5-word shingles
#: of the whole item, or of a question of ASKED words or more, that confirm a leak.  An answer alone confirms none: it is
#: one sentence, often of a word or two.
RETRIEVE, OVERLAP, ASKED = 0.5, 0.8, 5
#: Items and characters of one index, which is broadcast (some 16 bytes a character and 256 a term); more make more
#: indexes, of which so many are probed in one pass over the texts.
INDEX_ITEMS, INDEX_CHARS, INDEXES_A_PASS = 4096, 4_000_000, 4


class Index(NamedTuple):
    items: np.ndarray  # item ids
    lengths: np.ndarray  # words of each
    terms: np.ndarray  # sorted word hashes
    peak: np.ndarray  # largest impact of a term on any item
    start: np.ndarray  # postings of a term: start[t]:start[t + 1]
    item: np.ndarray
    impact: np.ndarray
    size: int  # items of a range
    bounds: np.ndarray  # terms x ranges: the largest impact in each
    passage: int
    parts: np.ndarray  # words of its question and of its answer
    asked: np.ndarray  # sorted shingles of all questions of ASKED words or more
    asked_start: np.ndarray  # their items: asked_start[s]:asked_start[s + 1]
    asked_item: np.ndarray
    question: list[np.ndarray]  # shingles
    answer: list[np.ndarray]
    whole: list[np.ndarray]


def split_answer(w: Words, row: int) -> int:
    """Words of an item's question: all sentences but the last; of a single sentence, three quarters."""
    a, b = w.rows[row], w.rows[row + 1]
    stops = np.cumsum(_STOP[w.raw])[w.starts[a:b]] if b > a else np.zeros(0)
    last = int(np.searchsorted(stops, stops[-1])) if b > a else 0
    return last or -(-3 * int(b - a) // 4)


def build(ids: list[int], texts: list[str | None]) -> Index:
    """Impacts are BM25 weights divided by the item's score for its own text, so one threshold fits all items."""
    w = Words(pa.array(texts, pa.string()), _BREAK, latin=True)
    lengths = np.diff(w.rows)
    row = np.repeat(np.arange(len(ids)), lengths)
    terms, term = np.unique(w.hashes, return_inverse=True)
    pair, tf = np.unique(term * max(1, len(ids)) + row, return_counts=True)
    term, item = pair // max(1, len(ids)), pair % max(1, len(ids))
    df = np.bincount(term, minlength=len(terms))
    idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
    mean = lengths.mean() if len(ids) and lengths.sum() else 1.0
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / mean))
    impact = impact / np.bincount(item, impact, minlength=len(ids))[item]
    size = max(1, -(-len(ids) // RANGES))
    bounds = np.zeros((len(terms), max(1, -(-len(ids) // size))), np.float32)
    np.maximum.at(bounds, (term, item // size), impact * 1.00001)  # single precision never rounds below the impact
    peak = bounds.max(1) if len(terms) else np.zeros(0)
    start = lambda of: np.searchsorted(of, np.arange(len(terms) + 1))
    parts = [(w.hashes[w.rows[i] : w.rows[i + 1]], split_answer(w, i)) for i in range(len(ids))]
    first = np.array([k for _, k in parts], np.int64)
    question = [shingles(h[:k]) for h, k in parts]
    of = np.repeat(np.arange(len(ids)), [len(q) if k >= ASKED else 0 for q, k in zip(question, first, strict=True)])
    every = np.concatenate([np.zeros(0, np.uint64), *(q for q, k in zip(question, first, strict=True) if k >= ASKED)])
    order = np.argsort(every, kind="stable")
    asked, n = np.unique(every, return_counts=True)
    return Index(np.array(ids, np.int64), lengths, terms, peak, start(term), item, impact, size, bounds, int(max([PASSAGE, *lengths])), np.stack([first, lengths - first], 1), asked, np.concatenate([[0], np.cumsum(n)]), of[order], question, [shingles(h[k:]) for h, k in parts], [shingles(h) for h, _ in parts])


def _slices(start: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Places of the postings of some terms."""
    n = start[terms + 1] - start[terms]
    return np.repeat(start[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())


def retrieve(index: Index, words: Words, threshold: float = RETRIEVE) -> list[tuple[int, int, int, float]]:
    """(row, first word, item, score) of every passage and item with score >= threshold.

    Bounds of all passages come first, by arrays: the sum of the terms' peaks over all items, then over each range of
    items.  Passages that some range lets through are then walked by block-max WAND."""
    if not len(index.terms) or not len(words.hashes):
        return []
    at = np.minimum(np.searchsorted(index.terms, words.hashes), len(index.terms) - 1)
    place = np.flatnonzero(index.terms[at] == words.hashes)
    term = at[place]
    row = np.searchsorted(words.rows, place, side="right") - 1
    offset = place - words.rows[row]
    # passages of all rows are numbered together; a word lies in passages offset // step and the one before
    size, step = index.passage, index.passage // 2
    passages = np.maximum(1, -(-(np.diff(words.rows) - size) // step) + 1)
    base = np.concatenate([[0], np.cumsum(passages)])
    key = row * len(index.terms) + term
    order = np.argsort(key, kind="stable")
    before = np.full(len(place), -1)
    same = key[order][1:] == key[order][:-1]
    before[order[1:][same]] = offset[order[:-1][same]]
    number, which = [], []
    for back in range(-(-size // step)):
        k = offset // step - back
        ok = (k >= 0) & (k < passages[row]) & (offset < k * step + size) & (before < k * step)  # its first time in the passage
        number.append(base[row[ok]] + k[ok])
        which.append(term[ok])
    number, which = np.concatenate(number), np.concatenate(which)
    keep = (np.bincount(number, index.peak[which], minlength=base[-1]) >= threshold)[number]
    number, which = number[keep], which[keep]
    order = np.argsort(number, kind="stable")
    number, which = number[order], which[order]
    cuts = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1, [len(number)]]) if len(number) else np.zeros(1, np.int64)
    out = []
    for x in range(0, len(cuts) - 1, 512):
        heads = cuts[x : x + 513]
        bound = np.add.reduceat(index.bounds[which[heads[0] : heads[-1]]], heads[:-1] - heads[0], axis=0) >= threshold
        for i in np.flatnonzero(bound.any(1)):
            r = int(np.searchsorted(base, number[heads[i]], side="right") - 1)
            out += [(r, int(number[heads[i]] - base[r]) * step, k, score) for k, score in _wand(index, which[heads[i] : heads[i + 1]], threshold)]
    return out


def _wand(index: Index, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, float]]:
    """Block-max WAND, item by item: (item, score) with score >= threshold for a passage's distinct terms.

    Cursors stand in order of their items.  The pivot is the first item that the peaks of the cursors up to it allow;
    cursors before it skip to it.  Where the blocks' own maxima do not allow it, all of them skip past the block."""
    item, impact, size = index.item, index.impact, index.size
    cursors = [[int(index.start[t]), int(index.start[t + 1]), int(t)] for t in terms]

    def skip(c: list[int], to: int) -> None:
        c[0] += int(np.searchsorted(item[c[0] : c[1]], to))

    while cursors:
        cursors = sorted((c for c in cursors if c[0] < c[1]), key=lambda c: item[c[0]])
        total, pivot = 0.0, -1
        for j, c in enumerate(cursors):
            total += index.peak[c[2]]
            if total >= threshold:
                pivot = j
                break
        if pivot < 0:
            return
        at = int(item[cursors[pivot][0]])
        while pivot + 1 < len(cursors) and item[cursors[pivot + 1][0]] == at:
            pivot += 1
        head = cursors[: pivot + 1]
        if index.bounds[[c[2] for c in head], at // size].sum() < threshold:
            past = (at // size + 1) * size
            past = min(past, int(item[cursors[pivot + 1][0]])) if pivot + 1 < len(cursors) else past
            for c in head:
                skip(c, past)
        elif item[head[0][0]] == at:
            score = float(sum(impact[c[0]] for c in head))
            if score >= threshold:
                yield at, score
            for c in head:
                c[0] += 1
        else:
            for c in head:
                skip(c, at)


def retrieve_questions(index: Index, words: Words, overlap: float) -> list[tuple[int, int, int, float]]:
    """(row, first word, item, score) of the passages that hold shingles of a question, in rows with `overlap` of them.

    A question without its answer can be a small part of its item's score, and questions of common words would be
    retrieved by most passages at a lower threshold; their shingles are looked up as they are."""
    h = words.hashes
    if not len(index.asked) or len(h) < 5:
        return []
    s = _all_shingles(h)
    at = np.minimum(np.searchsorted(index.asked, s), len(index.asked) - 1)
    place = np.flatnonzero(index.asked[at] == s)
    row = np.searchsorted(words.rows, place, side="right") - 1
    ok = place + 5 <= words.rows[row + 1]
    place, row = place[ok], row[ok]
    pair = np.unique(row * len(index.asked) + at[place])
    r, which = pair // len(index.asked), pair % len(index.asked)
    n = index.asked_start[which + 1] - index.asked_start[which]
    pair, found = np.unique(np.repeat(r, n) * len(index.items) + index.asked_item[_slices(index.asked_start, which)], return_counts=True)
    step, out = index.passage // 2, []
    for p, k in zip(pair.tolist(), found.tolist(), strict=True):
        r, i = divmod(p, len(index.items))
        if k < overlap * len(index.question[i]):
            continue
        a, b = words.rows[r], words.rows[r + 1]
        inside = place[np.searchsorted(place, a) : np.searchsorted(place, b)]
        inside = inside[np.isin(s[inside], index.question[i])] - a
        last = max(0, -(-int(b - a - index.passage) // step)) * step
        mine = np.flatnonzero(index.item == i)
        term = index.terms[np.searchsorted(index.start, mine, side="right") - 1]
        for first in np.unique(np.minimum(inside // step * step, last)).tolist():
            out.append((r, first, i, float(index.impact[mine][np.isin(term, h[a + first : min(a + first + index.passage, b)])].sum())))
    return out


def _all_shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """The hash that shingles() gives to each run of n words, in order."""
    m = max(0, len(h) - n + 1)
    total = np.full(m, n if n < 5 else 0, np.uint64)
    for k in range(n):
        total += h[k : k + m] * _SHINGLE[k]
    return mix(total)


def verify(index: Index, words: Words, hits: list[tuple[int, int, int, float]]) -> Iterator[tuple[int, int, float, float, float, float, int, float]]:
    """One (row, item, score, question, answer, whole overlap, first word, verdict) a row and item: the best passage's
    score, the shares of shingles found within the passage and an item's length around it, and the larger one of those
    that confirm a leak."""
    best: dict[tuple[int, int], tuple] = {}
    for r, first, i, score in hits:
        n = int(index.lengths[i])
        h = words.hashes[words.rows[r] : words.rows[r + 1]]
        h = h[max(0, first - n) : first + index.passage + n]
        here = shingles(h)
        share = []
        for s, k in zip((index.whole[i], index.question[i], index.answer[i]), (n, *index.parts[i]), strict=True):
            # a part of under 5 words is one shingle: it has to stand there as a run
            share.append(float(np.isin(s, _all_shingles(h, int(k)) if k < 5 else here).mean()) if k else 0.0)
        new = (max(share[0], share[1] if index.parts[i][0] >= ASKED else 0.0), share[0], score, share[1], share[2], -first)
        if (r, i) not in best or new > best[r, i]:
            best[r, i] = new
    for (r, i), (verdict, whole, score, question, answer, first) in best.items():
        yield r, i, score, question, answer, whole, -first, verdict


def _hits(sent: list, words: Words, threshold: float, overlap: float) -> Iterator[tuple[int, int, float, float, float, float, int]]:
    """(row, item_id, score, question, answer, whole overlap, first word) of the leaks in some texts."""
    for one in sent:
        index = one.value
        for r, i, score, question, answer, whole, first, verdict in verify(index, words, retrieve(index, words, threshold) + retrieve_questions(index, words, overlap)):
            if verdict >= overlap:
                yield r, int(index.items[i]), score, question, answer, whole, first


def _scan(sent: list, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 1):
                rows = list(_hits(sent, Words(batch.column(1), _BREAK, latin=True), threshold, overlap))
                c = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = [pa.int64(), *[pa.float64()] * 4, pa.int64()]
                yield pa.record_batch([batch.column(0).take(pa.array(c[0], pa.int64())), *[pa.array(x, t) for x, t in zip(c[1:], kinds, strict=True)]], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "overlap", "first_word"])

    return run


def _keep_clean(sent: list, threshold: float, overlap: float):
    """Rows (text, ...) that hold no item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                clean = np.ones(batch.num_rows, bool)
                clean[[r for r, *_ in _hits(sent, Words(batch.column(0), _BREAK, latin=True), threshold, overlap)]] = False
                yield batch.filter(pa.array(clean))

    return run


def _passes(items: DataFrame) -> Iterator[list]:
    """Broadcast indexes, as many as one pass over the texts probes at once.

    Items of like length share an index, since its passages are as long as its longest item: one index for those of up to
    PASSAGE words, one for up to twice as many, and so on.  An index holds INDEX_ITEMS and INDEX_CHARS at most but for a
    single item; a pass broadcasts INDEXES_A_PASS of them."""
    sc = items.sparkSession.sparkContext
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    words = F.greatest(F.regexp_count("text", F.lit(r"[^\s!-/:-@\[-`{-~]+")), F.lit(PASSAGE))
    items = items.withColumn("length", F.ceil(F.log2(words / PASSAGE)).cast("int"))
    sent = []
    for size in items.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).orderBy("length").collect():  # a row a doubling of the length
        shards = max(1, -(-size["n"] // INDEX_ITEMS), -(-size["chars"] // INDEX_CHARS))
        for k in range(shards):
            rows = items.where((F.col("length") == size["length"]) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)).orderBy("item_id", "text").collect()
            if rows:
                sent.append(sc.broadcast(build([r["item_id"] for r in rows], [r["text"] for r in rows])))
            if len(sent) == INDEXES_A_PASS:
                yield sent
                sent = []
    if sent:
        yield sent


def leaks(docs: DataFrame, items: DataFrame, threshold: float = RETRIEVE, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, overlap, first_word): the items that a document
    holds, one row a document row and item.

    Words are runs without white space or ASCII punctuation, A-Z and À-Þ lower-cased.  Every passage of an index's
    length, one each half of it, is a query over the index; shingles of questions are looked up besides.  A leak needs
    `overlap` of the 5-word shingles of the item, or of its question (of ASKED words at least) without its answer (the
    last sentence; of a single sentence, its last quarter), around the passage; all three shares are reported.  Parts
    of under 5 words count as found where they stand as a run.

    Null and empty texts, items without words and null item ids match nothing; very long texts are read in full, in
    overlapping passages; repeated rows repeat; items with equal texts each match; other columns of docs and items are
    not read, so their names can't clash."""
    docs, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, overlap double, first_word long"
    for sent in _passes(items):
        part = docs.mapInArrow(_scan(sent, threshold, overlap), schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item of the benchmark go.  Each row is judged by its own text, whatever its id: null, shared and
    repeated ids make no difference; null and empty texts stay; other columns of docs are left out."""
    docs = docs.select("text", "doc_id", "lang", "source", "n_chars")
    for sent in _passes(table(spark, sf_dir, "benchmark")):
        docs = docs.mapInArrow(_keep_clean(sent, RETRIEVE, OVERLAP), docs.schema)
    return docs.select("doc_id", "text", "lang", "source", "n_chars")
