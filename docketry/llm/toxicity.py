"""Toxicity by multiple-instance learning: sentences are the instances, a document's score is the noisy-or of
its sentences' scores, and only document labels train the sentence scorer."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _SPACE, Words, held_out, labelled_sample, labelled_texts, pieces, stored, table

#: Documented bound of the labelled rows that train the scorer.  Words are 40-bit hashes.
TRAIN_ROWS, BUCKETS, THRESHOLD = 8000, 1 << 40, 0.5
#: A word's features are itself and its first bytes, so that forms of a word share what they have in common.
PREFIXES = (4, 5, 6, 7, 8)
#: ASCII punctuation separates words, so that `word###` is `word`; these four end sentences.
_BREAK = _SPACE.copy()
_BREAK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?"), ord("\n")]] = True


class Model(NamedTuple):
    """Weights of the words (sorted hashes) that have one."""

    bias: float
    ids: np.ndarray
    weights: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.zeros(len(words))
        at = np.minimum(np.searchsorted(self.ids, words), len(self.ids) - 1)
        return np.where(self.ids[at] == words, self.weights[at], 0.0)


class Sentences(NamedTuple):
    """Features (words and prefixes) by hash and the sentence of each; feature offsets of the rows; the row of each
    sentence, first and last byte of each."""

    words: Words
    buckets: np.ndarray
    of_word: np.ndarray
    at: np.ndarray
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray


def sentences(column: pa.Array) -> Sentences:
    """Sentences that have words.  A stop directly between letters or digits (3.5) ends a sentence as well: the
    scorer needs a partition of the text, no grammar."""
    words = Words(column, _BREAK, True, PREFIXES)
    n = len(words.starts)
    if not n:
        none = np.zeros(0, np.int64)
        return Sentences(words, none, none, words.rows * 0, none, none, none)
    stops = np.cumsum(_STOP[words.raw])[words.starts]
    rows = np.repeat(np.arange(len(words.rows) - 1), np.diff(words.rows))
    new = np.ones(n, bool)
    new[1:] = (stops[1:] != stops[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(new)
    width = 1 + len(PREFIXES)
    features = (np.column_stack([words.hashes, words.heads]) % np.uint64(BUCKETS)).astype(np.int64).ravel()
    return Sentences(words, features, np.repeat(np.cumsum(new) - 1, width), words.rows * width, rows[begin], words.starts[begin], words.ends[np.append(begin[1:], n) - 1])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, label) of each document's distinct words, and (-1, label) of the document itself."""
    for batch in (part for whole in batches for part in pieces(whole)):
        s = sentences(batch.column(0))
        label = batch.column(1).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(s.at))
        order = np.lexsort((s.buckets, row))
        pairs = np.stack([row, s.buckets])[:, order]
        pairs = pairs[:, np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(0))[: len(row)] & (pairs[1] > 0)]
        yield pa.record_batch([pa.array(np.concatenate([pairs[1], np.full(len(label), -1)])), pa.array(np.concatenate([label[pairs[0]], label]).astype(np.int32))], ["word", "label"])


def _bags(ids: np.ndarray):
    """The label, the number of sentences, and the distinct sentence * len(ids) + place of the words that have a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole)):
            s = sentences(batch.column(0))
            at = np.searchsorted(s.row, np.arange(batch.num_rows + 1))
            place = np.minimum(np.searchsorted(ids, s.buckets), len(ids) - 1)
            hit = np.flatnonzero(ids[place] == s.buckets)
            cuts = np.searchsorted(hit, s.at)
            bags = [np.unique((s.of_word[hit[a:b]] - at[i]) * len(ids) + place[hit[a:b]]).tobytes() for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            yield pa.record_batch([batch.column(1), batch.column(2), pa.array(np.diff(at).astype(np.int32)), pa.array(bags, pa.binary())], ["doc_id", "label", "n", "bag"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, least: int = 4, z_least: float = 4.5) -> Model:
    """Fits at most `rows` labelled documents outside the held-out fold.  Without any, every score is 0.

    Rows that repeat an id and a text count once; an id with several texts brings each, within the bound.  Null texts hold
    no sentence.  Spark counts the words of the sample by label.  Only words in `least` documents or more, found in toxic ones more
    often than chance explains (z_least standard deviations), get a weight: the others could only be learnt by heart.
    The driver gets these words and where they stand.  Other columns of either table are not read, whatever their names."""
    none = Model(-40.0, np.zeros(0, np.int64), np.zeros(0))
    sample = stored(labelled_texts(docs, labelled_sample(labels, "toxic", rows), rows))
    seen = stored(sample.select("text", "label").mapInArrow(_words, "word long, label int").groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).where(F.col("n") >= F.when(F.col("word") < 0, 0).otherwise(least)))
    whole = seen.where("word < 0").first()
    if whole is None or not whole["toxic"]:
        return none
    usual = whole["toxic"] / whole["n"]
    chosen = seen.where((F.col("word") >= 0) & (F.col("toxic") - F.col("n") * usual >= z_least * F.sqrt(F.col("n") * usual * (1 - usual)))).select("word")
    ids = np.sort(chosen.toPandas()["word"].to_numpy(np.int64))
    if not len(ids):
        return none
    got = sample.mapInArrow(_bags(ids), "doc_id long, label int, n int, bag binary").toPandas().sort_values(["doc_id", "bag"])
    return fit(ids, got["label"].to_numpy(float), got["n"].to_numpy(np.int64), [np.frombuffer(x, np.int64) for x in got["bag"]])


def fit(ids: np.ndarray, y: np.ndarray, n: np.ndarray, bags: list[np.ndarray], steps: int = 150, rate: float = 0.1, decay: float = 1e-6) -> Model:
    """Full-batch Adam on the noisy-or likelihood.  y: labels; n: sentences of each document; bags: its distinct
    sentence * len(ids) + place of a word in ids."""
    base = np.concatenate([[0], np.cumsum(n)])
    sent = np.concatenate([b // len(ids) + k for b, k in zip(bags, base, strict=False)])
    word = np.concatenate([b % len(ids) for b in bags])
    owner = np.repeat(np.arange(len(n)), n)
    theta, m, v = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)
    theta[-1] = -6.0
    for t in range(1, steps + 1):
        z = np.bincount(sent, theta[:-1][word], minlength=base[-1]) + theta[-1]
        total = np.maximum(np.bincount(owner, np.logaddexp(0, z), minlength=len(n)), 1e-9)
        slope = ((1 - y) - y / np.expm1(np.minimum(total, 700))) / len(n)
        dz = slope[owner] / (1 + np.exp(-z))
        grad = np.append(np.bincount(word, dz[sent], minlength=len(ids)) + decay * theta[:-1], dz.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model(float(theta[-1]), ids, theta[:-1])


def sentence_scores(model: Model, s: Sentences) -> np.ndarray:
    """The log of 1 / (1 - p) of each sentence; each distinct feature counts once, as in training."""
    weights = model.of(s.buckets)
    hit = np.flatnonzero(weights)
    _, first = np.unique(s.of_word[hit] * BUCKETS + s.buckets[hit], return_index=True)
    z = np.bincount(s.of_word[hit[first]], weights[hit[first]], minlength=len(s.row)) + model.bias
    return np.logaddexp(0, z)


def score(docs: DataFrame, model: Model, columns: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The given columns of docs, with score (noisy-or, 0 to 1) and offending: the sentences whose own score
    reaches the threshold, or the worst one where only together they do; start and end in characters.

    Null, empty and wordless texts score 0 with no sentence.  Every row is scored on its own, so repeated rows
    and ties agree; input columns score and offending are replaced."""
    columns = [c for c in columns if c not in ("score", "offending")]
    docs = docs.select(F.col("text").alias("_text"), *columns)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a weight a word of at most TRAIN_ROWS documents
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in columns) + ", score double, offending array<struct<start:int,end:int,score:double>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in pieces(whole):
                s = sentences(batch.column(0))
                logs = sentence_scores(model, s)
                total = np.bincount(s.row, logs, minlength=batch.num_rows)
                out = 1 - np.exp(-total)
                found = [[] for _ in range(batch.num_rows)]
                if (out >= threshold).any():
                    chars = np.concatenate([[0], np.cumsum((s.words.raw & 0xC0) != 0x80)])
                    at = np.searchsorted(s.row, np.arange(batch.num_rows + 1))
                    for i in np.flatnonzero(out >= threshold):
                        own = logs[at[i] : at[i + 1]]
                        hit = np.flatnonzero(own >= -np.log1p(-threshold))
                        for j in (hit if len(hit) else [int(own.argmax())]) + at[i]:
                            zero = chars[s.words.row_bytes[i]]
                            found[i].append({"start": int(chars[s.first[j]] - zero), "end": int(chars[s.last[j]] - zero), "score": float(1 - np.exp(-logs[j]))})
                yield pa.record_batch([*batch.columns[1:], pa.array(out, pa.float64()), pa.array(found, kind)], [*columns, "score", "offending"])

    return docs.mapInArrow(run, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id", "text"])
    spans = F.transform("offending", lambda x: F.substr("text", x["start"] + 1, x["end"] - x["start"]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("offending").alias("n_offending"), "offending", spans.alias("offending_sentences"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score below the threshold; the scorer is trained on the labelled documents that
    the stage before kept.  Each row is scored by its own text, whatever its id: null, shared and repeated ids make no
    difference; null and empty texts score 0 and stay; other columns of docs are left out."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), columns)
    return scored.where(F.col("score") < THRESHOLD).select(*columns)
