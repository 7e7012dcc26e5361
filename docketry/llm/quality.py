"""Quality by nearest-neighbour voting: labelled documents become latent-semantic vectors that are broadcast;
every document takes exact cosines with all of them, in blocks, and its nearest vote by similarity."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, held_out, labelled_sample, labelled_texts, pieces, table, text_bytes

#: Documented bound of the labelled rows that vote; dimensions; neighbours; the power of a similarity in a vote.
VOTERS, DIMENSIONS, NEIGHBOURS, POWER, THRESHOLD = 4000, 48, 15, 8, 0.3

#: The character classes whose triples are the terms.  Bytes above 127 count as lower case.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", "\n", ".", ",;:", "!?", "|", "#$%&*+=^~", "\"'()[]{}<>", "-/\\_@`"]
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate(CLASSES):
    _CLASS[[ord(c) for c in _chars]] = _k
_N = len(CLASSES)
TRIPLES = _N**3
#: Shares of a text that triples can't see, each as one-hot terms of 8 levels.
SHARES = ("words that repeat the word before", "words seen before in the text", "lines seen before in the text", "upper-case letters", "symbols", "words by count")
LEVELS = 8
SHAPES = TRIPLES + len(SHARES) * LEVELS
#: Words by hash, and what a word weighs beside a triple.
WORDS, WORD_WEIGHT = 2048, 0.5
TERMS = SHAPES + WORDS


class Model(NamedTuple):
    idf: np.ndarray
    axes: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    prior: float


def counts(column: pa.Array) -> np.ndarray:
    """Term weights of whole texts, one row a text: log of triples a thousand characters, the shares' levels, and log of
    words (lower-cased, by hash) a hundred words."""
    n = len(column)
    raw, at = text_bytes(column)
    out = np.zeros((n, TERMS), np.float32)
    if not n:
        return out
    kind = _CLASS[raw]
    words = Words(column)
    for i in range(n):
        a, b = at[i], at[i + 1]
        k = kind[a:b]
        if len(k) >= 3:
            c = np.bincount((k[:-2] * _N + k[1:-1]) * _N + k[2:], minlength=TRIPLES)
            out[i, :TRIPLES] = np.log1p(c * (1000 / len(k)))
        w = words.hashes[words.rows[i] : words.rows[i + 1]]
        if len(w):
            found = np.bincount((w % np.uint64(WORDS)).astype(np.int64), minlength=WORDS)
            out[i, SHAPES:] = WORD_WEIGHT * np.log1p(found * (100 / len(w)))
        text = raw[a:b].tobytes()
        lines = [x for x in text.split(b"\n") if x.strip()]
        letters = max(1, int((k <= 1).sum()))
        m = max(1, len(w))
        shares = ((w[1:] == w[:-1]).sum() / m, 1 - len(np.unique(w)) / m if len(w) else 0, 1 - len(set(lines)) / max(1, len(lines)), (k == 1).sum() / letters, (k >= 8).sum() / max(1, len(k)))
        for j, x in enumerate(shares):
            out[i, TRIPLES + j * LEVELS + int(min(x, 0.999) * LEVELS)] = 3
        out[i, TRIPLES + 5 * LEVELS + min(LEVELS - 1, int(np.log2(len(w) + 1) / 2))] = 0.5
    return out


def vectors(model_idf: np.ndarray, axes: np.ndarray, terms: np.ndarray) -> np.ndarray:
    v = (terms * model_idf) @ axes
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def fit(terms: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """Idf and the leading right singular vectors of the voters' term matrix, by subspace iteration.  Weights terms in place."""
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 1.0)
    idf = (np.log((1 + len(terms)) / (1 + (terms > 0).sum(0))) + 0.05).astype(np.float32)
    terms *= idf
    axes = np.random.default_rng(3).normal(size=(TERMS, min(dimensions + 8, TERMS))).astype(np.float32)
    for _ in range(6):
        axes = np.linalg.qr(terms.T @ (terms @ axes))[0]
    turn = np.linalg.svd(terms @ axes, full_matrices=False)[2]
    axes = np.ascontiguousarray((axes @ turn.T)[:, :dimensions], np.float32)
    return Model(idf, axes, vectors(np.float32(1), axes, terms), labels.astype(np.float64), float(labels.mean()))


def vote(model: Model, terms: np.ndarray, neighbours: int = NEIGHBOURS, power: int = POWER) -> np.ndarray:
    """Exact cosines with every voter; the nearest vote with similarity ** power.  Ties: the voters' order."""
    if not len(model.labels):
        return np.full(len(terms), model.prior)
    near = vectors(model.idf, model.axes, terms) @ model.voters.T
    k = min(neighbours, near.shape[1])
    least = np.partition(near, -k, axis=1)[:, [-k]]
    above, equal = near > least, near == least
    taken = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(1, keepdims=True)))
    top = np.nonzero(taken)[1].reshape(len(terms), k)
    weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** power + 1e-9
    return (weight * model.labels[top]).sum(1) / weight.sum(1)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, rows=64):
            yield pa.record_batch([part.column(1), part.column(2), pa.array([x.astype(np.float16).tobytes() for x in counts(part.column(0))], pa.binary())], ["doc_id", "label", "terms"])


def train(docs: DataFrame, labels: DataFrame, voters: int = VOTERS) -> Model:
    """At most `voters` labelled documents outside the held-out fold.  Without any, every document scores 1.

    Rows that repeat an id and a text vote once; an id with several texts brings each, within the bound.  Null texts vote
    as texts without terms; labels without a document, and null ids, are no voters.  Other columns of either table are
    not read, whatever their names."""
    got = labelled_texts(docs, labelled_sample(labels, "quality", voters), voters).mapInArrow(_terms, "doc_id long, label int, terms binary").toPandas()
    got = got.sort_values(["doc_id", "terms"])
    y, terms = got["label"].to_numpy(float), np.zeros((len(got), TERMS), np.float32)
    for i, x in enumerate(got.pop("terms")):
        terms[i] = np.frombuffer(x, np.float16)
    return fit(terms, y)


def score(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The given columns of docs, with score: the similarity-weighted share of label 1 among the neighbours.

    Null and empty texts are texts without terms and are voted on like others; every row is scored on its own.  An
    input column named score is replaced."""
    columns = [c for c in columns if c != "score"]
    docs = docs.select(F.col("text").alias("_text"), *columns)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # VOTERS x DIMENSIONS and TERMS x DIMENSIONS floats
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in columns) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                yield pa.record_batch([*batch.columns[1:], pa.array(vote(sent.value, counts(batch.column(0))), pa.float64())], [*columns, "score"])

    return docs.mapInArrow(run, schema)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score the threshold or more.  Each row is scored by its own text, whatever its id: null,
    shared and repeated ids make no difference, null and empty texts are voted on like others; other columns go."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), columns)
    return scored.where(F.col("score") >= THRESHOLD).select(*columns)
