"""What the operators share: tables, the shared scratch folder, and words of Arrow text columns."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The contract's word: a run of characters that are no ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; that setting is made here only where it is unset in local mode (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most `limit` labelled rows outside the held-out fold, in hash order: (doc_id, label).

    Rows with a null id or label are no examples; repeated ids count once, with their largest label."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id").limit(limit)


def labelled_texts(docs: DataFrame, sample: DataFrame, limit: int) -> DataFrame:
    """(text, doc_id, label) of at most `limit` rows of docs whose id is in the sample, in hash order: an id that many rows
    share brings each of its different texts once, and only as many as fit."""
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most `limit` ids
    place = F.struct(F.xxhash64("doc_id", F.lit(17)), "doc_id", F.xxhash64("text"), F.coalesce(F.length("text"), F.lit(0)))
    # texts are told apart by two hashes and their length, so that only hashes are shuffled; then the chosen come along
    marks = rows.select(place.alias("m"), F.xxhash64("text", F.lit(5)).alias("h")).distinct().orderBy("m", "h").limit(limit)
    first = rows.select("text", "doc_id", "label", place.alias("m"), F.xxhash64("text", F.lit(5)).alias("h")).join(F.broadcast(marks), ["m", "h"])
    return first.groupBy("m", "h").agg(F.first("text").alias("text"), F.first("doc_id").alias("doc_id"), F.first("label").alias("label")).select("text", "doc_id", "label")


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 19
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _STEP * 2)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, x, np.uint64))]) for x in (_BASE, inverse)]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def pieces(batch: pa.RecordBatch, column: int = 0, most: int = 1 << 20, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with `rows` rows and `most` bytes of text at most (one row may be longer), so that what is
    computed from a slice stays small beside long texts."""
    at, i = text_bytes(batch.column(column))[1], 0
    while i < batch.num_rows:
        j = int(np.searchsorted(at, at[i] + most, side="right")) - 1
        j = min(max(j, i + 1), i + rows, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


class Words:
    """Words of a batch: starts, ends (byte positions), hashes, and the n + 1 word offsets of the rows.

    A-Z are lower-cased; with latin, the letters À-Þ as well, which keeps lengths and places.  With prefixes, heads has
    a column for each: the hash of so many first bytes, 0 for words that are no longer."""

    def __init__(self, column: pa.Array, space: np.ndarray = _SPACE, latin: bool = False, prefixes: tuple[int, ...] = ()):
        raw, self.row_bytes = text_bytes(column)
        self.raw = _LOWERED[raw]
        if latin and len(raw) > 1:
            at = np.flatnonzero(raw[:-1] == 0xC3) + 1
            at = at[(raw[at] >= 0x80) & (raw[at] <= 0x9E) & (raw[at] != 0x97)]
            self.raw[at] += 0x20
        solid = ~space[self.raw]
        first, last = solid.copy(), solid.copy()
        if len(solid):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            cuts = self.row_bytes[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(solid))]
            first[cuts] = solid[cuts]
            last[cuts - 1] = solid[cuts - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.starts, self.row_bytes)
        self.prefixes = prefixes
        found = list(self._hash())
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in found)])
        self.heads = np.concatenate([np.zeros((0, len(prefixes)), np.uint64), *(x for _, x in found)])

    def _hash(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Position-free polynomial hashes, some half a megabyte of text at a time."""
        i, n = 0, len(self.starts)
        while i < n:
            at = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.starts, at + _STEP)))
            up, down = _power_tables(int(self.ends[j - 1] - at) + 1)
            piece = _BYTE[self.raw[at : self.ends[j - 1]]]
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(piece * up[: len(piece)], out=total[1:])
            s, e = self.starts[i:j] - at, self.ends[i:j] - at
            heads = np.zeros((j - i, len(self.prefixes)), np.uint64)
            for k, n_first in enumerate(self.prefixes):
                longer = np.flatnonzero(e - s > n_first)
                heads[longer, k] = mix((total[s[longer] + n_first] - total[s[longer]]) * down[s[longer]] + np.uint64(1000 + n_first))
            yield mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)), heads
            i = j


_SHINGLE = _RNG.integers(1, 2**63, 5, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of one text; fewer words are one shingle, none is none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < 5:
        return mix((words * _SHINGLE[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = words[: n - 4] * _SHINGLE[0]
    for k in range(1, 5):
        total += words[k : n - 4 + k] * _SHINGLE[k]
    return np.unique(mix(total))
