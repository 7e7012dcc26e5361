"""Fill-in-middle: texts are cut at unit borders into prefix, middle and suffix and put in another order.  Borders are found on
the UTF-8 bytes, eight in a machine word: unit ends are marked arithmetically, counted by word, and selected in the word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, table, text_bytes

#: Marks of the parts; a text that holds one of them is left plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100: documents that are rearranged, and of these the ones with the suffix first.
RATE, SPM_RATE = 90, 20

_HIGH, _ONES = np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
_1, _7, _8, _56 = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)


def _every(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


def words64(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts raw[at[i]:at[i + 1]] as little-endian words, each text from a word of its own and at least one zero byte after
    it: the words, and the n + 1 word offsets of the texts."""
    sizes = np.diff(at)
    starts = np.concatenate([[0], np.cumsum(sizes // 8 + 1)])
    padded = np.zeros(int(starts[-1]) * 8, np.uint8)
    for i in np.flatnonzero(sizes):
        padded[starts[i] * 8 : starts[i] * 8 + sizes[i]] = raw[at[i] : at[i + 1]]
    return padded.view("<u8").astype(np.uint64, copy=False), starts


def continuing(x: np.ndarray) -> np.ndarray:
    """High bit of every byte that goes on with a code point (10xxxxxx)."""
    return x & ~(x << _1) & _HIGH


def letters(x: np.ndarray) -> np.ndarray:
    """High bit of every byte A-Z or a-z: sums of seven-bit bytes never carry into the next byte."""
    low = (x | _every(0x20)) & ~_HIGH
    return (low + _every(0x80 - ord("a"))) & ~(low + _every(0x80 - ord("z") - 1)) & ~x & _HIGH


def unit_ends(x: np.ndarray) -> np.ndarray:
    """High bit of every byte that ends a unit: runs of letters are one, every other code point is one.

    A byte ends a unit unless the next goes on with its code point, or both are letters; padding ends none."""
    following = np.concatenate([x[1:], np.zeros(1, np.uint64)]) if len(x) else x
    shifted = lambda marks, first: (marks >> _8) | (first << _56)
    a, c, fa, fc = letters(x), continuing(x), letters(following), continuing(following)
    there = ((x | ((x & ~_HIGH) + _every(0x7F))) & _HIGH)  # bytes that are not zero
    return ~shifted(c, fc) & ~(a & shifted(a, fa)) & there


def select(marks: np.ndarray, before: np.ndarray, first: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Byte positions just after the rank-th mark from word `first` on (rank 0: that word's first byte).  before: running
    counts of marks, one longer than marks; the word is searched in them, then the byte in the word."""
    want = before[first] + rank
    word = np.where(rank > 0, np.searchsorted(before, want, side="left") - 1, first)
    left = (want - before[word]).astype(np.uint64)
    sums = (marks[np.minimum(word, len(marks) - 1)] >> _7) * _ONES  # byte k: marks in bytes 0 to k
    short = ~(sums + (np.uint64(0x80) - left) * _ONES) & _HIGH  # bytes where fewer than `left` are seen
    inside = np.where(rank > 0, np.bitwise_count(short).astype(np.int64) + 1, 0)
    return word * 8 + inside


def _counts(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])


def _arranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, doc_id, h1, h2, form) with cuts and output; `form` is what a text takes unless it must stay plain."""
    marks_of = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks_of
    for whole in batches:
        for batch in pieces(whole):
            raw, at = text_bytes(batch.column(0))
            h1, h2, wanted = batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4).to_pylist()
            x, first = words64(raw, at)
            # zero bytes can be text: they end units of their own, so padding is told by place
            ends = unit_ends(x) if not (raw == 0).any() else _with_zeros(x, at, first)
            units = _counts(ends)
            n = units[first[1:]] - units[first[:-1]]
            low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
            a = select(ends, units, first[:-1], low) - first[:-1] * 8
            b = select(ends, units, first[:-1], high) - first[:-1] * 8
            chars = _counts(continuing(x))
            going = lambda cut: chars[first[:-1] + cut // 8] + np.bitwise_count(continuing(x)[first[:-1] + cut // 8] & ((_1 << (np.uint64(8) * (cut % 8).astype(np.uint64))) - _1)) - chars[first[:-1]]  # noqa: E731, B023
            p_chars, m_chars = a - going(a), (b - going(b)) - (a - going(a))
            form, out = [], []
            for i in range(batch.num_rows):
                text = raw[at[i] : at[i + 1]].tobytes()
                f = "plain" if not text or any(k in text for k in marks_of) else wanted[i]
                pre, mid, suf = text[: a[i]], text[a[i] : b[i]], text[b[i] :]
                form.append(f)
                out.append(text if f == "plain" else p + pre + s + suf + m + mid if f == "psm" else s + suf + p + pre + m + mid)
            plain = np.array([f == "plain" for f in form], bool)
            columns = [batch.column(1), pa.array(n, pa.int64()), pa.array(form), pa.array(p_chars, pa.int64(), mask=plain), pa.array(m_chars, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.record_batch(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _with_zeros(x: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """unit_ends of texts that hold zero bytes: these are set to another byte that is a unit of its own."""
    view = x.copy().view(np.uint8)
    for i, size in enumerate(np.diff(at)):
        own = view[first[i] * 8 : first[i] * 8 + size]
        own[own == 0] = 1
    return unit_ends(view.view("<u8").astype(np.uint64, copy=False))


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of docs (doc_id, text).

    A text has n units, `[A-Za-z]+|[^A-Za-z]` over code points.  Four numbers from the SHA-256 of `1:` and the id choose two
    cuts, whether the text is rearranged (rate of 100), and whether the suffix comes first (spm_rate of 100).  Empty
    and null texts, and texts with a mark, stay plain.  A null id is hashed as the empty string.  Repeated rows repeat;
    rows are independent of each other, so nothing is shuffled.  Texts are read whole, a megabyte of them at a time or
    one longer text (about 60 bytes of memory a byte of it).  Other columns are not read, so their names can't clash."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    form = F.when(h[2] % 100 >= rate, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    return rows.mapInArrow(_arranged, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form: a rearranged text holds each mark once, in a known order."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda k: F.get(parts, F.lit(k))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP11_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM h),
c AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT doc_id, t, n, form, CASE WHEN form = 'plain' THEN NULL ELSE array_to_string(u[1:a], '') END AS p,
    CASE WHEN form = 'plain' THEN NULL ELSE array_to_string(u[a + 1:b], '') END AS m, CASE WHEN form = 'plain' THEN NULL ELSE array_to_string(u[b + 1:], '') END AS s
  FROM c),
o AS (
  SELECT doc_id, n, form, p, m, CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END AS output FROM p),
r AS (
  SELECT *, CASE form WHEN 'psm' THEN output[4:strpos(output, '<S>') - 1] || output[strpos(output, '<M>') + 3:] || output[strpos(output, '<S>') + 3:strpos(output, '<M>') - 1]
    WHEN 'spm' THEN output[strpos(output, '<P>') + 3:strpos(output, '<M>') - 1] || output[strpos(output, '<M>') + 3:] || output[4:strpos(output, '<P>') - 1] ELSE output END AS restored FROM o)
SELECT doc_id, n, form, length(p)::BIGINT AS prefix_chars, length(m)::BIGINT AS middle_chars, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM r
"""
