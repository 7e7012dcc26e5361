"""Repeated passages by longest-previous-factor arrays: suffixes are put in order, the previous and next smaller positions
in that order give each suffix its longest earlier match, and bytes under a long enough match are removed.

Suffixes are dealt to blocks first.  Every window of `length` bytes belongs to one of its grams, the least by hash
(the last of equals), so equal windows lie at the same place around equal grams: a block holds what surrounds one gram,
and all matches of its windows are inside it.  Blocks are ordered column by column, from the right."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTE, _power_tables, mix, pieces, stored, table, text_bytes

#: Bytes that must match.
LENGTH = 400
#: Windows that are read at a time, and contexts of a block; larger blocks are split by more of their text.
STEP, BLOCK = 1 << 19, 2048
#: Keys up to this number are broadcast (16 bytes each).
BROADCAST_KEYS = 1_000_000
_PLACE = (1 << 24) - 1


def _gram(length: int) -> int:
    return max(1, length // 3)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours: running minima of blocks from both sides."""
    n = len(x)
    blocks = np.concatenate([x, np.full(-n % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def contexts(raw: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, s, lo, hi, a, x) of texts raw[at[i]:at[i + 1]]: runs of windows that belong to one gram.

    The run's windows start at s to s + hi - lo in the text; lo and hi are the same starts counted from length - gram
    before the gram.  a is the gram's hash, x the hash of all that the run's windows cover, with lo."""
    gram = _gram(length)
    width = length - gram + 1
    for base in range(0, len(raw) - length + 1, STEP):
        part = raw[base : base + STEP + length - 1]
        up, down = _power_tables(len(part) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * up[: len(part)], dtype=np.uint64)])
        grams = mix((total[gram:] - total[:-gram]) * down[: len(part) - gram + 1] + np.uint64(gram))
        least = sliding_least((grams & ~np.uint64(_PLACE)) | (np.uint64(_PLACE) - np.arange(len(grams), dtype=np.uint64)), width)
        own = _PLACE - (least & np.uint64(_PLACE)).astype(np.int64)
        start = base + np.arange(len(own))
        row = np.searchsorted(at, start, side="right") - 1
        i = np.flatnonzero(start + length <= at[row + 1])
        if not len(i):
            continue
        new = np.flatnonzero(np.concatenate([[True], (own[i][1:] != own[i][:-1]) | (np.diff(i) != 1)]))
        s, e = i[new], i[np.concatenate([new[1:], [len(i)]]) - 1]
        lo = s - own[s] + width - 1
        x = mix(mix((total[e + length] - total[s]) * down[s] + (e - s).astype(np.uint64)) + lo.astype(np.uint64))
        yield row[s], base + s - at[row[s]], lo, lo + e - s, grams[own[s]].view(np.int64), x.view(np.int64)


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, rows=1 << 16):
                for row, *found in contexts(*text_bytes(batch.column(0)), length):
                    yield pa.record_batch([*(c.take(pa.array(row)) for c in batch.columns[1:]), *map(pa.array, found)], [*batch.schema.names[1:], "s", "lo", "hi", "a", "x"])

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, need) as the bytes of each context that is needed: (b, y, a, x, from, to, lo, hi, bytes, n, place...)."""
    for whole in batches:
        for batch in pieces(whole):
            raw, at = text_bytes(batch.column(0))
            need = batch.column(1)
            items = need.flatten()
            row = np.repeat(np.arange(len(need)), np.diff(np.asarray(need.offsets)))
            s, size = (items.field(k).to_numpy() for k in ("s", "size"))
            data = [raw[i : i + k].tobytes() for i, k in zip((at[row] + s).tolist(), size.tolist(), strict=True)]
            names = [f.name for f in items.type if f.name != "size"]
            yield pa.record_batch([*(items.field(n) for n in names), pa.array(data, pa.binary())], [*names, "bytes"])


def previous_factors(lcp: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For rows in suffix order: the longest match with a row of a smaller place.  lcp[i] is the match of rows i - 1 and i.

    The nearest smaller places on both sides are found by following pointers, all rows at once; the least lcp on the
    way comes along."""
    best = np.zeros(len(lcp), lcp.dtype)
    for order in (slice(None), slice(None, None, -1)):
        own = place[order]
        step = lcp if order.step is None else np.concatenate([lcp[1:], [0]])[order]
        to, match = np.arange(-1, len(own) - 1), step.copy()
        while len(far := np.flatnonzero((to >= 0) & (own[to] >= own))):
            match[far] = np.minimum(match[far], match[to[far]])
            to[far] = to[to[far]]
        match[to < 0] = 0
        best = np.maximum(best, match[order])
    return best


def _least_between(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of lcp[a + 1] to lcp[b], for a < b."""
    levels = [lcp]
    while 2 << (len(levels) - 1) <= len(lcp):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    k = np.frexp(b - a)[1] - 1
    flat, starts = np.concatenate(levels), np.concatenate([[0], np.cumsum([len(x) for x in levels])])
    return np.minimum(flat[starts[k] + a + 1], flat[starts[k] + b + 1 - (1 << k)])


def covered(block: np.ndarray, lo: np.ndarray, hi: np.ndarray, data: list[bytes], place: np.ndarray, length: int, first: bool) -> np.ndarray:
    """Which windows (row, start) have a match of `length` bytes in their block: an earlier one (first), or any.

    Rows are aligned at their gram.  The order of suffixes at a column follows from the order at the column to its right
    by one stable sort on the column's bytes, their matches from the least match between them."""
    width = length - _gram(length) + 1
    n, none = len(data), 256
    grid = np.full((n, width - 1 + length), none, np.uint16)
    for i, x in enumerate(data):
        grid[i, lo[i] : lo[i] + len(x)] = np.frombuffer(x, np.uint8)
    tail = grid[:, width - 1 :].astype(">u2")
    keys = [b + t.tobytes() for b, t in zip((x.tobytes() for x in block.astype(">u4")), tail, strict=True)]
    order = np.array(sorted(range(n), key=keys.__getitem__))
    same = (grid[order[1:], width - 1 :] == grid[order[:-1], width - 1 :]) & (grid[order[1:], width - 1 :] < none)
    lcp = np.zeros(n, np.int32)
    lcp[1:] = np.where(block[order[1:]] == block[order[:-1]], np.where(same.all(1), same.shape[1], same.argmin(1)), 0)
    out = np.zeros((n, width), bool)
    rank = np.empty(n, np.int64)
    rank[np.argsort(place, kind="stable")] = np.arange(n)
    for c in range(width - 1, -1, -1):
        if c < width - 1:
            byte = grid[order, c].astype(np.int64)
            moved = np.argsort(block[order].astype(np.int64) * 512 + byte, kind="stable")
            key = (block[order].astype(np.int64) * 512 + byte)[moved]
            meets = np.flatnonzero((key[1:] == key[:-1]) & (byte[moved][1:] < none)) + 1
            new = np.zeros(n, np.int32)
            new[meets] = 1 + _least_between(lcp, moved[meets - 1], moved[meets])
            order, lcp = order[moved], new
        deep = lcp >= length
        if deep.any():
            near = np.flatnonzero(deep | np.concatenate([deep[1:], [False]]))
            match, at = np.where(deep[near], lcp[near], 0), rank[order[near]]
            found = previous_factors(match, at)
            if not first:
                found = np.maximum(found, previous_factors(match, -at))
            out[order[near], c] = found >= length
    starts = np.arange(width)
    return out & (starts >= lo[:, None]) & (starts <= hi[:, None])


def _blocks(length: int, first: bool):
    """Rows (b, y, lo, hi, bytes, place...) in order of b as (b, y, f, t): the runs of window starts that are covered."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        get = lambda c: rows.column(c).to_numpy(zero_copy_only=False)
        block = np.unique(get("b"), return_inverse=True)[1]
        keys = np.lexsort([get(c) for c in ("s", "k2", "k1", "d", "no_id")])
        place = np.empty(rows.num_rows, np.int64)
        place[keys] = np.arange(rows.num_rows)
        hit = covered(block, get("lo"), get("hi"), rows.column("bytes").to_pylist(), place, length, first).astype(np.int8)
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))), axis=1)
        (i, f), (_, t) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        return pa.record_batch([rows.column("b").take(i).combine_chunks(), rows.column("y").take(i).combine_chunks(), pa.array(f), pa.array(t - 1)], ["b", "y", "f", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([kept, rows]) if kept is not None else rows
            b = rows.column("b").to_numpy()
            ends = np.flatnonzero(np.diff(b)) + 1
            at = 0
            while len(ends) and ends[-1] - at >= BLOCK:  # whole blocks, a batch of them at a time
                until = int(ends[np.searchsorted(ends, at + BLOCK)])
                yield work(rows.slice(at, until - at))
                at = until
            kept = rows.slice(at).combine_chunks()
        if kept is not None and kept.num_rows:
            yield work(kept)

    return run


def _halves(length: int):
    """Rows of large blocks twice, for the lower and the upper half of their window starts: what all windows of a half
    share is longer than what all windows of the block share, and names the half's block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            out: dict[str, list] = {n: [] for n in [*batch.schema.names, "up_b", "up_y"]}
            for i in range(batch.num_rows):
                low, high, lo, hi, data = (rows[n][i] for n in ("low", "high", "lo", "hi", "bytes"))
                middle = (low + high) // 2
                for a, z in ((low, middle), (middle + 1, high)):
                    l2, h2 = max(lo, a), min(hi, z)
                    if l2 > h2:
                        continue
                    core, own = data[z - lo : a + length - lo], data[l2 - lo : h2 + length - lo]
                    names = {n: rows[n][i] for n in batch.schema.names}
                    names |= {"b": _digest(core, rows["b"][i], a, z), "y": _digest(own, l2, h2), "low": a, "high": z, "lo": l2, "hi": h2, "bytes": own, "up_b": rows["b"][i], "up_y": rows["y"][i]}
                    for n, v in names.items():
                        out[n].append(v)
            types = dict(zip(batch.schema.names, batch.schema.types, strict=True)) | {"up_b": pa.int64(), "up_y": pa.int64()}
            yield pa.record_batch([pa.array(v, types[n]) for n, v in out.items()], list(out))

    return run


def _digest(data: bytes, *more: int) -> int:
    return int.from_bytes(hashlib.blake2b(data + repr(more).encode(), digest_size=8).digest(), "little", signed=True)


_WHERE = ["no_id", "d", "k1", "k2", "s"]
_ITEM = "b long, y long, low long, high long, lo long, hi long, n long, no_id boolean, d long, k1 long, k2 long, s long, bytes binary"


def _where(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c) for c in _WHERE])


def _resolved(items: DataFrame, length: int, first: bool, block: int) -> DataFrame:
    """(b, y, f, t): covered window starts of the contexts of blocks; every block holds each context once.

    Blocks of more than `block` contexts are split in halves of their window starts until they are small or hold one
    window, whose contexts are equal by then; equal contexts are aggregated before they meet, so no block is gathered."""
    large = stored(items.groupBy("b").count().where(F.col("count") > block).select("b"))
    n_large = large.count()
    cold = items if not n_large else items.join(F.broadcast(large) if n_large <= BROADCAST_KEYS else large, "b", "left_anti")
    out = cold.repartition("b").sortWithinPartitions("b").mapInArrow(_blocks(length, first), "b long, y long, f long, t long")
    if not n_large:
        return out
    hot = items.join(F.broadcast(large) if n_large <= BROADCAST_KEYS else large, "b", "left_semi").select(*[c.split()[0] for c in _ITEM.split(", ")])
    halves = stored(hot.mapInArrow(_halves(length), _ITEM + ", up_b long, up_y long"))
    classes = stored(halves.groupBy("b", "y").agg(*[F.first(c).alias(c) for c in ("low", "high", "lo", "hi", "bytes")], F.sum("n").alias("n"), F.min(_where()).alias("w")))
    several = classes.groupBy(F.col("b").alias("_b")).agg(F.count("*").alias("kinds")).where("kinds > 1")
    inner = classes.join(several, F.col("b") == F.col("_b")).select("b", "y", "low", "high", "lo", "hi", "n", "w.*", "bytes")
    below = _resolved(stored(inner), length, first, block).withColumnsRenamed({"b": "i_b", "y": "i_y"})
    members = halves.select("b", "y", "lo", "hi", "up_b", "up_y", _where().alias("own")).join(classes.select(F.col("b").alias("c_b"), F.col("y").alias("c_y"), F.col("n").alias("all"), "w"), (F.col("b") == F.col("c_b")) & (F.col("y") == F.col("c_y")))
    whole = F.col("own") != F.col("w") if first else F.col("all") > 1
    members = stored(members.withColumn("whole", whole))
    full = members.where("whole").select("up_b", "up_y", F.col("lo").alias("f"), F.col("hi").alias("t"))
    part = members.where("NOT whole").join(below, (F.col("b") == F.col("i_b")) & (F.col("y") == F.col("i_y"))).select("up_b", "up_y", "f", "t")
    return stored(out.union(full).union(part))


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(k1, k2, text): of each key one text.  Few keys are broadcast, so other texts are not shuffled; copies meet in
    the tasks that read them first."""
    if keys.count() <= BROADCAST_KEYS:
        docs = docs.join(F.broadcast(keys), ["k1", "k2"], "left_semi")
    return docs.groupBy("k1", "k2").agg(F.first("text").alias("text"))


def _keyed(docs: DataFrame, first: bool) -> DataFrame:
    """(text, doc_id, k1, k2): rows with one key get one result.  Without an order of places, the key is of the text."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    of = [F.col("doc_id"), F.coalesce("text", F.lit(""))] if first else [F.coalesce("text", F.lit(""))]
    return docs.select("text", doc_id, F.xxhash64(*of).alias("k1"), F.xxhash64(F.lit(3), *of).alias("k2"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "first", block: int = BLOCK) -> DataFrame:
    """(k1, k2, spans): of each text with something to remove the sorted, separate byte ranges [start, end).

    See without_repeats(); docs come from _keyed().  Per `length` - gram bytes of text a row of numbers is shuffled;
    bytes are only fetched for contexts whose gram has several, one text for each different context."""
    first = keep == "first"
    width = length - _gram(length) + 1
    place = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("d")] if first else [F.lit(False).alias("no_id"), F.lit(0).cast("long").alias("d")]
    runs = docs.select("text", *place, "k1", "k2").mapInArrow(_runs(length), "no_id boolean, d long, k1 long, k2 long, s long, lo long, hi long, a long, x long")
    runs = stored(runs)
    classes = stored(runs.groupBy("a", "x").agg(F.count("*").alias("n"), F.min(_where()).alias("w"), F.first("lo").alias("lo"), F.first("hi").alias("hi")))
    several = classes.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1")
    several = (several if first else several.where("least < 2")).select("b")  # where every context repeats as a whole, all is covered
    shared = stored(classes.join(several, F.col("a") == F.col("b")).select("a", "x", "n", "w", "lo", "hi"))
    whole = F.lit(0).cast("long").alias("low"), F.lit(width - 1).cast("long").alias("high")
    item = F.struct(F.col("a").alias("b"), F.col("x").alias("y"), *whole, "lo", "hi", "n", "w.no_id", "w.d", "w.k1", "w.k2", "w.s", (F.col("hi") - F.col("lo") + length).alias("size"))
    need = stored(shared.groupBy("w.k1", "w.k2").agg(F.collect_list(item).alias("need")))
    texts = _texts(docs, need.select("k1", "k2")).join(need, ["k1", "k2"]).select("text", "need")
    items = stored(texts.mapInArrow(_slices, _ITEM))
    parts = _resolved(items, length, first, block).groupBy(F.col("b").alias("p_a"), F.col("y").alias("p_x")).agg(F.collect_list(F.struct("f", "t")).alias("parts"))
    verdict = classes.join(parts, (F.col("a") == F.col("p_a")) & (F.col("x") == F.col("p_x")), "left").where("n > 1 OR parts IS NOT NULL").select(F.col("a").alias("v_a"), F.col("x").alias("v_x"), "n", "w", "parts")
    verdict = stored(verdict)  # a table of its own, so that Spark can split a context that very many texts have
    hits = runs.join(verdict, (F.col("a") == F.col("v_a")) & (F.col("x") == F.col("v_x")))
    every = _where() != F.col("w") if first else F.col("n") > 1
    range_of = lambda f, t: F.struct((F.col("s") + f - F.col("lo")).alias("start"), (F.col("s") + t - F.col("lo") + length).alias("end"))
    found = F.when(every, F.array(range_of(F.col("lo"), F.col("hi")))).otherwise(F.transform("parts", lambda p: range_of(p["f"], p["t"])))
    hits = hits.select("k1", "k2", F.explode(found).alias("r")).groupBy("k1", "k2").agg(F.sort_array(F.collect_set("r")).alias("ranges"))
    return stored(hits.mapInArrow(_merged, "k1 long, k2 long, spans array<struct<start:bigint,end:bigint>>"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ranges that meet or overlap become one."""
    for batch in batches:
        out = []
        for ranges in batch.column(2).to_pylist():
            spans: list[dict] = []
            for r in ranges:
                if spans and r["start"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], r["end"])
                else:
                    spans.append(dict(r))
            out.append(spans)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, kind)], ["k1", "k2", "spans"])


def _kept(text: bytes, spans: list[dict] | None) -> bytes:
    at, parts = 0, []
    for r in spans or ():
        parts.append(text[at : r["start"]])
        at = r["end"]
    return b"".join([*parts, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, spans, ...) with the bytes that are kept in place of the text."""
    for whole in batches:
        for batch in pieces(whole):
            raw, at = text_bytes(batch.column(0))
            kept = [_kept(raw[at[i] : at[i + 1]].tobytes(), spans) for i, spans in enumerate(batch.column(1).to_pylist())]
            yield pa.record_batch([pa.array(kept, pa.binary()), *batch.columns[1:]], ["kept", *batch.schema.names[1:]])


_SPANS = "array<struct<start:bigint,end:bigint>>"


def without_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first", block: int = BLOCK) -> DataFrame:
    """(doc_id, kept binary, spans) of every row of docs (doc_id, text): its UTF-8 bytes without those that a repeated string
    of `length` bytes covers, and the ranges that went.

    keep="first" leaves the first copy of each string (by doc_id, null last, then a hash of the text, then the place in
    it) and removes later ones, in the same text as well; keep="none" removes all copies.  Matches never cross texts;
    strings are judged on the input and may overlap.  Null texts are empty; texts of under `length` bytes stay whole; very long
    ones are read whole, half a megabyte at a time.  Rows that repeat count as copies with keep="none"; with
    keep="first", rows of equal id and text are one place and are cut alike.  Other columns are not read."""
    keyed = _keyed(docs, keep == "first")
    spans = repeated_spans(keyed, length, keep, block).withColumnsRenamed({"k1": "s1", "k2": "s2"})
    rows = keyed.join(spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select("text", "spans", "doc_id")
    return rows.mapInArrow(_cut, f"kept binary, spans {_SPANS}, doc_id long").select("doc_id", "kept", "spans")


def repeats_digest(docs: DataFrame, length: int = LENGTH, keep: str = "none", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) as without_repeats() gives them; only texts that lose bytes are
    shuffled, and of equal ones a single copy."""
    keyed = _keyed(docs, keep == "first")
    spans = repeated_spans(keyed, length, keep, block)
    cut = _texts(keyed, spans.select("k1", "k2")).join(spans, ["k1", "k2"]).select("text", "spans", "k1", "k2")
    cut = cut.mapInArrow(_cut, f"kept binary, spans {_SPANS}, k1 long, k2 long")
    cut = stored(cut.select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), F.octet_length("kept").cast("long").alias("left"), F.size("spans").cast("long").alias("n"), F.sha2("kept", 256).alias("sha")))
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = keyed.select("doc_id", "k1", "k2", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("own"))
    rows = rows.join(cut, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left")
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("left", "n_bytes")).alias("n_removed"), F.coalesce("n", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, sf_dir, "documents"))


#: Windows are cut from pieces of 799 bytes (as hex), which hold 400 of them; a run ends where no window starts for 400 bytes.
OP13_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
e AS (SELECT doc_id, base, substr(h, 2 * base + 1, 1598) AS h FROM (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 399), 400)) AS base FROM d)),
w AS (SELECT doc_id, base + j AS i, md5_number(substr(h, 2 * j + 1, 800)) AS k FROM (SELECT *, unnest(range(0, least(400, len(h) // 2 - 399))) AS j FROM e)),
c AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
g AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 400 AS gap FROM w SEMI JOIN c USING (k)),
n AS (SELECT doc_id, i, count_if(coalesce(gap, true)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM n GROUP BY doc_id, run),
p AS (SELECT s.doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0))) AS piece FROM s JOIN d USING (doc_id)),
q AS (SELECT doc_id, sum(b - a)::BIGINT AS gone, count(*) AS spans, max(b) AS last, string_agg(piece, '' ORDER BY a) AS head FROM p GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN q USING (doc_id)
"""
