"""Near-duplicates by MinHash with an LSH forest: in each of several orders the signatures are sorted, and a text's
candidates are the neighbours with which it shares the longest prefix; the depth that these share adapts to how dense
the region is.  Regions that stay dense at every depth are joined on their texts' rare shingles.  Links are confirmed on
full shingle sets, and components are joined as Spark jobs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Words, mix, pieces, shingles, stored, table
from .components import components

#: Trees (orders), columns of the shortest prefix that candidates share, and hashes.  A pair of similarity 0.8 shares
#: the shortest prefix of some tree with chance 1 - (1 - 0.8**4)**20 > 0.99997, one of 0.85 with 1 - 4e-7.
TREES, PREFIX = 20, 4
HASHES = TREES * PREFIX
#: Neighbours before a text in an order that are its candidates; regions of up to FEW texts are proposed in full at once,
#: texts of undecided regions of more than DENSE are joined by their rare shingles.
DENSE, FEW = 64, 8
#: Counters of shingles in dense regions: two a shingle within these bounds (16 MB at most).
LEAST_COUNTERS, MOST_COUNTERS = 1 << 12, 1 << 22
#: Texts that hold one rare shingle and meet in a task; more are dealt over several.
TOGETHER = 20_000
#: Rows of a part of an order, and the most of it.
PART, LARGEST_PART = 4096, 200_000
#: Ids up to this number are broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000
#: Rows whose shingle sets are needed are marked in a map of 16 bits a row, up to this number (32 MB); more are joined.
MOST_MARKED = 1 << 24

_rng = np.random.default_rng(11)
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def _order(tree: int) -> np.ndarray:
    """Columns in a tree's order: the first trees begin with PREFIX columns of their own, the rest is shuffled."""
    rng = np.random.default_rng(100 + tree)
    own = np.arange(tree * PREFIX, (tree + 1) * PREFIX) if tree < TREES else np.zeros(0, np.int64)
    return np.concatenate([own, rng.permutation(np.setdiff1d(np.arange(HASHES), own))]).astype(np.int64)


_ORDERS = [_order(t) for t in range(TREES)]


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 mixed bits of the least of each of HASHES multiply-shift hashes, a few thousand shingles at a time."""
    least = np.full(HASHES, 2**32 - 1, np.uint64)
    for k in range(0, len(hashes), 1024):
        h = hashes[k : k + 1024, None] * _MULTIPLY + _ADD
        np.minimum(least, (h >> np.uint64(32)).min(0), out=least)
    return (mix(least) >> np.uint64(48)).astype(np.uint16)


def _class_of(s: np.ndarray) -> bytes:
    """128 bits of a shingle set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, ...) without their text, with n_shingles, class and signature."""
    for whole in batches:
        for batch in pieces(whole):
            w, n, key, sig = Words(batch.column(0)), [], [], []
            for i in range(batch.num_rows):
                s = shingles(w.hashes[w.rows[i] : w.rows[i + 1]])
                n.append(len(s))
                key.append(_class_of(s) if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.record_batch([*batch.columns[1:], pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], [*batch.schema.names[1:], "n_shingles", "digest", "sig"])


def _matrix(column: pa.Array, kind=np.uint16) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, HASHES) if len(column) else np.zeros((0, HASHES), kind)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shortest prefix of each tree, hashed with the tree's number: the region g of each class (c, sig)."""
    for batch in batches:
        sig, out = _matrix(batch.column(1)), []
        for t in range(TREES):
            key = np.full(len(sig), t + 1, np.uint64)
            for k in _ORDERS[t][:PREFIX]:
                key = mix(key + sig[:, k].astype(np.uint64))
            out.append(key.view(np.int64))
        yield pa.record_batch([pa.concat_arrays([batch.column(0)] * TREES).cast(pa.int64()), pa.array(np.concatenate(out)), pa.array(np.repeat(np.arange(TREES, dtype=np.int32), len(sig)))], ["c", "g", "tree"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, tree, ...) with the signature as a string in the tree's order, a byte a column."""
    for batch in batches:
        sig, tree = _matrix(batch.column(0)).astype(np.uint8), batch.column(1).to_numpy()
        for t in np.unique(tree):
            own = np.flatnonzero(tree == t)
            sig[own] = sig[own][:, _ORDERS[t]]
        keys = pa.array([x.tobytes() for x in sig], pa.binary())
        yield pa.record_batch([keys, *batch.columns[2:]], ["key", *batch.schema.names[2:]])


def _pairs_in_order(rows: pa.Table, start: int, until: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, estimate) of the rows from `start` on against the row d places before each, d = 1, 2, ..., width: as rows are
    sorted, these are the rows that share the longest prefixes with it.  Both are of one region, the earlier one is
    before `until`."""
    g, key = rows.column("g").to_numpy(), _matrix(rows.column("key"), np.uint8)
    for d in range(1, min(width, len(g) - 1) + 1):
        i = np.arange(max(start, d), min(len(g), until + d))
        i = i[g[i] == g[i - d]]
        if not len(i) and d > len(g) - until:
            return
        yield i, (key[i] == key[i - d]).mean(1) if len(i) else np.zeros(0)


def _proposed(rows: pa.Table, start: int, until: int, width: int, least: float) -> list[tuple[int, int]]:
    """All likely pairs of regions of FEW texts; in larger ones each row's likeliest pair, the longest prefix of equals."""
    few, out = rows.column("n").to_numpy() <= FEW, []
    best, at = np.full(rows.num_rows, least), np.full(rows.num_rows, -1)
    for d, (i, near) in enumerate(_pairs_in_order(rows, start, until, width), 1):
        full = few[i] & (near >= least)
        out += [(x, x - d) for x in i[full].tolist()]
        better = ~few[i] & ((near > best[i]) | ((at[i] < 0) & (near >= least)))
        best[i[better]], at[i[better]] = near[better], i[better] - d
    return out + [(x, int(at[x])) for x in np.flatnonzero(at >= 0).tolist()]


class _Labels:
    """Disjoint sets of labels, as they come."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x


def _resolved(labels: _Labels, percent: int):
    def work(rows: pa.Table, start: int, until: int, width: int, least: float) -> list[tuple[int, int]]:
        """Links across components: every likely pair is confirmed, refused, or has been joined by others."""
        label, items, out = rows.column("label").to_pylist(), rows.column("items"), []
        seen: list[list[int]] = [[] for _ in label]
        known = np.array(label)
        for d, (i, near) in enumerate(_pairs_in_order(rows, start, until, width), 1):
            for x in i[(near >= least) & (known[i] != known[i - d])].tolist():
                seen[x].append(x - d)
        sets: dict[int, np.ndarray] = {}
        of = lambda k: sets[k] if k in sets else sets.setdefault(k, np.frombuffer(items[k].as_py(), np.uint64))
        for x, others in enumerate(seen):
            sets.pop(x - width - 1, None)
            others = [j for j in others if labels.root(label[j]) != labels.root(label[x])]
            if others:
                for j in _linked(of(x), [of(j) for j in others], percent):
                    a, b = labels.root(label[x]), labels.root(label[others[j]])
                    if a != b:
                        labels.up[max(a, b)] = min(a, b)
                        out.append((x, others[j]))
        return out

    return work


def _linked(x: np.ndarray, others: list[np.ndarray], percent: int) -> list[int]:
    """Which of the others (sorted distinct hashes) share enough with x."""
    sizes = np.array([len(y) for y in others])
    fits = np.flatnonzero(100 * np.minimum(sizes, len(x)) >= percent * np.maximum(sizes, len(x)))
    if not len(fits):
        return []
    every = np.concatenate([others[k] for k in fits])
    hit = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    shared = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[fits])[:-1]]))
    return fits[100 * shared >= percent * (len(x) + sizes[fits] - shared)].tolist()


def _ends(rows: pa.Table, a: list[int], b: list[int]) -> tuple[pa.Array, pa.Array]:
    c = rows.column("c").to_numpy()
    x, y = c[np.array(a, np.int64)], c[np.array(b, np.int64)]
    return pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))


def _in_order(rows: DataFrame, percent: int, least: float, resolve: bool) -> DataFrame:
    """Pairs (a, b) of classes from rows (g, key, c, ...): one order is one run of g.

    Rows are range-partitioned and sorted by region, signature string and class, so a hot region is split.  A part keeps
    the last DENSE rows that it has seen; its first and last DENSE rows are written beside its pairs, and the last
    ones of a part meet the first ones of the next in a second pass over these borders only."""
    n, most = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n // PART, most), -(-n // LARGEST_PART))
    width, names = DENSE, rows.columns
    work_of = lambda: _resolved(_Labels(), percent) if resolve else _proposed
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("head", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, work, kept, heads = TaskContext.get().partitionId(), work_of(), None, 0

        def edge(of: pa.Table, head: bool) -> Iterator[pa.RecordBatch]:
            k = of.num_rows
            same = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([part] * k, pa.int32()), pa.array([head] * k, pa.bool_())]
            yield from pa.table([*same, *of.columns], [*kinds.names, *of.schema.names]).to_batches()

        for batch in batches:
            new = pa.Table.from_batches([batch])
            rows = (pa.concat_tables([kept, new]) if kept is not None else new).combine_chunks()
            start = rows.num_rows - new.num_rows
            found = work(rows, start, rows.num_rows, width, least)
            if found:
                a, b = _ends(rows, *map(list, zip(*found, strict=True)))
                none = [pa.nulls(len(a), f.type) for f in rows.schema]
                yield pa.record_batch([a, b, pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.bool_()), *none], [*kinds.names, *rows.schema.names])
            if heads < width and parts > 1:
                yield from edge(new.slice(0, width - heads), True)
                heads += new.num_rows
            kept = rows.slice(max(0, rows.num_rows - width))
        if kept is not None and parts > 1:
            yield from edge(kept, False)

    def across(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("head", "ascending"), ("g", "ascending"), ("key", "ascending"), ("c", "ascending")]).combine_chunks()
        start = rows.num_rows - sum(rows.column("head").to_pylist())
        found = work_of()(rows, start, start, width, least)
        return pa.table(_ends(rows, [x for x, _ in found], [y for _, y in found]), ["a", "b"])

    schema = "a long, b long, part int, head boolean, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.repartitionByRange(parts, "g", "key", "c").sortWithinPartitions("g", "key", "c").mapInArrow(run, schema)
    if parts == 1:
        return out.select("a", "b")
    out = stored(out)
    edges = out.where("a IS NULL").drop("a", "b")
    follows = F.broadcast(edges.select(F.col("part").alias("before")).distinct().withColumn("border", F.lead("before").over(W.orderBy("before"))))  # one row a part
    meet = edges.where("head").select("head", *names, F.col("part").alias("border")).unionByName(edges.where("NOT head").join(follows, F.col("part") == F.col("before")).where("border IS NOT NULL").select("head", *names, "border"))
    return out.where("a IS NOT NULL").select("a", "b").union(meet.groupBy("border").applyInArrow(across, "a long, b long"))


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [bool(_linked(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)], percent)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(digest, items): the shingle sets of the rows of docs (text, k) whose k is needed (k), each class once.

    Up to MOST_MARKED needed rows are marked in a bit map that is broadcast, 16 bits a row; the few rows that share a mark
    by chance are read as well, which costs their sets and changes nothing, and no text is shuffled.  More needed rows
    are joined with the texts."""
    n = needed.count()
    if n > MOST_MARKED:
        rows, wanted = docs.select("text", "k").join(needed.select("k").distinct(), "k", "left_semi").select("text", F.lit(0).cast("long").alias("at")), None
    else:
        bits = 1 << max(16, (16 * n - 1).bit_length() if n else 0)
        place = lambda k: F.pmod(k, F.lit(bits))
        at = needed.select(place(F.col("k")).alias("at"))
        words = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits")).toPandas()  # bits / 64 rows at most
        marks = np.zeros(bits // 64, np.int64)
        marks[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
        rows, wanted = docs.select("text", place(F.col("k")).alias("at")), docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if wanted is not None:
                at = whole.column(1).to_numpy()
                whole = whole.filter(pa.array((wanted.value[at // 64] >> (at % 64)) & 1 == 1))
            for batch in pieces(whole):
                w = Words(batch.column(0))
                sets = [shingles(w.hashes[w.rows[i] : w.rows[i + 1]]) for i in range(len(w.rows) - 1)]
                sets = [s for s in sets if len(s)]
                yield pa.record_batch([pa.array([_class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "items"])

    sets = stored(rows.mapInArrow(run, "digest binary, items binary"))
    if sets.groupBy("digest").count().where("count > 1").limit(1).count():  # rows repeat, or marks meet
        sets = stored(sets.groupBy("digest").agg(F.first("items").alias("items")))
    return sets


def _size_class(n: int) -> int:
    return int(np.log(n) / np.log(1.25) + 1e-9)


def _counters(texts: DataFrame) -> np.ndarray:
    """How often shingles occur in texts (items), by hash: never less than the truth.  Any counts give right results, as long as all
    texts are ordered by the same ones; good ones put a region's own shingles behind each text's."""
    n = texts.agg(F.sum(F.octet_length("items"))).first()[0] // 8
    size = min(max(LEAST_COUNTERS, 1 << (2 * n - 1).bit_length()), MOST_COUNTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for items in batch.column(0):
                np.add.at(total, np.frombuffer(items.as_buffer(), np.uint64) % np.uint64(size), 1)
        for k in range(0, size, 1 << 16):
            at = k + np.flatnonzero(total[k : k + (1 << 16)])
            yield pa.record_batch([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = texts.select("items").mapInArrow(run, "at long, n long").groupBy("at").agg(F.least(F.sum("n"), F.lit(2**31)).alias("n"))
    out = np.zeros(size, np.uint32)
    for batch in rows.toArrow().to_batches():  # one row a counter
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _rare(percent: int, sent):
    """Of each text (c, label, items) the shingles that a link can begin with, rarest first, as rows (token, band, probe, c,
    label, n, most).

    A text with n shingles and its place's `rest` (itself and all commoner ones) can only link, if this is the first
    shingle that both hold, with texts of up to most = rest * (100 + percent) / percent - n shingles.  It waits for longer
    partners in its own band of sizes, and asks the bands of shorter ones.  Shingles of one text alone meet nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for batch in batches:
            out: list[tuple] = []
            for c, label, items in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                s = np.frombuffer(items, np.uint64)
                n = len(s)
                often = counts[s % np.uint64(len(counts))]
                order = np.lexsort((s, often))
                most = (n - np.arange(n)) * (100 + percent) // percent - n
                least = -(-percent * n // 100)
                use = np.flatnonzero((most >= least) & (often[order] > 1))
                own = _size_class(n)
                for token, u in zip(s[order[use]].view(np.int64).tolist(), most[use].tolist(), strict=True):
                    if u >= n:
                        out.append((token, own, False, c, label, n, u))
                    out += [(token, k, True, c, label, n, u) for k in range(_size_class(least), _size_class(min(u, n)) + 1)]
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], ["token", "band", "probe", "c", "label", "n", "most"])

    return run


def _meet(percent: int):
    """Pairs (a, b) of texts of different labels that may link by a shingle, from rows in order of (token, band, part)."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        get = lambda k: rows.column(k).to_numpy(zero_copy_only=False)
        probe, c, label, n, most = (get(k) for k in ("probe", "c", "label", "n", "most"))
        wait = np.flatnonzero(~probe)
        wait = wait[np.argsort(n[wait], kind="stable")]
        ask = np.flatnonzero(probe)
        if not len(wait) or len(np.unique(label)) < 2:
            return
        low = np.searchsorted(n[wait], -(-percent * n[ask] // 100))
        high = np.searchsorted(n[wait], np.minimum(most[ask], n[ask]), side="right")
        a, b = [], []
        for i, x, y in zip(ask.tolist(), low.tolist(), high.tolist(), strict=True):
            if x < y:
                j = wait[x:y]
                j = j[(most[j] >= n[i]) & (label[j] != label[i])]
                a.append(np.full(len(j), c[i]))
                b.append(c[j])
            if len(a) >= 256 or i == ask[-1]:
                x, y = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (a, b))
                yield pa.record_batch([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
                a, b = [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (pa.concat_tables([kept, rows]) if kept is not None else rows).combine_chunks()
            keys = [rows.column(k).to_numpy() for k in ("token", "band", "part")]
            cut = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            for x, y in zip([0, *cut[:-1].tolist()], cut.tolist(), strict=False):
                if y - x > 1:
                    yield from pairs(rows.slice(x, y - x))
            kept = rows.slice(int(cut[-1]) if len(cut) else 0)
        if kept is not None and kept.num_rows > 1:
            yield from pairs(kept.combine_chunks())

    return run


def _rare_pairs(texts: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of texts (c, label, items) of different labels that may be links: an exact join on rare shingles.

    Two sets that link share, in any common order, a shingle before which neither has too many others; with the rarest
    first, what a region's texts all share comes last and is no such shingle unless it alone makes a link.  Texts that
    hold a very common one of these meet in parts, each of which sees all that ask."""
    sent = texts.sparkSession.sparkContext.broadcast(_counters(texts))
    rows = stored(texts.select("c", "label", "items").mapInArrow(_rare(percent, sent), "token long, band long, probe boolean, c long, label long, n long, most long"))
    hot = rows.where("NOT probe").groupBy(F.col("token").alias("t"), F.col("band").alias("b")).count().where(F.col("count") > TOGETHER)
    hot = hot.select("t", "b", F.ceil(F.col("count") / TOGETHER).alias("parts"))
    dealt = rows.join(hot, (F.col("token") == F.col("t")) & (F.col("band") == F.col("b")), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    dealt = dealt.select("token", "band", F.explode(F.when(F.col("probe"), every).otherwise(F.array(F.pmod(F.xxhash64("c"), F.col("parts"))))).alias("part"), "probe", "c", "label", "n", "most")
    return dealt.repartition("token", "band", "part").sortWithinPartitions("token", "band", "part").mapInArrow(_meet(percent), "a long, b long").distinct()


def _with_keys(docs: DataFrame, keys: DataFrame, how: str, on: str = "doc_id") -> DataFrame:
    """Semi or anti join by a key; the keys are broadcast if they are known to be few."""
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, on, how)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id long, text).

    Two texts are linked if 100 * shared >= percent * all of their distinct 5-word shingles; component_id is the
    smallest doc_id reachable, kept its equality with doc_id.  Equal shingle sets are one class from the start, so
    copies cost one aggregation.  Texts without words have no shingles and no links; rows with a null id stay alone
    (component null, kept); repeated rows repeat in the result, and equal ids with different texts are separate texts;
    very long texts are read in full.  Other columns are not read, so their names can't clash.

    First turn: in each order, regions of FEW texts propose all likely pairs, a text of a larger one its likeliest pair
    among the DENSE neighbours before it; full sets confirm or refuse them, components join.  Second turn: in regions
    of up to DENSE texts that still lie in several components, every likely pair across them is confirmed or refused on
    full sets; texts of larger ones, which share prefixes at any depth that leaves few, are joined exactly on their rare
    shingles.  A link is lost only if its texts share no prefix in any order (chance 3e-5 at similarity 0.8, 4e-7 at
    0.85) or their estimate from 80 hashes is 4 deviations too low (3e-5; not in regions of more than DENSE)."""
    found = _found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), percent)
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _found(docs: DataFrame, percent: int) -> DataFrame:
    """near_duplicates with the class of each row's shingle set (digest) and without kept."""
    feats, of_class = _grouped(docs, percent, F.col("doc_id").isNotNull(), F.min("doc_id"))
    return feats.join(of_class, (F.col("digest") == F.col("d")) & F.col("doc_id").isNotNull(), "left").select("doc_id", "n_shingles", F.col("first").alias("component_id"), "digest")


def _grouped(docs: DataFrame, percent: int, takes_part: Column, first: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of docs (doc_id, text, ...) without texts and with n_shingles, digest and sig; and (d, first): of each
    class of rows that take part, the least `first` of its component."""
    docs = docs.select("text", F.xxhash64("doc_id", "text").alias("k"), *[c for c in docs.columns if c != "text"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    feats = stored(docs.mapInArrow(_features, kinds + ", n_shingles long, digest binary, sig binary"))
    classes = feats.where(F.col("digest").isNotNull() & takes_part).groupBy("digest").agg(first.alias("first"), F.min("k").alias("k"), F.first("sig").alias("sig"))
    classes = stored(classes.withColumn("c", F.monotonically_increasing_id()))
    labels = _labels(docs, classes, percent)
    joined = classes.select("c", "digest", "first").join(labels, F.col("c") == F.col("node"), "left").select("digest", "first", F.coalesce("label", "c").alias("label"))
    least = joined.groupBy(F.col("label").alias("l")).agg(F.min("first").alias("least"))
    return feats, joined.join(least, F.col("label") == F.col("l")).select(F.col("digest").alias("d"), F.col("least").alias("first"))


def _labels(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    least = percent / 100 - 4 * (percent / 100 * (1 - percent / 100) / HASHES) ** 0.5
    trees = classes.select("c", "sig").mapInArrow(_prefixes, "c long, g long, tree int")
    groups = trees.groupBy("g").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.bit_xor(F.xxhash64("c")).alias("x"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("y")).where("n > 1")
    # equal regions of several trees count once where all their pairs are proposed
    groups = groups.groupBy("n", "low", "x", "y", F.when(F.col("n") > FEW, F.col("g")).alias("_g")).agg(F.min("g").alias("own"))
    groups = stored(groups.select("own", "n"))
    few = groups.count() <= BROADCAST_IDS
    members = stored(trees.join(F.broadcast(groups) if few else groups, F.col("g") == F.col("own")).select("c", "g", "tree", "n"))
    of = classes.select(F.col("c").alias("k_c"), "sig", "digest", "k")

    def strings(rows: DataFrame, *more: str) -> DataFrame:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("sig", "tree"))
        return rows.select("sig", "tree", "c", "g", *more).mapInArrow(_strings, "key binary, " + kinds).select("g", "key", "c", *more)

    ordered = stored(strings(members.join(of.select("k_c", "sig"), F.col("c") == F.col("k_c")).select("sig", "tree", "c", "g", "n"), "n"))
    pairs = _in_order(ordered, percent, least, False).distinct()
    needed = members.select("c").distinct().join(of.select("k_c", "k"), F.col("c") == F.col("k_c")).select("k")
    sets = _sets(docs, needed)
    of_digest = stored(of.select("k_c", "digest").join(sets.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d")).select("k_c", "items"))
    one, two = (of_digest.select(F.col("k_c").alias(c), F.col("items").alias(x)) for c, x in (("c1", "x"), ("c2", "y")))

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(one, F.col("a") == F.col("c1")).join(two, F.col("b") == F.col("c2"))
        return stored(both.select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a long, b long, linked boolean").where("linked").select("a", "b"))

    links = confirmed(pairs)
    labels = stored(components(links))

    rows = members.where(F.col("n") > FEW).join(labels, F.col("c") == F.col("node"), "left").select("g", "tree", "n", "c", F.coalesce("label", "c").alias("label"))
    rows = stored(rows)
    undecided = rows.groupBy("g").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).where("l1 <> l2").select(F.col("g").alias("og"))
    rows = stored(rows.join(undecided, F.col("g") == F.col("og"), "left_semi"))
    if not rows.limit(1).count():
        return labels
    found = links
    middle = rows.where(F.col("n") <= DENSE).select("c", "g", "tree", "label").join(of.select("k_c", "sig"), F.col("c") == F.col("k_c")).select("sig", "tree", "c", "g", "label")
    middle = middle.join(of_digest, F.col("c") == F.col("k_c")).select("sig", "tree", "c", "g", "label", "items")
    found = found.union(stored(_in_order(stored(strings(middle, "label", "items")), percent, least, True)))
    dense = stored(rows.where(F.col("n") > DENSE).select("c", "label").distinct().join(of_digest, F.col("c") == F.col("k_c")).select("c", "label", "items"))
    if dense.limit(1).count():
        found = found.union(confirmed(_rare_pairs(dense, percent)))
    return stored(components(found))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 85)


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (similarity 0.8 or more) stays: of the smallest doc_id (null last), of its
    rows the first in the table.  Rows are told apart by their place in the files of docs, not by id, so rows of one
    id with different texts, rows repeated with one id, and rows with a null id each count as what they are.  Texts
    without words are near nothing and stay.  Other columns of docs are left out."""
    docs = docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_row"))
    feats, of_class = _grouped(docs.select("doc_id", "text", "_row"), 80, F.lit(True), F.min(place))
    gone = stored(feats.join(of_class, F.col("digest") == F.col("d")).where(F.col("_row") != F.col("first._row")).select("_row"))
    return _with_keys(docs, gone, "left_anti", "_row").select(*COLUMNS)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * shared >= 85 * (len(a.s) + len(b.s) - shared)),
u AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, u.y FROM r JOIN u ON r.y = u.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.y) AS component_id, s.doc_id = min(r.y) AS kept
FROM s JOIN r ON r.x = s.doc_id GROUP BY s.doc_id, s.s
"""
