"""Prefix trie of conversations by vertical bitmaps: conversations are cut into shards, a shard's index holds for each
(position, turn) the bit set of its conversations, and a depth-first walk intersects a node's set with postings to get
its children, its size and who ends there.  Nodes of all shards are merged by their path."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import stored, table

#: Conversations that share a head, and the most turns that a head takes.
GROUP, HEAD = 5, 8
#: Depths of a band: longer conversations are walked in pieces of so many turns.
BAND = 1024
#: Conversations and turns of a shard.
SHARD, SHARD_TURNS = 4096, 1 << 16


def rebuilt(conversations: DataFrame, group: int = GROUP, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, length), one row each, and their turns (c, pos, a1, a2, bytes) after rebuilding.

    Turns are ordered by turn (null first); turns that tie are ordered by the SHA-256 of role and text, so repeated rows are
    turns of their own and any order of the input gives the same.  Null roles and texts are empty; rows without a
    conv_id belong to no conversation.  Conversation c becomes the first h turns of conversation c - c % group and
    its own turns after its first h, h = crc32(decimal c) % (head + 1).  A turn is known by its length in bytes and
    128 bits of hash over its place, role and text; texts are not shuffled."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn"), F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    turns = stored(numbered(turns, ["c"], ["turn", "digest"], "pos").drop("turn"))
    ids = turns.groupBy("c").agg(F.count("*").alias("n"))
    first = turns.where((F.col("c") % group == 0) & (F.col("pos") <= head)).groupBy(F.col("c").alias("g")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head"))
    ids = ids.withColumns({"h": F.crc32(F.col("c").cast("string")) % (head + 1), "of": F.col("c") - F.col("c") % group})
    ids = ids.join(first, F.col("of") == F.col("g"), "left").withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("h").cast("int")))
    ids = stored(ids.withColumn("k", F.size("head").cast("long")).withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("c", "h", "k", "head", "length"))
    taken = ids.select("c", F.explode("head").alias("t")).select("c", "t.pos", "t.digest", "t.bytes")
    shift = ids.select(F.col("c").alias("_c"), (F.col("h") - F.col("k")).alias("shift"))
    h = F.crc32(F.col("c").cast("string")) % (head + 1)
    own = turns.where(F.col("pos") > h).join(shift, F.col("c") == F.col("_c")).select("c", (F.col("pos") - F.col("shift")).alias("pos"), "digest", "bytes")
    both = taken.union(own)
    return ids.select("c", "length"), both.select("c", "pos", F.xxhash64("pos", "digest").alias("a1"), F.xxhash64("digest", F.lit(11), "pos").alias("a2"), "bytes")


def _pieces(ids: DataFrame, turns: DataFrame, size: int) -> DataFrame:
    """(band, c, length, k1, k2, a1, a2, bytes): each conversation's turns in pieces of `size`, with the key of the path before
    the piece, the exclusive or of its turns' hashes.  Conversations without turns are a piece without turns."""
    turn = F.struct("pos", "a1", "a2", "bytes")
    packed = turns.groupBy("c", F.floor((F.col("pos") - 1) / size).alias("band")).agg(F.sort_array(F.collect_list(turn)).alias("t"), F.bit_xor("a1").alias("x1"), F.bit_xor("a2").alias("x2"))
    before = W.partitionBy("c").orderBy("band").rowsBetween(W.unboundedPreceding, -1)  # one row for `size` turns
    packed = packed.withColumns({k: F.coalesce(F.bit_xor(x).over(before), F.lit(0)) for k, x in (("k1", "x1"), ("k2", "x2"))})
    rows = ids.join(packed.withColumnRenamed("c", "_c"), F.col("c") == F.col("_c"), "left")
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("long")
    parts = [F.coalesce(F.col(f"t.{x}"), none).alias(x) for x in ("a1", "a2", "bytes")]
    return rows.select(F.coalesce("band", zero).alias("band"), "c", "length", F.coalesce("k1", zero).alias("k1"), F.coalesce("k2", zero).alias("k2"), *parts)


_NODES = "shard long, pre long, until long, depth long, top boolean, k1 long, k2 long, p1 long, p2 long, n long, least long, bytes long, ends binary, on array<bigint>"


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def walk(start: int, pieces: list[tuple[int, int, int, int, list[int], list[int], list[int]]]) -> Iterator[tuple]:
    """The nodes of one shard in depth-first order, from pieces (c, length, k1, k2, a1, a2, bytes) of a band of depths from `start`:
    (depth, top, k1, k2, p1, p2, members' number, smallest c, bytes, c's that end, c's that go on in the next band).

    The tops are the paths before the pieces; in bands after the first they repeat the last nodes of the band before."""
    tops: dict[tuple[int, int], int] = {}
    postings: dict[tuple[int, int, int], int] = {}
    stop: dict[int, int] = {}
    for i, (_, _, k1, k2, a1, a2, _) in enumerate(pieces):
        bit = 1 << i
        tops[k1, k2] = tops.get((k1, k2), 0) | bit
        stop[len(a1)] = stop.get(len(a1), 0) | bit
        for j, turn in enumerate(zip(a1, a2, strict=True)):
            postings[j, *turn] = postings.get((j, *turn), 0) | bit
    todo = [(members, 0, k1, k2, None, None, 0) for (k1, k2), members in reversed(tops.items())]
    while todo:
        members, j, k1, k2, p1, p2, size = todo.pop()
        stopped = members & stop.get(j, 0)
        ends = [pieces[i][0] for i in _bits(stopped) if pieces[i][1] == start + j]
        on = [pieces[i][0] for i in _bits(stopped) if pieces[i][1] > start + j]
        yield start + j, j == 0 and start > 0, k1, k2, p1, p2, members.bit_count(), pieces[(members & -members).bit_length() - 1][0], size, ends, on
        rest, children = members ^ stopped, []
        while rest:  # a child a posting that meets the rest
            i = (rest & -rest).bit_length() - 1
            x1, x2, size = (pieces[i][f][j] for f in (4, 5, 6))
            child = rest & postings[j, x1, x2]
            children.append((child, j + 1, k1 ^ x1, k2 ^ x2, k1, k2, size))
            rest ^= child
        todo += reversed(children)


def _walked(size: int, most: int, most_turns: int):
    """Rows of _pieces in order of (band, c), cut into shards of `most` pieces and `most_turns` turns, as the shards' nodes."""
    schema = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}[k]) for n, k in (x.split() for x in _NODES.split(", "))])

    def nodes(shard: int, band: int, held: list[tuple]) -> pa.RecordBatch:
        depth, *rest = map(list, zip(*walk(band * size, held), strict=True))
        top, k1, k2, p1, p2, n, least, length, ends, on = rest
        until, path = [len(depth)] * len(depth), []
        for i, d in enumerate(depth):
            while path and depth[path[-1]] >= d:
                until[path.pop()] = i
            path.append(i)
        ends = [",".join(map(str, e)).encode() if e else None for e in ends]
        columns = [shard] * len(depth), range(len(depth)), until, depth, top, k1, k2, p1, p2, n, least, length, ends, on
        return pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, turns, of = TaskContext.get().partitionId() << 32, [], 0, None
        for batch in batches:
            for band, *piece in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (band != of or len(held) == most or turns + len(piece[4]) > most_turns):
                    yield nodes(shard, of, held)
                    shard, held, turns = shard + 1, [], 0
                of = band
                held.append(tuple(piece))
                turns += len(piece[4])
        if held:
            yield nodes(shard, of, held)

    return run


def _by_shard(work: Callable[[pa.Table], pa.Table]):
    """Calls work on the rows of each shard; rows come in order of shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([kept, rows]) if kept is not None else rows
            shard = rows.column("shard").to_numpy()
            cut = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *cut[:-1]], cut, strict=False):
                yield from work(rows.slice(a, b - a)).to_batches()
            kept = rows.slice(cut[-1] if len(cut) else 0).combine_chunks()
        if kept is not None and kept.num_rows:
            yield from work(kept).to_batches()

    return run


def _subtrees(rows: pa.Table) -> pa.Table:
    """Sums over the subtrees of one shard, as differences of running sums in depth-first order.

    A node counts in the shard of its smallest member alone, where its whole path is present; so the sums of the shards
    add up to those of the trie."""
    get = lambda c: rows.column(c).to_numpy(zero_copy_only=False)
    pre, until, depth, top = get("pre"), get("until"), get("depth"), get("top")
    mine = (get("least") == get("owner")) & ~top
    saved = np.where(mine, (get("total") - 1) * get("bytes"), 0) + get("saved_on")
    leaves = np.where(mine & (get("children") == 0), 1, 0) + get("leaves_on")
    total = lambda x: np.concatenate([[0], np.cumsum(x)])
    s, v = total(saved), total(leaves)
    parent = np.full(len(pre), -1)
    path: list[int] = []
    for i, d in enumerate(depth.tolist()):
        while path and depth[path[-1]] >= d:
            path.pop()
        parent[i] = path[-1] if path else -1
        path.append(i)
    owner = get("owner")
    keep = np.flatnonzero(~top)
    above = pa.array(owner[parent[keep]], pa.int64(), mask=parent[keep] < 0)
    out = {n: rows.column(n).take(keep) for n in ("k1", "k2", "depth", "owner", "total", "children")}
    return pa.table(out | {"parent": above, "saved": pa.array(s[until[keep]] - s[pre[keep]]), "leaves": pa.array(v[until[keep]] - v[pre[keep]])})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end lists, joined by commas, from rows (k1, k2, ends) in order: one state, however many."""
    of, state = None, None
    row = lambda: pa.record_batch([pa.array([of[0]]), pa.array([of[1]]), pa.array([state.hexdigest()])], ["k1", "k2", "ends_sha256"])
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for k1, k2, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if (k1, k2) == of:
                state.update(b",")
            else:
                if state:
                    done.append((*of, state.hexdigest()))
                of, state = (k1, k2), hashlib.sha256()
            state.update(ends)
        if done:
            yield pa.record_batch([pa.array(x) for x in zip(*done, strict=True)], ["k1", "k2", "ends_sha256"])
    if state:
        yield row()


def prefix_trie(conversations: DataFrame, group: int = GROUP, head: int = HEAD, piece: int = BAND, shard: int = SHARD, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (see rebuilt()): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    Shards hold neighbours in order of conv_id, `shard` of them and `shard_turns` turns at most, so a hot first turn or a
    path that a third of all conversations share is spread over shards, and a node is a row a shard there.  Conversations
    of more than `piece` turns are walked in pieces.  Lists of ends are kept as one text a node and shard and hashed as a
    stream, so a node where many end is never gathered.  An empty table has no node, not even the root; other columns
    are not read."""
    ids, turns = rebuilt(conversations, group, head)
    pieces = _pieces(ids, turns, piece)
    nodes = stored(pieces.repartitionByRange("band", "c").sortWithinPartitions("band", "c").mapInArrow(_walked(piece, shard, shard_turns), _NODES))
    real = nodes.where("NOT top")
    merged = real.groupBy("k1", "k2").agg(F.sum("n").alias("total"), F.min("least").alias("owner"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("depth").alias("d"), F.first("bytes").alias("size"))
    merged = stored(merged)
    children = merged.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count("*").alias("children"))
    known = merged.join(children, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left").select(F.col("k1").alias("m1"), F.col("k2").alias("m2"), "total", "owner", F.coalesce("children", F.lit(0)).alias("children"), "d", "size")
    known = stored(known)
    # what a conversation owns in later bands counts where its piece stops
    band = F.when(F.col("d") == 0, F.lit(0)).otherwise(F.floor((F.col("d") - 1) / piece))
    later = known.where(F.col("d") > piece).groupBy("owner", band.alias("band")).agg(F.sum((F.col("total") - 1) * F.col("size")).alias("s"), F.count_if(F.col("children") == 0).alias("v"))
    stops = nodes.select("shard", "pre", F.explode("on").alias("o"), F.floor((F.col("depth") - 1) / piece).alias("b")).join(later, (F.col("o") == F.col("owner")) & (F.col("band") > F.col("b")))
    stops = stops.groupBy(F.col("shard").alias("s_shard"), F.col("pre").alias("s_pre")).agg(F.sum("s").alias("saved_on"), F.sum("v").alias("leaves_on"))
    rows = nodes.drop("n", "p1", "p2", "ends", "on").join(known.drop("d", "size"), (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")))
    rows = rows.join(stops, (F.col("shard") == F.col("s_shard")) & (F.col("pre") == F.col("s_pre")), "left").na.fill(0, ["saved_on", "leaves_on"])
    rows = rows.drop("m1", "m2", "s_shard", "s_pre").repartition("shard").sortWithinPartitions("shard", "pre")
    sums = rows.mapInArrow(_by_shard(_subtrees), "k1 long, k2 long, depth long, owner long, total long, children long, parent long, saved long, leaves long")
    sums = sums.groupBy("k1", "k2").agg(F.first("depth").alias("depth"), F.first("owner").alias("owner"), F.first("total").alias("total"), F.first("children").alias("children"), F.first("parent", ignorenulls=True).alias("parent"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    ends = real.where("ends IS NOT NULL").select("k1", "k2", "ends", "least").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "least")
    ends = ends.drop("least").mapInArrow(_hashed, "k1 long, k2 long, ends_sha256 string").withColumnsRenamed({"k1": "e1", "k2": "e2"})
    out = sums.join(ends, (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("total").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda u, z: xor(u >> 1, 3988292384 * (u & 1)))), 4294967295)"""

OP12_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT c, list(turn ORDER BY pos) AS own, {_CRC} % 9 AS h FROM t GROUP BY c),
r AS (SELECT a.c, list_concat(coalesce(g.own, [])[1:a.h], a.own[a.h + 1:]) AS s FROM a LEFT JOIN a g ON g.c = a.c - a.c % 5),
m AS (SELECT c, len(s) AS l, s, unnest(range(0, len(s) + 1)) AS d FROM r),
p AS (SELECT s[1:d] AS path, d, min(c) AS c, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE l = d), '') AS ends FROM m GROUP BY ALL),
e AS (SELECT p.path, p.d, p.c, p.n, p.ends, count(k.d) AS kids FROM p LEFT JOIN p k ON k.d = p.d + 1 AND k.path[1:k.d - 1] = p.path GROUP BY ALL),
x AS (SELECT path[1:up] AS path, kids, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(path[d].t) END AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM e)),
s AS (SELECT path, count(*) FILTER (WHERE kids = 0) AS leaves, sum(saved)::BIGINT AS saved FROM x GROUP BY path)
SELECT e.c AS conv_id, e.d::BIGINT AS depth, q.c AS parent_conv_id, e.n AS n_convs, e.kids AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(e.ends) AS ends_sha256
FROM e JOIN s ON s.path = e.path LEFT JOIN e q ON q.d = e.d - 1 AND q.path = e.path[1:e.d - 1]
"""
