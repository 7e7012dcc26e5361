import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from docketry.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, c string, pos int, bytes long, owner long"


def brute(rows, group=5, head=8):
    """The contract with dictionaries of whole paths."""
    own = defaultdict(list)
    key = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, key(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    full = {}
    for c, turns in list(own.items()):
        h = zlib.crc32(str(c).encode()) % (head + 1)
        lead = c - (abs(c) % group) * (1 if c >= 0 else -1)
        full[c] = tuple(own.get(lead, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, cs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += kids[path] == 0
            saved[path[:d]] += (len(cs) - 1) * len(path[-1][1].encode()) if path else 0
    sha = lambda cs: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()
    return sorted((cs[0], len(p), members[p[:-1]][0] if p else None, len(cs), kids[p], leaves[p], saved[p], sha([c for c in cs if len(full[c]) == len(p)])) for p, cs in members.items())


def rows_of(spark, rows, **sizes):
    out = trie.prefix_trie(spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA), **sizes)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in out.collect())


def corpus(seed, n, words, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        if c % 5 == 3 and rng.random() < 0.2:
            continue
        turns = [(rng.choice(["user", "", None]), rng.choice(words)) for _ in range(rng.randrange(longest + 1))]
        rows += [(c, k if rng.random() < 0.9 else None, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(n + 5, 0, "user", "only")] * 3 + [(None, 0, "user", "no conversation"), (10**12, 0, "user", "é日"), (10**12 + 1, 5, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rows = corpus(seed, 150, ["a", "b", "ü", None], 12)
    assert rows_of(spark, rows) == brute(rows)


def test_bands_and_small_shards(spark):
    """Conversations of many pieces, shards of a few conversations or turns: the same rows."""
    rows = corpus(5, 80, ["a", "b"], 14)
    rows += [(500 + k, i, "user", f"long {i}") for k in range(4) for i in range(40 - 3 * (k == 2))]
    assert rows_of(spark, rows, piece=3, shard=7, shard_turns=20) == brute(rows)


def test_edges(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(None, 1, "user", "x")]) == []
    # conversation 1 takes its first two turns from conversation 0, which is absent: with h above its length only the root is left
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(alone, 0, "user", "gone"), (alone, 1, "user", "gone too")]
    assert rows_of(spark, rows) == brute(rows) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    same = [(c, t, "user", "x" * 5000) for c in range(60) for t in range(9)]
    assert rows_of(spark, same) == brute(same)


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in trie.op12_conversation_trie(spark, data).collect()) == brute(rows)
