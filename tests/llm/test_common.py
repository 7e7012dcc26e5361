import numpy as np
import pyarrow as pa
import pytest

from docketry.llm import common as C


def texts():
    return ["One two", None, "", " \t\n\v\f\r", "É a\x1cb", "x" * 3_000_000 + " y", "  lead and trail  ", "ONE two"]


def test_words_match_a_plain_split():
    import re

    w = C.Words(pa.array(texts()))
    for i, t in enumerate(texts()):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        want = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
        a, b = w.rows[i], w.rows[i + 1]
        assert [bytes(w.raw[s:e]).decode() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] == want
    assert (w.hashes[w.rows[0] : w.rows[1]] == w.hashes[w.rows[7] : w.rows[8]]).all() and len(np.unique(w.hashes)) == len(w.hashes) - 2


def test_words_of_slices():
    column = pa.array(["a b", "c", "a b c d e f"])
    whole, part = C.Words(column), C.Words(column[2:])
    assert (whole.hashes[3:] == part.hashes).all() and len(C.shingles(part.hashes)) == 2
    assert len(C.shingles(part.hashes[:3])) == 1 and len(C.shingles(part.hashes[:0])) == 0
    assert len(C.Words(pa.array([], pa.string())).hashes) == 0


def test_latin_and_prefixes():
    w = C.Words(pa.array(["RÉEUXMENT réeuxment ×"]), latin=True, prefixes=(4, 6))
    assert w.hashes[0] == w.hashes[1] and (w.heads[0] == w.heads[1]).all() and (w.heads[2] == 0).all()
    assert bytes(w.raw[w.starts[2] : w.ends[2]]).decode() == "×"


def test_pieces():
    batch = pa.record_batch([pa.array(["a" * 10, None, "b" * 100, "", "c" * 5])], ["t"])
    parts = [p.num_rows for p in C.pieces(batch, 0, 20, 2)]
    assert sum(parts) == 5 and max(parts) <= 2
    assert [p.num_rows for p in C.pieces(batch.slice(0, 0))] == []


def test_shared_folder(spark):
    assert C.shared_dir(spark) != C.shared_dir(spark)
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert sorted(map(tuple, C.stored(df).collect())) == [(1, None), (2, "x")]


@pytest.mark.parametrize("column", [pa.chunked_array([["a"], ["b c"]]), pa.array(["a", "b c"], pa.large_string())])
def test_column_kinds(column):
    assert len(C.Words(column).hashes) == 3
