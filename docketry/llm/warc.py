"""WARC records and a Merkle fixity audit: records and ordered offset ranges are hashed into trees, replica roots
are compared, and only branches that differ are followed down to the corrupt records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

#: Records of a file, and children of a node.
FILE_RECORDS, FANOUT = 512, 8
#: Files (numbered below 0) that records of null ids are dealt over by their digest.
NULL_FILES = 1 << 20


def warc_record(record_id: Column, uri: Column, payload: Column) -> Column:
    """The bytes of one WARC/1.1 resource record: header lines, a blank line, the block, two line ends."""
    block = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("null")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(uri, F.lit(""))),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.sha2(block, 256)),
        F.concat(F.lit("Content-Length: "), F.length(block)), F.lit(""), F.lit(""),
    )
    return F.concat(head.cast("binary"), block, F.lit("\r\n\r\n").cast("binary"))


def archive(pages: DataFrame) -> DataFrame:
    """(file, seq, page_id, digest, length): each page as a record of file page_id div FILE_RECORDS.

    The record's place in its file is its order by page_id, then digest; null ids are dealt over NULL_FILES files by
    digest.  Repeated pages are records of their own.  Null urls and texts are empty.  A record is hashed as it is read,
    however long; other columns of pages are not read."""
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(record, 256).alias("digest"), F.length(record).cast("long").alias("length"))
    return rows.withColumn("file", F.coalesce(F.floor(F.col("page_id") / FILE_RECORDS), -1 - F.pmod(F.xxhash64("digest"), F.lit(NULL_FILES))))


def with_offsets(records: DataFrame) -> DataFrame:
    """Adds seq and offset of each record in its file.  Files hold FILE_RECORDS ids, so a window is bounded unless ids
    repeat; equal (page_id, digest) rows are counted once each with the number of copies, which keeps a page that
    repeats without bound one row."""
    rows = records.groupBy("file", "page_id", "digest", "length").agg(F.count("*").alias("copies"))
    order = W.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "digest")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("seq", F.row_number().over(order) - 1).withColumn("offset", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0)).cast("long"))


def merkle(records: DataFrame) -> DataFrame:
    """(level, node, file, hash, first_offset, end_offset): level 0 holds the records' leaves, each level above a node
    for FANOUT ordered neighbours, up to one node a file; a last level, -1, holds the root over the files' nodes.

    A leaf's hash covers the record's digest, its copies and its offset range."""
    span = (F.col("offset") + F.col("length") * F.col("copies")).alias("end_offset")
    leaf = F.sha2(F.concat_ws("|", "digest", "copies", "offset", "length"), 256)
    level = records.select(F.lit(0).alias("level"), F.col("seq").cast("long").alias("node"), "file", leaf.alias("hash"), F.col("offset").alias("first_offset"), span)
    # the height is one for all files: it fits the longest
    longest = records.agg(F.max("seq")).first()[0] or 0
    parts = [level]
    depth = 0
    while longest > 0:
        depth, longest = depth + 1, longest // FANOUT
        level = stored(level) if depth == 1 else level
        parts[-1] = level
        up = level.groupBy("file", F.floor(F.col("node") / FANOUT).alias("node"))
        level = up.agg(_ordered_hash("node").alias("hash"), F.min("first_offset").alias("first_offset"), F.max("end_offset").alias("end_offset"))
        level = level.select(F.lit(depth).alias("level"), "node", "file", "hash", "first_offset", "end_offset")
        parts.append(level)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _ordered_hash(key: str) -> Column:
    """Hash over at most FANOUT children in order."""
    children = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col("hash").alias("h"))))
    return F.sha2(F.array_join(F.transform(children, lambda x: x["h"]), ""), 256)


def _tops(tree: DataFrame, low: int, width: int) -> list[DataFrame]:
    """Levels above the files' nodes, (node, hash): FANOUT file numbers a node, counted from `low`, up to one node."""
    nodes = tree.where(F.col("level") == _height(tree)).select((F.col("file") - F.lit(low)).alias("node"), "hash")
    levels = [stored(nodes)]
    while width > 0:
        nodes = levels[-1].groupBy(F.floor(F.col("node") / FANOUT).alias("node")).agg(_ordered_hash("node").alias("hash"))
        levels.append(stored(nodes))
        width //= FANOUT
    return levels


def _height(tree: DataFrame) -> int:
    return tree.agg(F.max("level")).first()[0] or 0


def _span(*trees: DataFrame) -> tuple[int, int]:
    """The first file number of some trees, and how far the last is from it."""
    ends = [t.agg(F.min("file").alias("a"), F.max("file").alias("b")).first() for t in trees]
    ends = [(x["a"], x["b"]) for x in ends if x["a"] is not None]
    low = min((a for a, _ in ends), default=0)
    return low, max((b for _, b in ends), default=0) - low


def root(tree: DataFrame) -> DataFrame:
    """One row (hash) over all files, by levels of FANOUT over the file numbers; an empty archive has the hash of ''."""
    return _tops(tree, *_span(tree))[-1].agg(F.coalesce(F.max("hash"), F.sha2(F.lit("").cast("binary"), 256)).alias("hash"))


def _lifted(tree: DataFrame, height: int) -> DataFrame:
    """The tree with levels of one node a file on top, as high as another replica's."""
    own = _height(tree)
    top = tree.where(F.col("level") == own)
    for level in range(own + 1, height + 1):
        top = top.withColumns({"level": F.lit(level), "node": F.floor(F.col("node") / FANOUT), "hash": F.sha2(F.col("hash").cast("binary"), 256)})
        tree = tree.union(top)
    return tree


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Differing leaves of two trees: (file, node, first_offset, end_offset, left_hash, right_hash), null where a
    replica has no such node.

    The descent starts at the root over all files; each level, of files first and of records then, looks only below the
    nodes that differ, so equal branches are never compared.  A replica of less height is lifted to the other's.  Null
    ids, repeats, empty archives and very long records are what archive() makes of them."""
    height = max(_height(left), _height(right))
    a, b = (stored(_lifted(t, height)) for t in (left, right))
    span = _span(a, b)
    differing = None
    for x, y in zip(reversed(_tops(a, *span)), reversed(_tops(b, *span)), strict=True):
        both = [t if differing is None else _below(t, differing, "node", []) for t in (x, y)]
        x, y = both[0].select("node", F.col("hash").alias("left_hash")), both[1].select("node", F.col("hash").alias("right_hash"))
        differing = stored(x.join(y, "node", "full").where(~F.col("left_hash").eqNullSafe(F.col("right_hash"))).select(F.col("node").alias("parent")))
        if not differing.limit(1).count():
            return _compare(a.limit(0), b.limit(0), 0)
    files = differing.select((F.col("parent") + F.lit(span[0])).alias("file"))
    a, b = (t.join(files, "file", "left_semi") for t in (a, b))
    differing = _compare(a, b, height)
    for level in range(height - 1, -1, -1):
        parents = stored(differing.select("file", F.col("node").alias("parent")))
        differing = _compare(*[_below(t.where(F.col("level") == level), parents, "node", ["file"]) for t in (a, b)], level)
    return differing


def _below(nodes: DataFrame, parents: DataFrame, node: str, keys: list[str]) -> DataFrame:
    return nodes.withColumn("parent", F.floor(F.col(node) / FANOUT)).join(parents, [*keys, "parent"], "left_semi").drop("parent")


def realign(left: DataFrame, right: DataFrame, differing: DataFrame) -> DataFrame:
    """What happened to the records at differing leaves: (file, page_id, left_seq, right_seq, change).

    `moved` stands in both replicas with one digest, at another place or offset or as another number of copies; `corrupt`
    has an id of both with different digests; `lost` is in the first only, `added` in the second only.  left and right:
    records with offsets.  Ids that repeat with several digests meet by digest first, then in order."""
    at = differing.select("file", F.col("node").alias("seq"))
    pick = lambda t: t.join(at, ["file", "seq"], "left_semi").select("file", "page_id", "digest", F.col("seq").cast("long").alias("seq"))
    a, b = pick(left), pick(right)
    same = lambda x, y, *more: F.col(f"{x}.file").eqNullSafe(F.col(f"{y}.file")) & F.col(f"{x}.page_id").eqNullSafe(F.col(f"{y}.page_id")) & (F.lit(True) if not more else F.col(f"{x}.{more[0]}") == F.col(f"{y}.{more[0]}"))
    moved = a.alias("a").join(b.alias("b"), same("a", "b", "digest")).select("a.file", "a.page_id", F.col("a.seq").alias("left_seq"), F.col("b.seq").alias("right_seq"), F.lit("moved").alias("change"))
    number = lambda t: t.withColumn("k", F.row_number().over(W.partitionBy("file", "page_id").orderBy("seq")))
    x = number(a.alias("a").join(b.alias("b"), same("a", "b", "digest"), "left_anti"))
    y = number(b.alias("b").join(a.alias("a"), same("b", "a", "digest"), "left_anti"))
    rest = x.alias("x").join(y.alias("y"), same("x", "y", "k"), "full")
    change = F.when(F.col("y.seq").isNull(), "lost").when(F.col("x.seq").isNull(), "added").otherwise("corrupt")
    return moved.union(rest.select(F.coalesce("x.file", "y.file"), F.coalesce("x.page_id", "y.page_id"), F.col("x.seq"), F.col("y.seq"), change))


def _compare(a: DataFrame, b: DataFrame, level: int) -> DataFrame:
    keep = lambda t, side: t.where(F.col("level") == level).select("file", "node", F.col("hash").alias(f"{side}_hash"), F.col("first_offset").alias(f"{side}_from"), F.col("end_offset").alias(f"{side}_to"))
    both = keep(a, "left").join(keep(b, "right"), ["file", "node"], "full").where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))
    return both.select("file", "node", F.coalesce("left_from", "right_from").alias("first_offset"), F.coalesce("left_to", "right_to").alias("end_offset"), "left_hash", "right_hash")


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with flipped characters: in one page of 97, by a digest of its id, one character of the text changes;
    lengths stay.  Pages without text stay whole."""
    key = F.md5(F.col("page_id").cast("string"))
    part = lambda k: F.conv(F.substring(key, k, 6), 16, 10).cast("long")
    hit = part(1) % 97 == 5
    at = (part(7) % F.length("html") + 1).cast("int")
    old = F.substr("html", at, F.lit(1))
    new = F.when(old == "x", "y").otherwise("x")
    flipped = F.concat(F.substr("html", F.lit(1), at - 1), new, F.substr("html", at + 1))
    return pages.withColumn("html", F.when(hit, F.when((F.length("html") > 0) & (F.octet_length(old) == 1), flipped).otherwise(F.col("html"))).otherwise(F.col("html")))


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the archive of `pages` with its offsets, and whether the replica's differs there."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    first, second = stored(with_offsets(archive(pages))), stored(with_offsets(archive(damaged(pages))))
    bad = audit(merkle(first), merkle(second)).select("file", F.col("node").alias("seq_bad"))
    out = first.join(bad, (first["file"] == bad["file"]) & (first["seq"] == bad["seq_bad"]), "left").select(first["file"], "page_id", "seq", "offset", "length", "copies", "digest", F.when(F.col("seq_bad").isNull(), "same").otherwise("differs").alias("status"))
    return out.select("file", "page_id", "seq", "offset", "length", "copies", "digest", "status")


_RECORD = """'WARC/1.1' || crlf || 'WARC-Type: resource' || crlf || 'WARC-Record-ID: <urn:page:' || page_id || '>' || crlf || 'WARC-Target-URI: ' || coalesce(url, '') || crlf
    || 'WARC-Block-Digest: sha256:' || sha256(h) || crlf || 'Content-Length: ' || strlen(h) || crlf || crlf || h || crlf || crlf"""
OP8_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, chr(13) || chr(10) AS crlf, md5(page_id::VARCHAR) AS m FROM pages),
a AS (SELECT page_id, h, {_RECORD} AS r, ('0x' || substr(m, 1, 6))::BIGINT % 97 = 5 AS hit, substr(h, (('0x' || substr(m, 7, 6))::BIGINT % length(h) + 1)::BIGINT, 1) AS old FROM p),
o AS (SELECT page_id, page_id // 512 AS file, sha256(r) AS digest, strlen(r)::BIGINT AS length, hit AND length(h) > 0 AND strlen(old) = 1 AS bad FROM a)
SELECT file, page_id, (row_number() OVER w - 1)::INTEGER AS seq, (sum(length) OVER w - length)::BIGINT AS offset, length, 1::BIGINT AS copies, digest,
  CASE WHEN bad THEN 'differs' ELSE 'same' END AS status
FROM o WINDOW w AS (PARTITION BY file ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING)
"""
