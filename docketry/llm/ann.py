"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals,
asymmetric distance tables and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

#: Documented bounds: the vectors that fit centroids and codebooks, and the coarse lists.
FIT_ROWS, MOST_LISTS = 16_384, 1024
#: Sampled queries that set how many lists are probed and how many rows are reranked, and the share of their exact
#: neighbours that the lists, and the rows in front by codes, must hold.
TRIED, NEEDED = 512, 0.995
#: Least number of rows that a query reranks exactly, over all lists together.
RERANK = 40
#: Units whose answers to a query are merged at a time.
FAN = 16
#: Bytes of a code; least rows of a unit, queries of a block; rows of a unit by the root of all rows.
CODE, BLOCK, ROOT = 16, 4096, 40


class Index(NamedTuple):
    centroids: np.ndarray  # lists x width, unit vectors padded to a multiple of CODE
    codebooks: np.ndarray  # CODE x 256 x (width / CODE)
    counts: np.ndarray  # rows of each list
    probes: int  # lists that a query looks into
    depth: int  # rows of the sample that hold its neighbours, in the order of the codes


def valid_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows with an id and a vector without null, non-finite or only zero components."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & (F.size(e) > 0) & ~bad & F.exists(e, lambda x: x != 0))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray, width: int) -> np.ndarray:
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))).astype(np.float32)


def _kmeans(x: np.ndarray, k: int, turns: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm by squared distance; an empty cell takes a random row."""
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(turns):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=k)
        total = np.stack([np.bincount(own, x[:, j], minlength=k) for j in range(x.shape[1])], 1)
        centres = (total / np.maximum(n, 1)[:, None]).astype(np.float32)
        if (n == 0).any():
            centres[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(1) / 2
    return np.concatenate([np.zeros(0, np.int64), *[(x[i : i + 2048] @ centres.T - half).argmax(1) for i in range(0, len(x), 2048)]])


def fit(sample: np.ndarray, lists: int, k: int = 5, asked: np.ndarray | None = None) -> Index:
    """Centroids and codebooks of the residuals; and what TRIED vectors need to find NEEDED of their exact k neighbours
    within the sample: the number of lists, nearest first, and of rows in the order of the codes.  asked marks the sample's
    queries: as many of these are tried by themselves, since they may lie elsewhere than most rows, and the larger need counts."""
    width = -(-sample.shape[1] // CODE) * CODE
    rng, x = np.random.default_rng(5), _unit(sample, width)
    centroids = _kmeans(x, lists, 12, rng)
    own = _nearest(x, centroids)
    parts = (x - centroids[own]).reshape(len(x), CODE, -1)
    codebooks = np.stack([_kmeans(np.ascontiguousarray(parts[:, m]), 256, 8, rng) for m in range(CODE)])
    decoded = centroids[own] + np.concatenate([codebooks[m][_nearest(np.ascontiguousarray(parts[:, m]), codebooks[m])] for m in range(CODE)], 1)
    k, order = min(k, len(x) - 1), rng.permutation(len(x))
    last = lambda found: int(np.quantile(np.concatenate(found), NEEDED, method="higher")) + 1
    needs = [(lists, 1)] if k < 1 else []
    for tried in ([order, order[asked[order]]] if asked is not None and asked.any() else [order]) if k > 0 else []:
        places, ranks = [], []
        for i in tried[:TRIED]:
            near, coded = x @ x[i], decoded @ x[i]
            near[i] = coded[i] = -np.inf
            best = np.argsort(-near, kind="stable")[:k]
            places.append(np.argsort(np.argsort(-(centroids @ x[i]), kind="stable"))[own[best]])
            ranks.append((coded > coded[best][:, None]).sum(1))
        needs.append((last(places), last(ranks)))
    return Index(centroids, codebooks, np.zeros(lists, np.int64), *map(max, zip(*needs, strict=True)))


def _encode(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_vectors(batch.column(1)), index.centroids.shape[1])
            own = _nearest(x, index.centroids)
            parts = (x - index.centroids[own]).reshape(len(x), CODE, -1)
            codes = np.stack([_nearest(np.ascontiguousarray(parts[:, m]), index.codebooks[m]) for m in range(CODE)], 1).astype(np.uint8)
            yield pa.record_batch([batch.column(0), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(1)], ["vec_id", "list", "codes", "embedding"])

    return run


def _units(index: Index) -> tuple[np.ndarray, np.ndarray]:
    """First unit and number of units of each list: lists of near centroids share a unit, larger lists are split over
    several.  A unit holds BLOCK rows, or ROOT times the root of all rows if that is more: some megabytes of codes, and
    a query that looks into every list has as few answers to merge."""
    size = max(BLOCK, round(ROOT * index.counts.sum() ** 0.5))
    middle = index.centroids - index.centroids.mean(0)
    first, several, unit, held = np.zeros(len(middle), np.int64), np.maximum(1, -(-index.counts // size)), 0, 0
    axis = np.linalg.svd(middle, full_matrices=False)[2][0]
    for one in np.argsort(middle @ axis, kind="stable").tolist():
        n = int(index.counts[one])
        if held and held + n > size:
            unit, held = unit + 1, 0
        first[one] = unit
        if several[one] > 1:
            unit, held = unit + int(several[one]), 0
        else:
            held += n
    return first, several


def _probe(index: Index, least: int):
    """For each query and unit, the lists of the unit that it looks into: nearest first, until they hold `least` rows at
    least.  The query's vector goes to a unit once, not once a list."""
    first, several = _units(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_vectors(batch.column(1)), index.centroids.shape[1])
            order = np.argsort(-(x @ index.centroids.T), axis=1, kind="stable")
            held = np.cumsum(index.counts[order], axis=1)
            need = np.maximum(index.probes, np.minimum((held < least).sum(1) + 1, order.shape[1]))
            rows, units, lists = [], [], []
            for i, n in enumerate(need.tolist()):
                own = order[i, :n]
                every = np.repeat(own, several[own])
                at = np.repeat(first[own], several[own]) + np.arange(len(every)) - np.repeat(np.cumsum(several[own]) - several[own], several[own])
                by = np.argsort(at, kind="stable")
                which, start = np.unique(at[by], return_index=True)
                rows += [i] * len(which)
                units += which.tolist()
                lists += [x.tolist() for x in np.split(every[by], start[1:])]
            yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), batch.column(2).take(pa.array(rows, pa.int64())), pa.array(units, pa.int64()), pa.array(lists, pa.list_(pa.int32())), batch.column(1).take(pa.array(rows, pa.int64()))], ["query_id", "q", "unit", "lists", "vector"])

    return run


def _search(index: Index, rerank: int):
    """The best rows of a unit for each of its queries, by distance tables of codes."""
    kind = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("unit", pa.int64()), ("found", pa.list_(pa.struct([("far", pa.float32()), ("vec_id", pa.int64()), ("row", pa.int64())])))])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return kind.empty_table()
        rows = rows.sort_by("vec_id").combine_chunks()
        queries = queries.combine_chunks()
        ids, row, own = rows.column("vec_id").to_numpy(), rows.column("row").to_numpy(), rows.column("list").to_numpy()
        codes = np.ascontiguousarray(np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(-1, CODE).T)
        q, qids, lists = queries.column("q").to_numpy(), queries.column("query_id").to_numpy(), queries.column("lists").to_pylist()
        unit = _unit(_vectors(queries.column("vector").combine_chunks()), index.centroids.shape[1])
        out = []
        for a in range(0, len(q), 32):
            x = unit[a : a + 32]
            tables = np.einsum("qms,mcs->mqc", x.reshape(len(x), CODE, -1), index.codebooks)
            near = (x @ index.centroids.T)[:, own]
            for m in range(CODE):
                near += tables[m].take(codes[m], axis=1)
            for i in range(len(x)):
                probed = np.zeros(len(index.centroids), bool)
                probed[lists[a + i]] = True
                at = np.flatnonzero(probed[own] & (ids != qids[a + i]))
                if len(at) > rerank:
                    least = np.partition(near[i, at], len(at) - rerank)[len(at) - rerank]
                    at = at[near[i, at] >= least]
                    at = at[np.argsort(-near[i, at], kind="stable")][:rerank]  # ties: the smaller vec_id, as rows are sorted
                out.append((ids[at], row[at], -near[i, at]))
        ends = np.concatenate([[0], np.cumsum([len(x) for x, _, _ in out])])
        ids, row, far = (np.concatenate(c) for c in zip(*out, strict=True))
        found = pa.StructArray.from_arrays([pa.array(far, pa.float32()), pa.array(ids), pa.array(row)], fields=list(kind.field("found").type.value_type))
        return pa.table([pa.array(q), pa.array(qids), queries.column("unit").combine_chunks(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], schema=kind)

    return run


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (q, query_id, vec_id, vector, embedding) with the exact cosine instead of the vectors."""
    for batch in batches:
        x, y = _vectors(batch.column(3)), _vectors(batch.column(4))
        score = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) if len(x) else np.zeros(0)
        yield pa.record_batch([*batch.columns[:3], pa.array(score, pa.float64())], ["q", "query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine, ties to the smaller vec_id, of every row for which
    the column is_query holds, among all rows with another vec_id.

    Centroids, codebooks and the number of probed lists are fitted on a bounded sample in hash order; every row is
    indexed.  A query compares codes in its probed lists, keeps the best rows of all lists together, and fetches only
    these vectors for exact cosines: as many as the sample needed, more by the root of rows a sampled row, since the
    neighbours stand out more among more rows; RERANK at least.  Answers of units are merged FAN at a time, each merge
    keeping as many as are reranked, so no row grows with the number of units.  Vectors that are null, empty, zero, of another length than the sample's first,
    or hold null or non-finite components take no part; an empty table gives no rows.  A vec_id is taken as the row's key:
    rows that share the query's are its own, other repeated rows count each, equal rows are one query.  Rows stand in
    units of BLOCK, queries in blocks of as many, so a hot list is no hot task.  Other columns are not read."""
    spark = vectors.sparkSession
    valid = valid_vectors(vectors)
    sample = valid.withColumn("_asked", F.coalesce(is_query, F.lit(False))).orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("embedding", "_asked").toPandas()
    sample, asked = sample["embedding"].tolist(), sample["_asked"].to_numpy(bool)
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, vector = len(sample[0]), valid.schema["embedding"].dataType.simpleString()
    valid = valid.where(F.size("embedding") == dim)
    same = np.array([len(x) == dim for x in sample])
    n, sample, asked = valid.count(), np.array([x for x in sample if len(x) == dim], np.float64), asked[same]
    index = fit(sample, int(np.clip(round(n**0.5), 1, MOST_LISTS)), k, asked)
    rerank = max(RERANK, round(index.depth * max(1.0, n / len(sample)) ** 0.5))
    coded = valid.mapInArrow(_encode(index), f"vec_id long, list int, codes binary, embedding {vector}")
    coded = stored(coded.withColumn("row", F.monotonically_increasing_id()))
    for one in coded.groupBy("list").count().collect():  # one row a list, MOST_LISTS at most
        index.counts[one["list"]] = one["count"]
    asked = coded.where(is_query).select("vec_id", "embedding", F.xxhash64("vec_id", "embedding").alias("q")).dropDuplicates(["q"])
    probes = stored(asked.mapInArrow(_probe(index, k + 1), f"query_id long, q long, unit long, lists array<int>, vector {vector}"))
    first, several = _units(index)
    units = [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, several, strict=True))]
    units = F.broadcast(spark.createDataFrame(units, "l int, unit long, several long"))  # one row a list
    per = F.broadcast(probes.groupBy(F.col("unit").alias("u")).agg(F.ceil(F.count("*") / BLOCK).alias("q_blocks")))  # one row a unit
    zero = F.lit(0).cast("long")
    left = coded.join(units, F.col("list") == F.col("l")).select((F.col("unit") + F.pmod(F.xxhash64("row"), F.col("several"))).alias("unit"), "row", "vec_id", "list", "codes")
    left = left.join(per, F.col("unit") == F.col("u")).select("unit", F.explode(F.sequence(zero, F.col("q_blocks") - 1)).alias("j"), "row", "vec_id", "list", "codes")
    right = probes.join(per, F.col("unit") == F.col("u")).select("unit", F.pmod(F.col("q"), F.col("q_blocks")).alias("j"), "query_id", "q", "lists", "vector")
    found = left.groupBy("unit", "j").cogroup(right.groupBy("unit", "j")).applyInArrow(_search(index, rerank), "q long, query_id long, unit long, found array<struct<far:float,vec_id:long,row:long>>")
    several = int((first + several).max())
    while several > 1:  # a list has FAN * rerank items at most
        several = -(-several // FAN)
        found = found.groupBy("q", "query_id", F.floor(F.col("unit") / FAN).alias("unit")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, rerank).alias("found"))
    found = found.select("q", "query_id", F.inline("found")).select("q", "query_id", "row", "vec_id")
    found = found.join(coded.select("row", "embedding"), "row").join(asked.select(F.col("q").alias("own"), F.col("embedding").alias("vector")), F.col("q") == F.col("own"))
    scored = found.select("q", "query_id", "vec_id", "vector", "embedding").mapInArrow(_cosines, "q long, query_id long, vec_id long, score double")
    order = W.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
