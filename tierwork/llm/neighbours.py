"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut into two halves; each half is quantised
with its own centroids, so a pair of centroids names a cell. For a query, pairs are
taken from a heap in order of their summed squared distance until their cells hold
at least PROBE vectors and SHARE of all; the entries of those cells are reranked by
the exact cosine of the original vectors in double precision.

Centroids are fitted on a bounded sample; every vector is indexed. Their number
grows with the square root of the number of vectors, so that cells keep their size.
Exact copies of a vector are one entry with its smallest different ids: as many as a query
can return, and one more, so nothing that could be returned is left out and a
vector that fills the table stays a small group. Cells are dealt into shards of
about SHARD entries, a larger cell into several; a query goes once to each shard
that holds some of its cells, with the list of them. Queries meet the shards in
blocks of about QUERIES.

SHARE is what recall needs on vectors without structure; recall against brute force
is measured in the tests and in README.

Defined cases: a vector that is NULL, empty, zero, of another length than most, or
has NULL or non-finite components takes no part. Rows without an id take no part.
Repeated rows count once. An id may have several vectors: it is found by the nearest
of them, at most once in a result, and a query id with several vectors asks with each
and gets the nearest over all. A query never returns its own id. Ties go to the smaller id. A query with fewer candidates than k gets them all:
a table that holds at most PROBE distinct vectors is searched whole.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import about, pinned, query, table

K = 5
PROBE = 2000            # vectors that the cells of a query hold at least
SHARE = 0.55            # and the share of all vectors
SAMPLE = 20_000         # vectors that centroids are fitted on
CELL = 32               # vectors of a cell, on average
MAX_CENTROIDS = 1024    # of a half
ROUNDS = 10
SHARD = 4096
QUERIES = 20_000


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v: the rows that take part, with components as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & v.isNotNull())
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # -0.0 and 0.0 are one value
    return rows.filter(fine & F.exists(v, lambda x: x != 0)).withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[k:k + 4096], centres).argmin(1) for k in range(0, len(x), 4096)]) if len(x) else np.empty(0, int)


def cells_for(first: np.ndarray, second: np.ndarray, sizes: dict[int, int], width: int, wanted: int) -> list[int]:
    """Cells of centroid pairs in order of summed distance, until they hold
    ``wanted`` entries. Pair (i, j) enters the heap once both (i - 1, j) and
    (i, j - 1) have left it, or have no such neighbour."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    left: dict[int, int] = {}       # by i: how many j have left
    out, held = [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        left[i] = j + 1
        cell = int(a[i]) * width + int(b[j])
        n = sizes.get(cell, 0)
        if n:
            out.append(cell)
            held += n
        if i + 1 < len(a) and left.get(i + 1, 0) == j:
            heapq.heappush(heap, (first[a[i + 1]] + second[b[j]], i + 1, j))
        if j + 1 < len(b) and (i == 0 or left.get(i - 1, 0) > j + 1):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
    return out


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), float)


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, probe: int = PROBE,
    share: float = SHARE,
) -> DataFrame:
    """query_id, rank, the key and score: the ``k`` nearest found of ``vectors`` for
    every row of ``queries`` (same columns)."""
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, {key} {kind}, score double")
    rows = valid(vectors, key, vector)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return empty
    dim, half = usual["d"], (usual["d"] + 1) // 2
    rows = rows.filter(F.size("v") == dim)
    # copies: the ids that a query can return at most, its own id apart
    few = rows.distinct().withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("_r") <= k + 1)
    entries = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))      # at most k + 1 ids in a list
    entries = pinned(entries)
    n = entries.count()
    sample = unit(np.array([r["v"] for r in about(entries, F.col("v"), n, SAMPLE).select("v").collect()], float))
    width = max(1, min(MAX_CENTROIDS, math.isqrt(max(1, n // CELL)), len(sample)))
    shared = spark.sparkContext.broadcast(tuple(kmeans(part, width, seed) for seed, part in enumerate((sample[:, :half], sample[:, half:]))))

    def assign(batches):
        one, two = shared.value
        for batch in batches:
            x = unit(_matrix(batch.column(0)))
            cell = nearest(x[:, :half], one) * width + nearest(x[:, half:], two)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int64))], ["v", "ids", "cell"])

    indexed = pinned(entries.select("v", "ids").mapInArrow(assign, f"v array<double>, ids array<{kind}>, cell long"))
    # at most MAX_CENTROIDS squared cells, and no more than there are entries
    sizes = spark.sparkContext.broadcast({r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()})

    shards = max(1, -(-n // SHARD))
    wanted = max(probe, math.ceil(share * n))

    def shard_of(cell: int, part: int) -> int:
        return ((cell * 2654435761 + part * 40503) >> 7) % shards

    def place(batches):
        for batch in batches:
            at = []
            for v, cell in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                parts = -(-sizes.value[cell] // SHARD)
                at.append(shard_of(cell, xxhash.xxh3_64_intdigest(np.array(v).tobytes()) % parts))
            yield batch.append_column("shard", pa.array(at, pa.int64()))

    def traverse(batches):
        one, two = shared.value
        for batch in batches:
            x = unit(_matrix(batch.column(1)))
            d1, d2 = distances(x[:, :half], one), distances(x[:, half:], two)
            at, shard, cells = [], [], []
            for row in range(len(x)):
                by: dict[int, list[int]] = {}
                for cell in cells_for(d1[row], d2[row], sizes.value, width, wanted):
                    for s in {shard_of(cell, part) for part in range(-(-sizes.value[cell] // SHARD))}:
                        by.setdefault(s, []).append(cell)
                at += [row] * len(by)
                shard += by
                cells += by.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), pa.array(shard, pa.int64()),
                 pa.array(cells, pa.list_(pa.int64()))], ["id", "v", "shard", "cells"])

    asked = valid(queries, key, vector).filter(F.size("v") == dim).distinct()
    probes = asked.mapInArrow(traverse, f"id {kind}, v array<double>, shard long, cells array<long>")
    blocks = max(1, -(-asked.count() // QUERIES))
    probes = probes.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    placed = indexed.mapInArrow(place, f"v array<double>, ids array<{kind}>, cell long, shard long").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def rerank(_, entry, probe):
        found = {"query_id": [], "other": [], "score": []}
        if entry.num_rows and probe.num_rows:
            e, ids, cell = _matrix(entry.column("v")), entry.column("ids").to_pylist(), np.array(entry.column("cell"))
            order = np.argsort(cell, kind="stable")
            names, start = np.unique(cell[order], return_index=True)
            members = {int(c): m for c, m in zip(names, np.split(order, start[1:]))}
            norms = np.sqrt((e * e).sum(1))
            alone: dict = {}        # by id: the entries that no other id has
            for row, known in enumerate(ids):
                if len(known) == 1:
                    alone.setdefault(known[0], []).append(row)
            for query_id, q, cells in zip(probe.column("id").to_pylist(), _matrix(probe.column("v")), probe.column("cells").to_pylist()):
                at = np.concatenate([members[c] for c in cells if c in members] or [np.empty(0, int)])
                at = at[~np.isin(at, alone.get(query_id, []))]
                if not len(at):
                    continue
                cosine = (e[at] @ q) / (norms[at] * math.sqrt(q @ q))
                top, nearest_by_id = k, {}
                while True:     # an id may have several of the nearest entries
                    top = min(top, len(at))
                    best = at[cosine >= np.partition(cosine, len(at) - top)[len(at) - top] - 1e-12]     # ties at the edge stay in
                    nearest_by_id = {}
                    for b in best:
                        score = _cosine(q, e[b])
                        for i in ids[b]:
                            if i != query_id:
                                nearest_by_id[i] = max(score, nearest_by_id.get(i, -2.0))
                    if len(nearest_by_id) >= k or top == len(at):
                        break
                    top *= 2
                scored = sorted((-score, i) for i, score in nearest_by_id.items())[:k]
                for score, i in scored:
                    found["query_id"].append(query_id)
                    found["other"].append(i)
                    found["score"].append(-score)
        return pa.table(found, schema=shape)

    arrow = to_arrow_type(vectors.schema[key].dataType)
    shape = pa.schema([("query_id", arrow), ("other", arrow), ("score", pa.float64())])
    best = placed.groupBy("shard", "block").cogroup(probes.groupBy("shard", "block")).applyInArrow(rerank, f"query_id {kind}, other {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "other")
    best = best.groupBy("query_id", "other").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias(key), "score")


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.dot(a, b) / (math.sqrt(np.dot(a, a)) * math.sqrt(np.dot(b, b))))


@query()
def op4_multi_index(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"))
