"""N-gram Jaccard join with Bayesian candidate pruning.

1. Texts become sets of hashed word shingles (five words; lower case, letters and
   digits). Texts with equal sets form one class, whose pairs need no comparison.
2. Every class has HASHES MinHash values. Classes that agree on a band of ROWS
   values are candidates; a pair of the threshold meets in no band with chance
   (1 - 0.8^4)^32, below 1e-7. Bands link a class to the smallest class they hold,
   and the components of these links are clusters: both ends of every candidate
   pair lie in one cluster, so each pair is met once whatever number of bands it
   shares.
3. Within a cluster, candidates compare MinHash values STEP at a time. With m of n
   values equal and a uniform prior, similarity reaches t with posterior
   probability P(Binomial(n + 1, t) <= m). A pair whose probability falls below
   TOLERANCE is dropped at that point.
4. Survivors are verified on the whole shingle sets, so every link is exact.

A cluster larger than BLOCK is cut into blocks, and every two blocks meet in a
task of their own. Tasks return, for each class, its number of links and a
spanning forest, never the pairs: what is written stays linear in the documents
of a block. Components of the forests are the near-duplicate classes.

Defined cases: NULL and empty texts and texts without words have no shingles, no
links, and stand alone. A text of one to four words is one shingle. Equal texts
link to each other, so n copies have n - 1 links each. doc_id may be NULL or
repeat; each row gets its own result row, and class_id is the smallest non-NULL
doc_id of a class (NULL if there is none). Other columns are ignored. Set keys
are 64-bit hashes.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import fresh, pinned, query, table
from .components import components

WORDS = 5
THRESHOLD = 0.8
HASHES, ROWS, STEP = 128, 4, 16
TOLERANCE = 1e-6
BLOCK = 384
CACHE = 500_000
_WORD = re.compile(r"\w+")
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


class WordHashes(dict):
    """Hash of each word, kept while the words of a task repeat."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, seen: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    found = _WORD.findall(text.lower()) if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(seen.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    width = min(words, len(h))
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minhash(grams: np.ndarray) -> np.ndarray:
    x = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(low, (x[at:at + 256, None] * _A + _B).min(0), out=low)
    return low


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """By number of values compared: the fewest equal ones that keep a pair."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def signatures(docs: DataFrame, text: str, words: int = WORDS) -> DataFrame:
    """``docs`` (id, text) as id, set_key, signature; both NULL for a text without words."""
    def run(batches):
        seen = WordHashes()
        for batch in batches:
            keys, found = [], []
            for value in batch.column(1).to_pylist():
                grams = shingles(value, seen, words)
                keys.append(_signed(xxhash.xxh3_64_intdigest(grams.tobytes())) if len(grams) else None)
                found.append(minhash(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array(found, pa.binary())], ["id", "set_key", "signature"])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, set_key long, signature binary")


def _band_links(classes: DataFrame) -> DataFrame:
    """Links from each class to the smallest class of each of its bands."""
    def run(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
            keys = np.repeat(batch.column(0).to_numpy(), HASHES // ROWS)
            bands = np.zeros((len(sig), HASHES // ROWS), np.uint64)
            for k in range(ROWS):
                bands = (bands ^ sig[:, k::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
                bands ^= bands >> np.uint64(29)
            bands += np.arange(HASHES // ROWS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            yield pa.RecordBatch.from_arrays([pa.array(bands.ravel().view(np.int64)), pa.array(keys)], ["band", "set_key"])

    bands = classes.select("set_key", "signature").mapInArrow(run, "band long, set_key long")
    first = bands.groupBy("band").agg(F.min("set_key").alias("b"), F.max("set_key").alias("top")).filter("b <> top").drop("top")
    return bands.join(first, "band").select(F.col("set_key").alias("a"), "b").filter("a <> b").distinct()


def _exact(a: list[np.ndarray], b: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a[i] and b[j], for rows (i, j) of ``pairs``."""
    out = np.zeros(len(pairs), np.int64)
    if not len(pairs):
        return out
    rows, columns = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
    if len(pairs) < 0.1 * len(rows) * len(columns):
        for k, (i, j) in enumerate(pairs):
            out[k] = len(np.intersect1d(a[i], b[j], assume_unique=True))
        return out
    left, right = np.concatenate([a[i] for i in rows]), np.concatenate([b[j] for j in columns])
    common = np.intersect1d(left, right)
    at = [np.flatnonzero(np.isin(common, a[i], assume_unique=True)) for i in rows], [np.flatnonzero(np.isin(common, b[j], assume_unique=True)) for j in columns]
    total = np.zeros((len(rows), len(columns)), np.float32)
    for start in range(0, len(common), 4096):       # counts below 2^24 are exact
        x, y = (np.zeros((len(side), 4096), np.float32) for side in at)
        for m, side in zip((x, y), at):
            for r, found in enumerate(side):
                part = found[np.searchsorted(found, start):np.searchsorted(found, start + 4096)] - start
                m[r, part] = 1
        total += x @ y.T
    return total[np.searchsorted(rows, pairs[:, 0]), np.searchsorted(columns, pairs[:, 1])].astype(np.int64)


def _meet(unit: list[dict], i: int, j: int, limits: dict[int, int], threshold: float) -> list[tuple[int, int, int]]:
    """(set_key, links, root) of the classes of one unit that have a link in it.
    Links count documents: a class of n equal sets counts n."""
    a = [r for r in unit if r["block"] == i]
    b = a if i == j else [r for r in unit if r["block"] == j]
    sa, sb = (np.array([np.frombuffer(r["signature"], np.uint32) for r in side], np.uint32).reshape(len(side), HASHES) for side in (a, b))
    pairs = []
    for at in range(0, len(a), 64):
        part = sa[at:at + 64]
        band = np.zeros((len(part), len(b)), bool)
        for k in range(0, HASHES, ROWS):
            band |= (part[:, None, k:k + ROWS] == sb[None, :, k:k + ROWS]).all(-1)
        x, y = np.nonzero(band)
        keep = x + at < y if i == j else np.ones(len(x), bool)
        x, y = x[keep], y[keep]
        same = np.zeros(len(x), np.int64)
        for n in range(STEP, HASHES + 1, STEP):
            same += (part[x, n - STEP:n] == sb[y, n - STEP:n]).sum(1)
            alive = same >= limits[n]
            x, y, same = x[alive], y[alive], same[alive]
        pairs.append(np.stack([x + at, y], 1))
    pairs = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
    ga, gb = ([np.frombuffer(r["grams"], np.uint64) for r in side] for side in (a, b))
    size_a, size_b = np.array([len(g) for g in ga]), np.array([len(g) for g in gb])
    common = _exact(ga, gb, pairs)
    whole = size_a[pairs[:, 0]] + size_b[pairs[:, 1]] - common
    pairs = pairs[common >= threshold * whole - 1e-9]
    if not len(pairs):
        return []
    key_a, key_b = np.array([r["set_key"] for r in a]), np.array([r["set_key"] for r in b])
    n_a, n_b = np.array([r["copies"] for r in a]), np.array([r["copies"] for r in b])
    links: dict[int, int] = {}
    for keys, at, weights in ((key_a, pairs[:, 0], n_b[pairs[:, 1]]), (key_b, pairs[:, 1], n_a[pairs[:, 0]])):
        for k, n in zip(keys, np.bincount(at, weights, len(keys)).astype(np.int64)):
            if n:
                links[int(k)] = links.get(int(k), 0) + int(n)
    root = {k: k for k in links}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for x, y in zip(key_a[pairs[:, 0]].tolist(), key_b[pairs[:, 1]].tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(k, n, find(k)) for k, n in links.items()]


def _verified(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """members: cluster, i, j, block, set_key, copies, signature, grams; a unit
    (cluster, i, j) has at most about two blocks and is read as a stream."""
    limits = fewest_matches(threshold, tolerance)

    def run(batches):
        unit, name = [], None
        out: list[tuple[int, int, int]] = []

        def made():
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["set_key", "links", "root"])

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["cluster"], row["i"], row["j"])
                if key != name and unit:
                    out += _meet(unit, name[1], name[2], limits, threshold)
                    unit = []
                name = key
                unit.append(row)
            if len(out) > 10_000:
                yield made()
                out = []
        if unit:
            out += _meet(unit, name[1], name[2], limits, threshold)
        yield made()

    units = members.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return units.mapInArrow(run, "set_key long, links long, root long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row for each row of ``docs``: key, text_hash, set_key, class_id, n_links,
    where n_links counts the documents of similarity ``threshold`` or more."""
    source = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    source = source.withColumn("row_key", F.xxhash64("id", "text"))
    found = pinned(signatures(source.select(F.struct("id", F.xxhash64("text").alias("text_hash"), "row_key").alias("id"), "text"), "text", words)
                   .select("id.id", "id.text_hash", "id.row_key", "set_key", "signature"))
    classes = pinned(found.filter("set_key is not null").groupBy("set_key").agg(
        F.min("id").alias("low"), F.count("*").alias("copies"), F.min("signature").alias("signature"), F.min("row_key").alias("row_key")))
    clusters = components(_band_links(classes)).select(F.col("vertex").alias("set_key"), F.col("root").alias("cluster"))
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # the text of one document for each clustered class is read again for its shingles;
    # one row is named, so that the copies of a text do not meet in a task
    wanted = classes.join(clusters, "set_key").join(sizes, "cluster")

    def regram(batches):
        seen = WordHashes()
        for batch in batches:
            grams = pa.array([shingles(t, seen, words).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield batch.drop_columns(["text"]).append_column("grams", grams)

    texts = source.select("row_key", "text").join(wanted.select("row_key").distinct(), "row_key", "left_semi").dropDuplicates(["row_key"])
    held = wanted.select("cluster", "blocks", F.pmod(F.xxhash64("set_key"), "blocks").cast("int").alias("block"), "set_key", "copies", "signature", "row_key")
    grams = pinned(held.join(texts, "row_key").drop("row_key").mapInArrow(
        regram, "cluster long, blocks int, block int, set_key long, copies long, signature binary, grams binary"))
    members = grams.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set_key", "copies", "signature", "grams")
    links = pinned(_verified(members, threshold, tolerance))
    joined = components(links.select(F.col("set_key").alias("a"), F.col("root").alias("b"))).select(F.col("vertex").alias("set_key"), "root")
    counted = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    named = classes.select("set_key", "low", "copies").join(joined, "set_key", "left").join(counted, "set_key", "left").withColumn(
        "root", F.coalesce("root", "set_key"))
    named = named.join(named.groupBy("root").agg(F.min("low").alias("class_id")), "root").select(
        "set_key", F.col("root").alias("class_key"), "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return found.drop("signature", "row_key").join(named, "set_key", "left").select(
        F.col("id").alias(key), "text_hash", "set_key", "class_key",
        F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


@query()
def op2_bayes_jaccard(spark, folder):
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


def stage(spark, docs, folder):
    """Keep one document of each class: the one with the smallest doc_id. Texts
    without words stay. Rows that repeat id and text count once."""
    found = near_duplicates(docs.select("doc_id", "text"))
    first = found.filter("class_key is not null").groupBy("class_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    mark, key, text_hash = fresh(docs, "mark"), fresh(docs, "key"), fresh(docs, "hash")
    alone = found.filter("class_key is null").select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash))
    stays = first.select(F.col("first.doc_id").alias(key), F.col("first.text_hash").alias(text_hash)).unionByName(alone).distinct()
    kept = docs.withColumn(mark, F.xxhash64("text")).join(
        stays, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(text_hash)), "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).select(*docs.columns)
