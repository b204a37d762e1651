"""Prefix trie of conversations from sparse tables over sorted LCPs.

A conversation is a sequence of turns, each known by a 128-bit hash of role and
text. Sorted by these sequences (and by id where they are equal), the conversations
that share a prefix stand together, and every node of the trie is an interval of
positions: all its inner LCPs (length of the common prefix with the position before)
are at least the node's depth.

The sorted order is dealt into slices by range, so equal sequences may span slices,
and a task walks its slice in blocks of at most BLOCK conversations and TURNS turns.
In a block, a sparse table holds range minima of the LCPs. Each candidate prefix
(depths above the LCP at a position) searches its left and its right end on its own,
by halving steps through the table; a second table gives the smallest conv_id of an
interval and prefix sums give the rest. A node that spans blocks gets one partial
row in each, and the partial rows of a prefix are summed by its hash after map-side
sums. So no task holds more than a block, however common a prefix is.

``conversations`` is rebuilt before: conversation c has the first h turns of
conversation c - c % FAMILY, with h = crc32(c) % HEADS, and then its own turns after
its first h.

Defined cases: NULL role or text is empty; a NULL turn comes first; equal turn
numbers are ordered by role and text, and repeated rows are all kept. Rows without a
conv_id belong to no conversation and are left out. A conversation can end up with no
turn; it is a member of the root alone. Without conversations there is no node.
Other columns are ignored. One conversation is one row of hashes, 24 bytes a turn;
the digest of the ids that end at a node is one chain, read as a stream of chunks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import attach, pinned, query, table

BLOCK, TURNS = 8192, 200_000
CHUNK = 512         # conv_ids in one piece of a digest
FAMILY, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
NODE = ("key binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "first long, ids string")


class RangeMin:
    """Sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            low, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-step], low[step:]))

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minima of the ranges left to right, both included."""
        level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] - (1 << k) + 1])
        return out

    def extents(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of the prefix of length ``depth`` at ``at``, where
        the values are LCPs with the position before (-1 at position 0)."""
        left, right, size = at.copy(), at.copy(), len(self.levels[0])
        for k in reversed(range(len(self.levels))):
            step, row = 1 << k, self.levels[k]
            can = right + step < size
            can[can] = row[right[can] + 1] >= depth[can]
            right[can] += step
        for k in reversed(range(len(self.levels))):
            step, row = 1 << k, self.levels[k]
            can = left >= step
            can[can] = row[left[can] - step + 1] >= depth[can]
            left[can] -= step
        return left, right


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // 16
    x, y = (np.frombuffer(s, np.uint64, 2 * n).reshape(n, 2) for s in (a, b))
    different = (x != y).any(1)
    return int(different.argmax()) if different.any() else n


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])


def block_nodes(ids: np.ndarray, seqs: list[bytes], words: np.ndarray, before: tuple[int, int], chunk: int = CHUNK) -> pa.RecordBatch:
    """Partial rows of the nodes of one block. ``words`` holds the words of all turns
    in a row; ``before`` is the LCP of the first conversation with the one before the
    block (-1 if there is none) and that one's length."""
    m = len(seqs)
    size = np.array([len(s) // 16 for s in seqs], np.int64)
    lcp = np.array([-1] + [common_turns(a, b) for a, b in zip(seqs, seqs[1:])], np.int64)
    full = []       # per position: key of the whole sequence
    keys: list[bytes] = []
    parents: list[bytes | None] = []
    for i, s in enumerate(seqs):
        start = max(int(lcp[i]), 0)
        chain = hashlib.blake2b(s[:16 * start], digest_size=16)
        above = chain.digest()
        if i == 0:
            keys.append(above)
            parents.append(None)
        for d in range(start, int(size[i])):
            chain.update(s[16 * d:16 * d + 16])
            parents.append(above)
            above = chain.copy().digest()
            keys.append(above)
        full.append(above)
    count = size - np.maximum(lcp, 0)
    count[0] += 1
    at = np.repeat(np.arange(m), count)
    depth = np.arange(len(at)) - np.repeat(_sums(count)[:-1], count) + np.repeat(lcp + 1, count)
    left, right = RangeMin(lcp).extents(at, depth)
    n = right - left + 1

    seam = lcp.copy()
    seam[0] = before[0]
    earlier = np.concatenate([[before[1]], size[:-1]])
    turn = _sums(words)
    begin = _sums(size)[:-1]

    def first_words(i: np.ndarray, k: np.ndarray) -> np.ndarray:
        return turn[begin[i] + k] - turn[begin[i]]

    every = np.arange(m)
    total = first_words(every, size)
    # a leaf ends before each position that does not extend the sequence before it
    ended = _sums(earlier > seam)
    inside = np.where(seam[left] >= depth, left, left + 1)
    leaves = ended[right + 1] - ended[inside]
    # children begin where the LCP is exactly the depth and the sequence goes on
    branch = np.sort((lcp * (m + 1) + every)[(lcp >= 0) & (size > lcp)])
    children = np.searchsorted(branch, depth * (m + 1) + right, "right") - np.searchsorted(branch, depth * (m + 1) + left, "right")
    children += (size[left] > depth) & (seam[left] <= depth)
    # words of all members from the node on, less those of each different node once
    fresh_words = _sums(total - first_words(every, np.maximum(lcp, 0)))
    top = np.maximum(depth - 1, 0)
    saved = _sums(total)[right + 1] - _sums(total)[left] - n * first_words(left, top)
    saved -= total[left] - first_words(left, np.maximum(top, seam[left])) + fresh_words[right + 1] - fresh_words[left + 1]

    tail: list[tuple[bytes, int, str]] = []
    same = (lcp == size) & (every > 0)
    begins = np.flatnonzero(~same)
    for a, b in zip(begins, np.append(begins[1:], m)):
        for c in range(int(a), int(b), chunk):
            piece = ids[c:min(c + chunk, int(b))].tolist()
            tail.append((full[a], piece[0], ",".join(map(str, piece))))
    none = [None] * len(tail)
    blank = [None] * len(keys)
    low = RangeMin(ids).least(left, right)
    numbers = [(depth, pa.int32()), (low, pa.int64()), (n, pa.int64()), (children, pa.int64()), (leaves, pa.int64()), (saved, pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys + [t[0] for t in tail], pa.binary()), pa.array(parents + none, pa.binary()),
         *[pa.array(v.tolist() + none, k) for v, k in numbers],
         pa.array(blank + [t[1] for t in tail], pa.int64()), pa.array(blank + [t[2] for t in tail], pa.string())],
        [field.split()[0] for field in NODE.split(", ")])


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, each a struct of
    hash (16 bytes) and words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    held = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    placed = held.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    name = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turn = F.struct("place", F.substring(F.unhex(F.sha2(name.cast("binary"), 256)), 1, 16).alias("hash"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    listed = placed.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["hash"], t["words"])).alias("turns"))


def rebuilt(convs: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Each conversation with its first turns replaced by those of its family's base."""
    convs = pinned(convs)
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int"))
    base = convs.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads).alias("head"))
    none = F.slice("turns", 1, 0)
    return own.join(base, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _seams(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """By slice: LCP with the conversation before the slice, and that one's length.
    One row a slice is read."""
    ends = ordered.groupBy("slice").agg(F.min("seq").alias("low"), F.max("seq").alias("top"))
    rows = ends.select("slice", "low", F.lag("top").over(Window.orderBy("slice")).alias("before"))

    def run(batches):
        for batch in batches:
            low, before = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            lcp = [-1 if b is None else common_turns(a, b) for a, b in zip(low, before)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lcp, pa.int64()), pa.array([len(b or b"") // 16 for b in before], pa.int64())], ["slice", "lcp", "size"])

    return {r["slice"]: (r["lcp"], r["size"]) for r in rows.mapInArrow(run, "slice int, lcp long, size long").collect()}


def _digests(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined pieces of each key, in the order of ``first``."""
    def run(batches):
        key, chain = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k == key:
                    chain.update(b"," + ids.encode())
                    continue
                if chain is not None:
                    done.append((key, chain.hexdigest()))
                key, chain = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
        if chain is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([chain.hexdigest()], pa.string())], ["key", "ends_sha256"])

    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(run, "key binary, ends_sha256 string")


def trie(convs: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Nodes of the trie of ``convs`` (conv_id unique, turns): key (hash of the prefix),
    parent_key, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    rows = convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["hash"])), "")).alias("seq"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))
    ordered = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").withColumn("slice", F.spark_partition_id())
    ordered = pinned(ordered)
    seams = _seams(ordered)

    def run(batches):
        last = None
        for batch in batches:
            ids, seqs, slices = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(3)
            words = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum([len(s) // 16 for s in seqs])
            at = 0
            while at < len(seqs):
                used = int(ends[at - 1]) if at else 0
                stop = min(max(int(np.searchsorted(ends, used + TURNS, "right")), at + 1), at + block)
                stop = min(stop, len(seqs))
                before = seams[slices[at].as_py()] if last is None else (common_turns(last, seqs[at]), len(last) // 16)
                yield block_nodes(ids[at:stop], seqs[at:stop], words[used:int(ends[stop - 1])], before, chunk)
                last, at = seqs[stop - 1], stop

    parts = pinned(ordered.mapInArrow(run, NODE))
    nodes = pinned(parts.filter("depth is not null").groupBy("key", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        (F.sum("n_leaves") + 1).alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    digests = _digests(parts.filter("ids is not null").select("key", "first", "ids"))
    named = nodes.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    named = pinned(named)
    tops = nodes.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("below"))
    return attach(named, tops, "parent", "below", nodes.count()).select(
        "key", F.col("parent").alias("parent_key"), "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id",
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_CRC = """xor(list_reduce(list_prepend(4294967295, flatten([[CAST(ascii(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR b IN string_split(CAST(conv_id AS VARCHAR), '')])),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

_SQL = rf"""
    WITH RECURSIVE t AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s,
               len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS w
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, {_CRC} % {HEADS} AS h, conv_id - conv_id % {FAMILY} AS base FROM (SELECT DISTINCT conv_id FROM t)),
    turns AS (
        SELECT c.conv_id, 0 AS own, k, s, w FROM c JOIN t ON t.conv_id = c.base AND t.k <= c.h
        UNION ALL SELECT c.conv_id, 1, k, s, w FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
    seqs AS (
        SELECT c.conv_id, coalesce(string_agg(s, '' ORDER BY own, k), '') AS s, coalesce(list(w ORDER BY own, k) FILTER (w IS NOT NULL), []) AS w
        FROM c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
    prefixes AS (
        SELECT conv_id, d, s[1:64 * d] AS p, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS w, len(w) AS size
        FROM (SELECT *, unnest(range(len(w) + 1)) AS d FROM seqs)),
    nodes AS (
        SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, min(w) AS w, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (size = d) AS ends
        FROM prefixes GROUP BY p, d),
    families AS (SELECT p[1:64 * (d - 1)] AS p, count(*) AS children FROM nodes WHERE d > 0 GROUP BY 1),
    subtrees AS (
        SELECT n.p[1:64 * n.up] AS p, sum((n.n - 1) * n.w) AS saved, count(*) FILTER (f.p IS NULL) AS leaves
        FROM (SELECT *, unnest(range(d + 1)) AS up FROM nodes) n LEFT JOIN families f ON f.p = n.p GROUP BY 1)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(f.children, 0) AS n_children,
           x.leaves AS n_leaves, CAST(x.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
    FROM nodes n LEFT JOIN nodes u ON n.d > 0 AND u.p = n.p[1:64 * (n.d - 1)] LEFT JOIN families f ON f.p = n.p JOIN subtrees x ON x.p = n.p"""


@query(_SQL)
def op13_prefix_trie(spark, folder):
    return trie(rebuilt(sequences(table(spark, folder, "conversations")))).drop("key", "parent_key")
