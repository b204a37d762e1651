"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark items are cut into passages of at most PASSAGE words. Terms are
   weighted by inverse document frequency, counted over all documents.
2. A randomised SVD of the passages' TF-IDF matrix, distributed by passage (a
   Gaussian sketch that each task makes from term hashes, power steps, and sums by
   term), gives the term directions of the latent space.
3. Every window of PASSAGE words of every document, at steps of PASSAGE / 4, is
   mapped into that space; passages within COSINE of it are its candidates.
4. A candidate is verified on the words of the whole item: the longest common
   subsequence (LCS) with the document around the window, allowing for inserted
   words. All windows within COSINE of an item are tried, the nearest first, until
   one passes, since the nearest need not be where the item is. Of every window it is
   first asked whether its region has enough of the item's words at all, of all
   windows of an item in one go. Before the search, an item is passed over for a
   document of which no stretch of SLACK times its length has the words that a leak
   needs there. It is a leak when the LCS covers VERBATIM of the item, or PARAPHRASE of
   it and the answer is there as well. The answer is the column of that name, or
   else the last ANSWER words of the item.

The space is spanned by benchmark passages, since its rank is to be spent on what
tells items apart. Benchmarks of more than BLOCK passages are handled in blocks of
that size by item hash, each with a space of its own, so what is broadcast is
bounded: at most BLOCK passages and RANK numbers for each of their terms.

Items of fewer than SHORTEST words are found as exact sequences of words, where they
have at least EXACT; fewer words are no evidence.

Defined cases: items that are NULL or have fewer than EXACT words are never found;
NULL and empty documents hold nothing. Items with equal text are all
reported, repeated benchmark rows once. A NULL doc_id or item_id is kept as it is;
repeated documents give repeated results. An empty benchmark or empty documents give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType

from .common import counts_in_batches, fresh, pinned, query, table

PASSAGE = 48
SHORTEST, EXACT = 6, 3
RANK, OVERSAMPLE, POWER = 96, 16, 2
BLOCK = 1000                # passages of one latent space
COSINE = 0.45
VERBATIM, PARAPHRASE, ANSWER_SHARE = 0.7, 0.5, 0.6
ANSWER = 6
CELLS = 1 << 20             # of hits by words of an item, held at once
SLACK = 1.5                 # words of the document looked at, as a multiple of the item's
DENSE = 0.9                 # of a common subsequence, in a stretch of SLACK times the item's length
UNIT = 16                   # words of the document, in which its stretches are counted
_WORD = re.compile(r"\w+")
# lower-case word characters of Latin-1, and blanks for its other characters
_LATIN = "".join(c if _WORD.match(c) else " " for c in map(str.lower, map(chr, range(256)))).encode("latin-1")


def words_of(text: str | None) -> list[str]:
    """The matches of ``\\w+`` in the text in lower case."""
    if not text:
        return []
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(text.lower())


def term(word: str) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit rows of ``a``."""
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    row = full = (1 << len(a)) - 1
    for x in b:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def cut(words: list) -> list[tuple[int, int]]:
    """Equal spans of at most PASSAGE words."""
    n = max(1, math.ceil(len(words) / PASSAGE))
    edges = [round(k * len(words) / n) for k in range(n + 1)]
    return list(zip(edges, edges[1:]))


def _sketch(terms: np.ndarray, width: int) -> np.ndarray:
    """A Gaussian row for each term, the same in every task."""
    out = np.empty((len(terms), width))
    for k, t in enumerate(terms):
        out[k] = np.random.Generator(np.random.PCG64(int(t) & (1 << 63) - 1)).standard_normal(width)
    return out


def document_frequencies(docs: DataFrame, vocabulary) -> DataFrame:
    """Of the terms in a broadcast vocabulary, over all documents."""
    def keys_of(batch):
        known = vocabulary.value
        held: Counter[str] = Counter()
        for value in batch.column(0).to_pylist():
            held.update(known.keys() & set(words_of(value)))
        keys = np.array([known[w] for w in held], np.int64)
        yield keys, np.array(list(held.values()), np.int64)

    return counts_in_batches(docs, keys_of)


def latent_terms(passages: DataFrame, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Randomised SVD of the matrix of ``passages`` (terms array<long>, weights
    array<double>): the terms and their rows of the right singular vectors. There
    can't be more directions than terms, however small the benchmark.

    Each step multiplies with the matrix and its transpose where the rows are, and
    sums what tasks send by term. Only columns over the terms of one block, of
    rank + OVERSAMPLE numbers each, come to the driver."""
    width = min(rank + OVERSAMPLE, passages.select(F.explode("terms")).distinct().count())

    def apply(basis):
        """Sum over rows x of x'(x B): the term, and its row of the product."""
        def run(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for t, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    t, w = np.array(t, np.int64), np.array(w)
                    if basis is None:
                        y = w @ _sketch(t, width)
                    else:
                        terms, rows = basis.value
                        y = w @ rows[np.searchsorted(terms, t)]
                    for k, x in zip(t.tolist(), w):
                        total[k] = total[k] + x * y if k in total else x * y
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], ["term", "row"])

        sums = passages.mapInArrow(run, "term long, row array<double>").select(
            "term", *[F.col("row")[k].alias(f"c{k}") for k in range(width)]).groupBy("term").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(width)])
        found = sums.orderBy("term").toArrow()
        return np.array(found.column(0)), np.stack([np.array(found.column(k + 1)) for k in range(width)], 1) if found.num_rows else np.zeros((0, width))

    terms, z = apply(None)
    context = passages.sparkSession.sparkContext
    for step in range(POWER):
        if not len(terms):
            break
        q, _ = np.linalg.qr(z)
        held = context.broadcast((terms, q))
        terms, z = apply(held)
        if step == POWER - 1:     # Rayleigh-Ritz: directions of the largest singular values
            values, vectors = np.linalg.eigh(q.T @ z)
            order = np.argsort(values)[::-1][:rank]
            order = order[values[order] > 1e-9 * max(values.max(), 1e-30)]
            z = q @ vectors[:, order]
        held.unpersist()
    return terms, z


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """Rows (doc_id, item_id, cosine, lcs_share, answer_share, at_word): for each
    document and item that it leaks, the best match."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col(item).alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")).filter("text is not null").distinct()
    counted = items.agg(F.count("*"), F.coalesce(F.sum(F.ceil(F.size(F.split("text", r"\s+")) / PASSAGE)), F.lit(0))).first()
    blocks = max(1, math.ceil(counted[1] / BLOCK))
    kind = source.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind[0]}, item_id {kind[1]}, cosine double, lcs_share double, answer_share double, at_word int"
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    out = None
    n_docs = source.count()
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()      # about BLOCK passages
        entries = [(r["item_id"], words_of(r["text"]), words_of(r["answer"])) for r in rows]
        short = [(i, w) for i, w, _ in entries if EXACT <= len(w) < SHORTEST]
        entries = [(i, w, a or w[-ANSWER:]) for i, w, a in entries if len(w) >= SHORTEST]
        for part in ([_search_block(spark, source, entries, n_docs, schema, item_type)] if entries else []) + (
                [_exact_sequences(spark, source, short, schema, item_type)] if short else []):
            out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return out


def _exact_sequences(spark, source: DataFrame, short: list, schema: str, item_type: pa.DataType) -> DataFrame:
    """Where the words of the items stand in a document one behind the other."""
    sought: dict[tuple, list] = {}
    for item, words in short:
        sought.setdefault(tuple(words), []).append(item)
    shared = spark.sparkContext.broadcast((sought, sorted({len(w) for w in sought}), {w[0] for w in sought}))

    def run(batches):
        sought, lengths, heads = shared.value
        for batch in batches:
            rows, items, starts = [], [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                words, seen = words_of(value), set()
                for at, word in enumerate(words):
                    for n in lengths if word in heads else ():
                        found = tuple(words[at:at + n])
                        if found in sought and found not in seen:
                            seen.add(found)
                            for item in sought[found]:
                                rows.append(row)
                                items.append(item)
                                starts.append(at)
            one = pa.array([1.0] * len(rows), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, item_type), one, one, one, pa.array(starts, pa.int32())],
                                             ["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "at_word"])

    return source.mapInArrow(run, schema)


def _search_block(spark, source: DataFrame, entries: list, n_docs: int, schema: str, item_type: pa.DataType) -> DataFrame:
    context = spark.sparkContext
    vocabulary = context.broadcast({w: term(w) for _, words, answer in entries for w in (*words, *answer)})
    frequency = {r["key"]: r["n"] for r in document_frequencies(source.select("text"), vocabulary).collect()}
    idf = {t: math.log((n_docs + 1) / (frequency.get(t, 0) + 1)) + 1e-3 for t in vocabulary.value.values()}
    passages, owner = [], []
    for number, (_, words, _) in enumerate(entries):
        for start, end in cut(words):
            counts: dict[int, int] = {}
            for w in words[start:end]:
                counts[vocabulary.value[w]] = counts.get(vocabulary.value[w], 0) + 1
            weights = np.array([(1 + math.log(n)) * idf[t] for t, n in counts.items()])
            passages.append((list(counts), (weights / (np.linalg.norm(weights) or 1)).tolist()))
            owner.append(number)
    frame = pinned(spark.createDataFrame(passages, "terms array<long>, weights array<double>"))
    terms, directions = latent_terms(frame, min(RANK, len(passages)))
    place = {int(t): k for k, t in enumerate(terms)}
    latent = np.array([np.array(w) @ directions[[place[t] for t in ts]] for ts, w in passages])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    weighted = np.array([idf[int(t)] for t in terms])[:, None] * directions
    # words by row of the space; row 0 stands for all other words, the last rows for those of answers alone
    for t in vocabulary.value.values():
        place.setdefault(t, len(place))
    rows = {w: place[t] + 1 for w, t in vocabulary.value.items()}
    space = np.zeros((len(place) + 1, weighted.shape[1]), np.float32)
    space[1:len(weighted) + 1] = weighted
    model = context.broadcast((
        rows, space, latent.astype(np.float32), np.array(owner),
        [(i, np.array(at), [rows[w] for w in answer], *np.unique(at, return_counts=True)) for i, at, answer in
         ((i, [rows[w] for w in words], answer) for i, words, answer in entries)],
        _places([np.array([rows[w] for w in words]) for _, words, _ in entries])))

    def run(batches):
        known, space, wanted, owners, texts, places = model.value
        step = PASSAGE // 4
        lengths = np.array([len(words) for _, words, *_ in texts])
        for batch in batches:
            found: list[list] = [[] for _ in range(6)]
            ids = batch.column(0)
            rows_of: list[int] = []
            for row, value in enumerate(batch.column(1).to_pylist()):
                words = words_of(value)
                if len(words) < SHORTEST:
                    continue
                at = np.fromiter(map(known.get, words, repeat(0)), np.int32, len(words))
                passages = np.flatnonzero(np.isin(owners, _possible(at, len(space), places, lengths)))
                if not len(passages):
                    continue
                for number, cosine, lcs_share, answer_share, start in _matches(at, space, wanted[passages], owners[passages], texts, step):
                    rows_of.append(row)
                    for column, x in zip(found[1:], (texts[number][0], cosine, lcs_share, answer_share, start)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows_of, pa.int64())), *[pa.array(c, t) for c, t in zip(found[1:], (item_type, pa.float64(), pa.float64(), pa.float64(), pa.int32()))]],
                ["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "at_word"])

    return source.mapInArrow(run, schema)


def _places(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Each word that items have, and each repeat of it that any has: its row of the space,
    which repeat it is, and where its items stand in the last array."""
    having: dict[tuple[int, int], list[int]] = {}
    for number, at in enumerate(texts):
        for row, times in zip(*(x.tolist() for x in np.unique(at, return_counts=True))):
            for k in range(times):
                having.setdefault((row, k + 1), []).append(number)
    rows, repeats = (np.array([x[k] for x in having], np.int64) for k in range(2))
    return rows, repeats, np.cumsum([0, *map(len, having.values())]), np.array([i for x in having.values() for i in x], np.int64)


def _possible(at: np.ndarray, n_rows: int, places: tuple[np.ndarray, ...], lengths: np.ndarray) -> np.ndarray:
    """The items that a document can hold: it has PARAPHRASE of the item's words, and a
    stretch of SLACK times the item's length has DENSE of these, a word as often as both
    have it. No common subsequence is longer than that. ``lengths`` of the items, and
    their ``places``."""
    rows, repeats, ends, items = places
    often = np.bincount(at, minlength=n_rows)
    here = np.flatnonzero(often[rows] >= repeats)
    sizes = ends[here + 1] - ends[here]
    items = items[np.arange(sizes.sum()) + np.repeat(ends[here] - np.cumsum(sizes) + sizes, sizes)]
    able = np.flatnonzero(np.bincount(items, minlength=len(lengths)) >= PARAPHRASE * lengths)
    if not len(able):
        return able
    column = np.full(len(lengths), -1)
    column[able] = np.arange(len(able))
    columns = column[items]
    taken = np.flatnonzero(columns >= 0)
    wanted = np.zeros((len(here), len(able)), np.float32)
    wanted[np.repeat(np.arange(len(here)), sizes)[taken], columns[taken]] = 1
    some = np.flatnonzero(wanted.any(axis=1))
    here, wanted = here[some], wanted[some]
    often[:] = 0
    often[rows[here]] = 1
    width = int(often.sum())
    code = np.cumsum(often) * often     # numbers of the words
    found = code[at]
    hits = np.flatnonzero(found)
    n_units = len(at) // UNIT + 1
    counts = np.bincount((hits // UNIT + 1) * width + found[hits] - 1, minlength=(n_units + 1) * width).reshape(-1, width).cumsum(axis=0)
    counts, repeats = counts[:, code[rows[here]] - 1], repeats[here]
    # any stretch of so many words lies in so many units
    across = np.minimum(((SLACK * lengths[able]).astype(int) + UNIT - 2) // UNIT + 1, n_units)
    stays = np.zeros(len(able), bool)
    for n in np.unique(across):
        own = np.flatnonzero(across == n)
        seen = (counts[n:] - counts[:-n] >= repeats).astype(np.float32)
        stays[own] = (seen @ wanted[:, own]).max(axis=0) >= DENSE * PARAPHRASE * lengths[able[own]] - 1e-3
    return able[stays]


def _matches(at: np.ndarray, space: np.ndarray, wanted: np.ndarray, owners: np.ndarray, texts: list, step: int) -> list[tuple]:
    """Verified items of one document, given the rows of its words in the space."""
    starts = np.arange(0, max(1, len(at) - PASSAGE + step), step)
    near: dict[int, dict[int, float]] = {}      # of each item, its windows and their cosines
    for first in range(0, len(starts), 2048):       # long documents in slices
        part = starts[first:first + 2048]
        low, high = int(part[0]), min(len(at), int(part[-1]) + PASSAGE)
        here = at[low:high]
        hit = np.flatnonzero(here)
        if not len(hit):
            continue
        sums = np.zeros((len(hit) + 1, space.shape[1]), np.float32)
        np.cumsum(space[here[hit]], axis=0, out=sums[1:])
        a, b = np.searchsorted(hit, part - low), np.searchsorted(hit, np.minimum(part + PASSAGE, high) - low)
        vectors = sums[b] - sums[a]
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        cosines = vectors @ wanted.T
        fits = (cosines >= COSINE) & ((b - a) >= SHORTEST // 2)[:, None]
        window, passage = np.nonzero(fits)
        for number, start, cosine in zip(owners[passage].tolist(), part[window].tolist(), cosines[window, passage].tolist()):
            held = near.setdefault(number, {})
            held[start] = max(held.get(start, -1.0), cosine)
    out, place = [], np.zeros(len(space), np.int32)
    for number, windows in sorted(near.items()):
        found = _verified(at, windows, *texts[number][1:], place)
        if found:
            out.append((number, *found))
    return out


def _covered(at: np.ndarray, lows: np.ndarray, highs: np.ndarray, distinct: np.ndarray, times: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For regions ``at[low:high]``, how many words of an item are found in them at all:
    its ``distinct`` words, which it has so many ``times``. ``place`` is a scratch array
    over the rows of the space, all 0."""
    base = int(lows[0])
    place[distinct] = np.arange(1, len(distinct) + 1)
    codes = place[at[base:int(highs[-1])]]
    place[distinct] = 0
    hits = np.flatnonzero(codes)
    if len(hits) * len(distinct) > CELLS:      # halves, down to one region
        if len(lows) == 1:
            return times[np.unique(codes[hits]) - 1].sum(keepdims=True)
        half = len(lows) // 2
        return np.concatenate([_covered(at, lows[k], highs[k], distinct, times, place) for k in (slice(half), slice(half, None))])
    seen = np.zeros((len(hits) + 1, len(distinct)), np.int32)
    seen[np.arange(1, len(hits) + 1), codes[hits] - 1] = 1
    np.cumsum(seen, axis=0, out=seen)
    here = seen[np.searchsorted(hits, highs - base)] > seen[np.searchsorted(hits, lows - base)]
    return here.astype(np.float64) @ times


def _verified(
    at: np.ndarray, windows: dict[int, float], words: np.ndarray, answer: list, distinct: np.ndarray, times: np.ndarray, place: np.ndarray,
) -> tuple | None:
    """(cosine, LCS share, answer share, start) of the nearest window that holds the
    item. ``place`` is a scratch array over the rows of the space, all 0."""
    reach = int(SLACK * len(words))
    starts = np.array(sorted(windows))
    lows, highs = np.maximum(starts - reach, 0), np.minimum(starts + PASSAGE + reach, len(at))
    # the subsequence can't be longer than the words found at all
    possible = starts[_covered(at, lows, highs, distinct, times, place) >= PARAPHRASE * len(words)].tolist()
    item, tried = words.tolist(), set()
    for start in sorted(possible, key=lambda s: (-round(windows[s], 6), s)):
        low, high = max(0, start - reach), min(len(at), start + PASSAGE + reach)
        content = at[low:high].tobytes()
        if content in tried:
            continue
        tried.add(content)
        region = at[low:high].tolist()
        share = lcs(item, region) / len(item)
        if share < PARAPHRASE:
            continue
        answered = lcs(answer, region) / len(answer) if answer else 0.0
        if (share >= VERBATIM or answered >= ANSWER_SHARE) and _dense(item, region, share):
            return windows[start], share, answered, start
    return None


def _dense(words: list, region: list, share: float) -> bool:
    """Whether the common subsequence lies close together: its best part within
    SLACK times the item's length keeps DENSE of it. Common words spread
    over a long region are no leak."""
    length = int(SLACK * len(words))
    if len(region) <= length:
        return True
    step = max(1, len(words) // 4)
    return any(lcs(words, region[k:k + length]) >= DENSE * share * len(words) for k in range(0, len(region) - length + step, step))


@query()
def op3_latent_decontamination(spark, folder):
    found = leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select("doc_id", F.col("item_id").cast(LongType()).alias("item_id"), "cosine", "lcs_share", "answer_share", "at_word")


def stage(spark, docs, folder):
    """Drop the documents that leak an item. Documents are told apart by id and
    text, so a repeated id with another text stays."""
    mark, key, text_hash = fresh(docs, "mark"), fresh(docs, "key"), fresh(docs, "hash")
    hashed = docs.withColumn(mark, F.xxhash64("text"))
    found = leaks(hashed.select(F.struct("doc_id", mark).alias("key"), "text"), table(spark, folder, "benchmark"), key="key")
    bad = pinned(found.select(F.col("doc_id.doc_id").alias(key), F.col(f"doc_id.{mark}").alias(text_hash)).distinct())
    return hashed.join(bad, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(text_hash)), "left_anti").select(*docs.columns)
