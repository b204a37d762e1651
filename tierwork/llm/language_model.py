"""N-gram language model in a log-frequency Bloom filter.

Tokens are words between white space, after A-Z are lowered, and one end mark for
each text. All unigrams and bigrams of the training texts are counted. A count c is
quantised to the level 1 + floor(log(c) / log(BASE)), and the n-gram goes into the
filter once for each level up to its own. A reader probes level 1, 2, ... until one
is not a member; the last member stands for the count in the middle of its level.

N-grams are dealt out by ranges of their hashes, as many as the texts' size asks for.
Tasks send what they have counted as sorted hashes, packed as gaps, once to each
range; there the counts meet, and the range makes its own filter, with one bit for
1 / FILL insertions, in the same task. The filter holds every n-gram, so it grows with
the data. Filters and exact token counts of the ranges are stored. Up to FILTER_MB the
filters come to the driver and are broadcast. Otherwise each stream of texts sends its
different n-grams, once each, to their ranges, where they are probed, and gets back
levels and exact counts; so no range has a hot key and neither driver nor task holds
more than a range. Scores are the same either way. Only a caller that asks for
``filter_mb`` gets a bounded filter: then the n-grams of the lowest counts are left to
the smoothing, and the cutoffs are part of the model.

A token's probability mixes its bigram estimate, weighted by WEIGHT where the
history is known, with its unigram estimate, which is smoothed by 0.1 for each of
the V + 1 tokens; both come from probes alone. The score of a text is the sum of
log10 probabilities over its tokens, the end included.

``base_score`` needs exact counts: those of the ranges, or, beside a broadcast filter,
those of the most frequent tokens (a bounded number), which are broadcast too; the
other tokens of a text then go, by hash, to the exact count table in a join. Tokens
are told apart by 64-bit hashes, n-grams in the filter by the upper 44 bits.

Defined cases: a NULL or empty text has its end as only token. Without training
rows N and V are 0, counts are 0, and every token has probability 1. Rows may repeat
or have NULL ids; each gets its own result row. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from .common import fold, pinned, query, table

BASE = 1.6                  # ratio of counts between levels
FILTER_MB = 24              # of a filter that is broadcast
RANGE_BYTES = 16 << 20      # of training texts that a range stands for
RANGES = 24                 # at least
PROBES = 4                  # bits of an insertion
FILL = 0.08                 # insertions for each bit, at most
BLOCK_BITS = 1 << 16        # bits of a filter block; an n-gram lies within one
FREQUENT = 400_000          # tokens whose exact counts are broadcast
WEIGHT = 0.4
SMOOTHING = 0.1
CACHE = 500_000
DROPPED = np.uint64(20)     # bits of a hash that the filter does without
STREAM = 1_000_000          # tokens of texts that are looked up together
FLUSH = 3_000_000           # tokens that a task counts before it sends anything
PROBED = 8 << 20            # packed bytes of n-grams that are probed at once
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
END = 0x5DEECE66D1A4B086    # stands for the end of a text
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _Hashes(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        value = self[token] = xxhash.xxh3_64_intdigest(token, 7) & ~1
        return value


def tokens_of(text: str | None, seen: _Hashes) -> np.ndarray:
    """Hashes of the tokens of a text, its end last. Of bytes, ``lower`` and ``split``
    know the letters A-Z and the white space of _TOKEN alone."""
    found = text.encode().lower().split() if text else []
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(seen.__getitem__, found), np.uint64, len(found))
    out[-1] = END
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def paired(before: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Bigrams, from the 44 bits of their unigrams."""
    return mixed(before * _M1 + mixed(short * _M3))


def bigrams(tokens: np.ndarray) -> np.ndarray:
    """Of each token with the one before it; a text begins after an end."""
    one = mixed(np.concatenate([np.array([END], np.uint64), tokens]) * _M3) >> DROPPED
    return paired(one[:-1], one[1:])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys and, for each key, its place among them."""
    where, unique = pd.factorize(keys.view(np.int64))
    return unique.view(np.uint64), where


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9).astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for; 0 for level 0."""
    low = np.ceil(BASE ** np.maximum(level - 1, 0) - 1e-9)
    high = np.maximum(np.ceil(BASE ** np.maximum(level, 1) - 1e-9) - 1, low)
    return np.where(level > 0, np.sqrt(low * high), 0.0)


def home(short: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """The block of an n-gram (44 bits) among those of its range; the upper 24 bits
    name the range."""
    return (short & np.uint64(0xFFFFF)).astype(np.int64) % blocks


def positions(short: np.ndarray, block: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First bit of each n-gram (44 bits) at a level and the step to the next ones,
    which stay within the n-gram's block."""
    h = mixed(short + np.array([level], np.uint64) * _M1)
    return block * BLOCK_BITS + (h & np.uint64(BLOCK_BITS - 1)).astype(np.int64), ((h >> np.uint64(33)) | np.uint64(1)).astype(np.int64)


def further(first: np.ndarray, step: np.ndarray, probe: int) -> np.ndarray:
    """The bit of a later probe."""
    low = first & (BLOCK_BITS - 1)
    return first - low + ((low + probe * step) & (BLOCK_BITS - 1))


def place_of(short: np.ndarray, places: int) -> np.ndarray:
    """The range of n-grams (44 bits), in their order."""
    return ((short >> np.uint64(20)) * np.uint64(places) >> np.uint64(24)).astype(np.int64)


@dataclass
class Model:
    bits: np.ndarray | None     # the filters of all ranges, as bytes; None where they are ``stored``
    sizes: np.ndarray           # blocks of each range
    deepest: int                # largest level in use
    total: int                  # N
    distinct: int               # V
    cutoffs: dict[str, int]     # smallest counts that the filter holds, by order
    stored: DataFrame | None = None     # the ranges (RANGE) of a filter that is not broadcast

    def __getstate__(self):
        return {**self.__dict__, "stored": None}

    @property
    def blocks(self) -> int:
        return int(self.sizes.sum())

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Levels of n-grams, from the broadcast filters."""
        short = grams >> DROPPED
        place = place_of(short, len(self.sizes))
        return self.found(short, (np.cumsum(self.sizes) - self.sizes)[place] + home(short, self.sizes[place]), self.bits)

    def found(self, short: np.ndarray, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Found by probing level after level; only members go on."""
        out = np.zeros(len(short), np.int64)
        alive = np.arange(len(short))
        for level in range(1, self.deepest + 1):
            if not len(alive):
                break
            first, step = positions(short[alive], block[alive], level)
            for probe in range(PROBES):     # most that are not members leave at the first bit
                at = further(first, step, probe)
                member = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                alive, first, step = alive[member], first[member], step[member]
            out[alive] = level
        return out

    def log10(self, tokens: np.ndarray, unique: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Of each token of a stream of texts, each with its end as last token; so
        what stands before the first token of a text is an end as well. ``unique``
        and ``where`` are those of the tokens."""
        if not self.total:
            return np.zeros(len(tokens))
        pairs, at = distinct(bigrams(tokens))
        return self.mixture(middle(self.levels(mixed(unique * _M3)))[where], middle(self.levels(pairs))[at])

    def mixture(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """From the counts of the tokens of a stream, and of their bigrams."""
        base = (one + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1))
        before = np.concatenate([one[-1:], one[:-1]])       # the stream ends in an end
        known = before > 0
        estimate = np.divide(np.minimum(two, before), before, out=np.zeros(len(two)), where=known)
        weight = np.where(known, WEIGHT, 0.0)
        return np.log10(weight * estimate + (1 - weight) * base)


def streams(texts: list, seen: _Hashes):
    """Lists of token arrays of some texts, about STREAM tokens at a time."""
    held, size = [], 0
    for text in texts:
        held.append(tokens_of(text, seen))
        size += len(held[-1])
        if size >= STREAM:
            yield held
            held, size = [], 0
    if held:
        yield held


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers, bytes of equal weight together, compressed."""
    return zstandard.compress(x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys, as gaps."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data), dtype=np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and the sum of their counts (1 each by default)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[edges], np.diff(np.r_[edges, len(keys)])
    order = np.argsort(keys)
    keys = keys[order]
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[edges], np.add.reduceat(counts[order], edges)


def _cuts(short: np.ndarray, places: int) -> np.ndarray:
    """Where each range begins among sorted n-grams (44 bits), and the end."""
    return np.searchsorted(place_of(short, places), np.arange(places + 1))


ONES, TWOS = 0, 1       # kinds of n-grams: unigrams, known by 64 bits, and bigrams, by 44


def counted(docs: DataFrame, places: int) -> DataFrame:
    """place, kind, keys, counts: n-grams of the texts of ``docs`` (text), as each task
    has counted them."""
    def run(batches):
        seen = _Hashes()
        ones, twos, size = [], [], 0

        def sent():
            out = []
            for kind, held, drop in ((ONES, ones, DROPPED), (TWOS, twos, np.uint64(0))):
                keys, counts = _summed(np.concatenate(held))
                cuts = _cuts(keys >> drop, places)
                out += [(k, kind, _packed(keys[a:b]), _planes(counts[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary()),
                 pa.array([r[3] for r in out], pa.binary())], ["place", "kind", "keys", "counts"])

        for batch in batches:
            for held in streams(batch.column(0).to_pylist(), seen):
                tokens = np.concatenate(held)
                ones.append(mixed(tokens * _M3))
                twos.append(bigrams(tokens) >> DROPPED)
                size += len(tokens)
                if size >= FLUSH:
                    yield sent()
                    ones, twos, size = [], [], 0
        if size:
            yield sent()

    return docs.mapInArrow(run, "place long, kind int, keys binary, counts binary")


def _met(batches):
    """Each range with its n-grams, unigrams and bigrams: sorted keys and counts."""
    current, held = None, ([], [])

    def merged():
        out = []
        for pieces in held:
            keys = [_unpacked(k) for k, _ in pieces]
            counts = [_numbers(c).astype(np.int64) for _, c in pieces]
            out.append(_summed(np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])))
        return current, *out

    for batch in batches:
        for place, kind, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if place != current:
                if current is not None:
                    yield merged()
                current, held = place, ([], [])
            held[kind].append((keys, counts))
    if current is not None:
        yield merged()


def _cutoff(counts: DataFrame, room: float) -> tuple[int, float]:
    """Smallest count that is held within ``room`` insertions, and the insertions, from
    how many n-grams have each count (n, rows). One row for each count up to the base
    of level 8, and for each level beyond, is all that is looked at."""
    low = math.ceil(BASE ** 7)
    level = (1 + F.floor(F.log(F.col("n").cast("double")) / math.log(BASE) + 1e-9)).cast("int")
    shown = F.when(F.col("n") < low, F.col("n")).otherwise(F.lit(low) + level)
    rows = sorted((r["shown"], r["rows"], r["level"]) for r in
                  counts.groupBy(shown.alias("shown")).agg(F.sum("rows").alias("rows"), F.max(level).alias("level")).collect())
    held, cut = 0.0, None
    for shown_, n, level in reversed(rows):
        if held + n * level > room:
            break
        held, cut = held + n * level, shown_
    if cut is None:
        return 1 << 62, 0.0
    return (cut if cut < low else math.ceil(BASE ** (cut - low - 1) - 1e-9)), held


def _ranges(met: DataFrame) -> DataFrame:
    return met.repartition("place").sortWithinPartitions("place")


RANGE = "place long, blocks long, deepest int, total long, distinct long, bits binary, keys binary, counts binary"


def train(docs: DataFrame, text: str = "text", filter_mb: float | None = None) -> tuple[Model, DataFrame]:
    """The model, and the exact counts of tokens (key, n), stored. The filter holds
    all n-grams unless ``filter_mb`` bounds it."""
    source = docs.select(F.col(text).cast("string").alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    places = min(max(RANGES, math.ceil(size / RANGE_BYTES)), 1 << 16)
    cuts = [1, 1]
    if filter_mb is None:
        sent = counted(source, places)
    else:
        room = FILL * int(filter_mb * (1 << 23))
        places = max(1, min(places, int(filter_mb * (1 << 23)) // BLOCK_BITS // 8))
        sent = pinned(counted(source, places))

        def histogram(batches):
            for _, *both in _met(batches):
                for kind, (_, counts) in enumerate(both):
                    n, rows = np.unique(counts, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind), pa.int32()), pa.array(n, pa.int64()), pa.array(rows, pa.int64())], ["kind", "n", "rows"])

        held = pinned(_ranges(sent).mapInArrow(histogram, "kind int, n long, rows long").groupBy("kind", "n").agg(F.sum("rows").alias("rows")))
        cuts[ONES], used = _cutoff(held.filter(F.col("kind") == ONES), 0.3 * room)
        cuts[TWOS], _ = _cutoff(held.filter(F.col("kind") == TWOS), room - used)

    def fill(batches):
        for place, (ones, n_ones), (twos, n_twos) in _met(batches):
            top = level_of(np.concatenate([n_ones[n_ones >= cuts[ONES]], n_twos[n_twos >= cuts[TWOS]]]))
            short = np.concatenate([ones[n_ones >= cuts[ONES]] >> DROPPED, twos[n_twos >= cuts[TWOS]]])
            # as many bits as the insertions ask for
            blocks = math.ceil(int(top.sum()) / FILL) // BLOCK_BITS + 1
            deepest = int(top.max()) if len(top) else 0
            bits, block = np.zeros(blocks * BLOCK_BITS, np.uint8), home(short, blocks)
            for level in range(1, deepest + 1):
                chosen = top >= level
                first, step = positions(short[chosen], block[chosen], level)
                for probe in range(PROBES):
                    bits[further(first, step, probe)] = 1
            row = (place, blocks, deepest, int(n_ones.sum()), len(ones), zstandard.compress(np.packbits(bits, bitorder="little").tobytes(), 1), _packed(ones), _planes(n_ones))
            yield pa.RecordBatch.from_pylist([dict(zip(names, row))], made)

    names = [field.split()[0] for field in RANGE.split(", ")]
    made = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])))
    path = scratch_path(source.sparkSession, "ranges")
    _ranges(sent).mapInArrow(fill, RANGE).write.parquet(path)
    ranges = source.sparkSession.read.schema(RANGE).parquet(path)
    sizes, deepest, total, distinct_ = np.ones(places, np.int64), 0, 0, 0
    for r in ranges.select("place", "blocks", "deepest", "total", "distinct").collect():     # a row of numbers for each range
        sizes[r["place"]] = r["blocks"]
        deepest, total, distinct_ = max(deepest, r["deepest"]), total + r["total"], distinct_ + r["distinct"]
    model = Model(None, sizes, deepest, total, distinct_, {"unigrams": cuts[ONES], "bigrams": cuts[TWOS]})

    def opened(batches):
        for batch in batches:
            for keys, counts in zip(*(batch.column(k).to_pylist() for k in range(2))):
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(keys).view(np.int64)), pa.array(_numbers(counts).astype(np.int64))], ["key", "n"])

    counts = ranges.select("keys", "counts").mapInArrow(opened, "key long, n long")
    if model.blocks * BLOCK_BITS > FILTER_MB * (1 << 23):
        model.stored = ranges
        return model, counts
    size = BLOCK_BITS // 8
    model.bits = np.zeros(model.blocks * size, np.uint8)
    starts = np.cumsum(sizes) - sizes
    for r in ranges.select("place", "blocks", "bits").collect():      # the filters, no more
        at = starts[r["place"]] * size
        model.bits[at:at + r["blocks"] * size] = np.frombuffer(zstandard.decompress(r["bits"]), np.uint8)
    return model, counts


FILTER, ASKED, STREAMED = 0, 1, 2       # kinds of rows on their way between streams and ranges
SENT = "place long, kind int, stream long, a binary, b binary, c binary, rows array<struct<id: {}, n_tokens: long>>"
SENT_NAMES = ["place", "kind", "stream", "a", "b", "c", "rows"]


def _probed(model: Model, schema: str, sent: DataFrame) -> DataFrame:
    """``sent`` with the unigrams (a) of ASKED rows shortened to 44 bits, the bigrams (b)
    replaced by the unigrams' exact counts, and the levels of both in c. ``place`` is the
    range, or below 0 for what passes."""
    filters = model.stored.select(
        "place", F.lit(FILTER).alias("kind"), F.lit(-1).cast("long").alias("stream"), F.col("keys").alias("a"), F.col("counts").alias("b"), F.col("bits").alias("c"),
        F.lit(None).cast(sent.schema["rows"].dataType).alias("rows"))
    together = sent.unionByName(filters).repartition("place").sortWithinPartitions("place", "kind")
    shared = model.__class__(**model.__getstate__())

    def probe(batches):
        current, bits, keys, counts = None, None, None, None

        def answered(asked):
            """For rows of one range: counts and levels."""
            ones, twos = [_unpacked(a) for a, _ in asked], [_unpacked(b) for _, b in asked]
            every = np.concatenate(ones)
            n = np.zeros(len(every), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, every), len(keys) - 1)
                n = np.where(keys[at] == every, counts[at], 0)
            short = np.concatenate([every >> DROPPED, *twos])
            levels = shared.found(short, home(short, len(bits) * 8 // BLOCK_BITS), bits).astype(np.uint8) if len(bits) else np.zeros(len(short), np.uint8)
            i, j = 0, len(every)
            for one, two in zip(ones, twos):
                both = np.concatenate([levels[i:i + len(one)], levels[j:j + len(two)]])
                yield _packed(one >> DROPPED), _planes(n[i:i + len(one)]), zstandard.compress(both.tobytes(), 1)
                i, j = i + len(one), j + len(two)

        for batch in batches:
            places, kinds, a, b, c = (batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5))
            k = 0
            while k < len(kinds):
                if kinds[k] == FILTER:
                    current, bits = places[k], np.frombuffer(zstandard.decompress(c[k]), np.uint8)
                    keys, counts = _unpacked(a[k]), _numbers(b[k]).astype(np.int64)
                elif kinds[k] == ASKED:
                    if places[k] != current:    # a range without n-grams
                        current, bits, keys, counts = places[k], np.zeros(0, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.int64)
                    last = k
                    size = 0
                    while last < len(kinds) and places[last] == current and (last == k or size < PROBED):
                        size += len(a[last]) + len(b[last])
                        last += 1
                    a[k:last], b[k:last], c[k:last] = zip(*answered(list(zip(a[k:last], b[k:last]))))
                    k = last
                    continue
                k += 1
            keep = pa.array([what != FILTER for what in kinds], pa.bool_())
            columns = [*batch.columns[:3], pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(c, pa.binary()), batch.column(6)]
            yield pa.RecordBatch.from_arrays(columns, SENT_NAMES).filter(keep)

    return together.mapInArrow(probe, schema)


def _scored(model: Model, probed: DataFrame, schema: str) -> DataFrame:
    """The rows of each stream, scored from counts and levels of its n-grams."""
    shared = model.__class__(**model.__getstate__())
    weight = model.total + SMOOTHING * (model.distinct + 1)

    def run(batches):
        current, met = None, []
        for batch in batches:
            kinds, ids, a, b, c = (batch.column(k).to_pylist() for k in (1, 2, 3, 4, 5))
            for k, (what, stream) in enumerate(zip(kinds, ids)):
                if stream != current:
                    current, met = stream, []
                if what == ASKED:       # in the order of ranges
                    one = _unpacked(a[k])
                    levels = np.frombuffer(zstandard.decompress(c[k]), np.uint8)
                    met.append((one, _numbers(b[k]).astype(np.int64), levels[:len(one)], levels[len(one):]))
                    continue
                shorts, n, ones, twos = (np.concatenate(x) for x in zip(*met))
                where = _numbers(a[k]).astype(np.int64)
                before = np.concatenate([where[-1:], where[:-1]])       # the stream ends in an end
                pairs, at = np.unique(paired(shorts[before], shorts[where]) >> DROPPED, return_inverse=True)
                if len(pairs) != len(twos):
                    raise RuntimeError("a stream of texts changed while its n-grams were probed")
                value = shared.mixture(middle(ones.astype(np.int64))[where], middle(twos.astype(np.int64))[at])
                rows = batch.column(6).slice(k, 1).flatten()
                sizes = np.array(rows.field("n_tokens"))
                starts = np.cumsum(sizes) - sizes
                base = np.log10((n + SMOOTHING) / weight)[where]
                columns = [rows.field("id"), rows.field("n_tokens"), pa.array(np.add.reduceat((n > 0).astype(np.int64)[where], starts), pa.int64()),
                           pa.array(np.add.reduceat(base, starts), pa.float64()), pa.array(np.add.reduceat(value, starts), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "n_known", "base", "score"])

    return probed.repartition("stream").sortWithinPartitions("stream", "kind", "place").mapInArrow(run, schema)


def _by_ranges(source: DataFrame, model: Model, kind: str) -> DataFrame:
    """id, n_tokens, n_known, base, score of ``source`` (id, text), from the stored ranges."""
    places = len(model.sizes)

    def run(batches):
        seen = _Hashes()
        numbers = itertools.count(TaskContext.get().partitionId() << 36)
        for batch in batches:
            done = 0
            for held in streams(batch.column(1).to_pylist(), seen):
                stream = next(numbers)
                tokens = np.concatenate(held)
                unigrams, where = np.unique(mixed(tokens * _M3), return_inverse=True)
                pairs = np.unique(bigrams(tokens) >> DROPPED)
                ones, twos = _cuts(unigrams >> DROPPED, places), _cuts(pairs, places)
                asked = [p for p in range(places) if ones[p + 1] > ones[p] or twos[p + 1] > twos[p]]
                of = pa.StructArray.from_arrays([batch.column(0).slice(done, len(held)), pa.array([len(t) for t in held], pa.int64())], ["id", "n_tokens"])
                done += len(held)
                n = len(asked) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([*asked, -1 - stream], pa.int64()), pa.array([ASKED] * (n - 1) + [STREAMED], pa.int32()), pa.array([stream] * n, pa.int64()),
                    pa.array([*[_packed(unigrams[ones[p]:ones[p + 1]]) for p in asked], _planes(where)], pa.binary()),
                    pa.array([*[_packed(pairs[twos[p]:twos[p + 1]]) for p in asked], None], pa.binary()), pa.nulls(n, pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0] * n + [len(of)], pa.int32()), of)], SENT_NAMES)

    schema = SENT.format(kind)
    return _scored(model, _probed(model, schema, source.mapInArrow(run, schema)), f"id {kind}, n_tokens long, n_known long, base double, score double")


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``."""
    spark = docs.sparkSession
    weight = model.total + SMOOTHING * (model.distinct + 1)
    source = docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("hash")).alias("id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def named(full: DataFrame, n_known, base):
        return full.select(
            F.col("id.id").alias(key), "n_tokens", n_known.cast("long").alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
            base.alias("base_score") if model.total else F.lit(0.0).alias("base_score"), "score")

    if model.stored is not None:
        return named(_by_ranges(source, model, kind), F.col("n_known"), F.col("base"))
    frequent = counts.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    names = np.array(frequent.column("key")).view(np.uint64)
    order = np.argsort(names)
    shared = spark.sparkContext.broadcast((model, names[order], np.array(frequent.column("n"))[order]))
    everything = len(names) < FREQUENT      # no token is known beyond the broadcast ones

    def run(batches):
        m, known, n_of = shared.value
        seen = _Hashes()
        for batch in batches:
            total, found, base, value, rest = [], [], [], [], []
            for held in streams(batch.column(1).to_pylist(), seen):
                sizes = np.array([len(t) for t in held])
                starts = np.cumsum(sizes) - sizes
                tokens = np.concatenate(held)
                unique, where = distinct(tokens)
                grams = mixed(unique * _M3)
                at = np.minimum(np.searchsorted(known, grams), max(len(known) - 1, 0))
                there = known[at] == grams if len(known) else np.zeros(len(unique), bool)
                logs = np.zeros(len(unique))
                logs[there] = np.log10((n_of[at[there]] + SMOOTHING) / weight)
                hit = there[where]
                missed = grams[where].view(np.int64)
                rest += [t[~h] for t, h in zip(np.split(missed, starts[1:]), np.split(hit, starts[1:]))]
                total += sizes.tolist()
                found += np.add.reduceat(hit.astype(np.int64), starts).tolist()
                base += np.add.reduceat(logs[where], starts).tolist()
                value += np.add.reduceat(m.log10(tokens, unique, where), starts).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(found, pa.int64()), pa.array(base, pa.float64()), pa.array(value, pa.float64()),
                 pa.array(rest, pa.list_(pa.int64()))], ["id", "n_tokens", "n_known", "base", "score", "rest"])

    first = source.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base double, score double, rest array<long>")
    unknown = math.log10(SMOOTHING / weight) if model.total else 0.0
    if everything:
        return named(first, F.col("n_known"), F.col("base") + F.size("rest") * F.lit(unknown))
    first = pinned(first)
    asked = first.select("id", "rest").dropDuplicates(["id"]).select("id", F.explode("rest").alias("key")).groupBy("id", "key").agg(F.count("*").alias("times"))
    met = asked.join(counts, "key", "left")
    sums = met.groupBy("id").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + SMOOTHING) / weight)).alias("log")).withColumnRenamed("id", "of")
    full = first.drop("rest").join(sums, F.col("id").eqNullSafe(F.col("of")), "left")
    return named(full, F.col("n_known") + F.coalesce("more", F.lit(0)), F.col("base") + F.coalesce("log", F.lit(0.0)))


@query()
def op8_bloom_language_model(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model, counts = train(docs.filter(fold("doc_id", 10) != 0))
    return score(docs, model, counts).select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
