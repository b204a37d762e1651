"""Near-duplicate components by circulant MinHash.

1. A text becomes the set of its hashed shingles (WORDS words; A-Z lower-cased, words
   separated by ASCII white space). Documents with equal sets are one class, which
   goes on as one vertex.
2. Two permutations give all HASHES coordinates of a signature. The first one, a
   bijective mixer, sends a shingle to a place x of a circle of CIRCLE places; the
   second one, a shuffled table, is read at x, x + 1, ..., so coordinate k is the
   minimum of the table shifted by k. The coordinates of a shingle are one slice.
3. Bands of ROWS coordinates. A pair at the threshold meets in no band with chance
   (1 - 0.8^5)^40, about 1.3e-7.
4. Every class is compared with the leader (smallest vertex) of each of its bands:
   linear in the classes, whatever the size of a band. The pairs whose sketches (one
   byte a coordinate) agree too seldom, with a chance below TOLERANCE at the threshold,
   are dropped, the others confirmed on full shingle sets. Components of these links
   are the first components.
5. Only pairs of a band in different components are still open. The members outside a
   band's largest component are queries; they are dealt into units that hold about
   QUERIES of them (or SHINGLES shingles) and stream about STREAM members past them, so
   a band made of one component needs no work and a large band is split both ways. A
   first pass by sketches returns the rows of a unit that are near another one, never
   the pairs; a second one gets the sets of these rows, confirms near pairs until their
   components are joined, and returns the links that joined them. A pair is looked at
   in the first band that it shares.

Joins that a leader, a band or a group of copies could overload spread the keys whose
counts are large (``common.attach``, ``_with_sets``). Components end in checkpoints.

Defined cases: a NULL or empty text and a text without words has an empty set
(n_shingles 0) and is linked with nothing. With fewer words than WORDS the whole
sequence is the one shingle. Rows that repeat are rows of their own. NULL doc_id: the
row takes part, and component_id is the smallest non-NULL doc_id of the component
(NULL if there is none); ``kept`` is then false for it unless all are NULL. Other
columns are ignored. Sets are known by 128-bit hashes, shingles by 64-bit ones.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import HOT_SHARE, attach, pinned, query, table
from .components import components

WORDS = 4
PERCENT = 80
HASHES, ROWS = 200, 5
CIRCLE = 1 << 20
TOLERANCE = 1e-9
QUERIES, SHINGLES, STREAM = 512, 1 << 20, 16_384
NAMED = 1_000_000       # row keys that are broadcast at most; more are joined by a shuffle
CACHE = 400_000

_order = np.random.default_rng(11).permutation(CIRCLE).astype(np.uint32)
_TABLE = np.lib.stride_tricks.sliding_window_view(np.concatenate([_order, _order[:HASHES]]), HASHES)


class WordHashes(dict):
    """Hash of each word, kept while words repeat within a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes | None, seen: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    found = text.lower().split() if text else []        # on bytes: A-Z, and white space of ASCII
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(seen.__getitem__, found), np.uint64, len(found))
    width = min(words, len(h))
    n = len(h) - width + 1
    out = np.full(n, 0x9AE16A3B2F90404F + width, np.uint64)
    for k in range(width):
        out = (out ^ h[k:k + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def places(grams: np.ndarray) -> np.ndarray:
    """The first permutation: a bijective mixer, whose top bits name a place of the circle."""
    x = grams ^ (grams >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - CIRCLE.bit_length() + 1)).astype(np.int64)


def signature(grams: np.ndarray) -> np.ndarray:
    """Coordinate k: least value of the second permutation over the places, shifted by k."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = places(grams)
    for at in range(0, len(x), 128):
        np.minimum(low, _TABLE[x[at:at + 128]].min(0), out=low)
    return low


def bands(signatures: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands of each signature."""
    count = HASHES // ROWS
    keys = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), (len(signatures), count)).copy()
    for k in range(ROWS):
        keys = (keys ^ signatures[:, k * count:(k + 1) * count]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def sketch(signatures: np.ndarray) -> np.ndarray:
    """One byte of each coordinate."""
    return ((signatures * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)


def fewest(percent: int = PERCENT, tolerance: float = TOLERANCE) -> int:
    """Fewest equal coordinates that a pair at the threshold has, but for ``tolerance``."""
    t, total, m = percent / 100, 0.0, -1
    while total < tolerance:
        m += 1
        total += math.comb(HASHES, m) * t ** m * (1 - t) ** (HASHES - m)
    return m


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, on sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _described(source: DataFrame, words: int) -> DataFrame:
    """id, row_key, n_shingles, set_key, bands, sketch; the last three NULL for empty sets."""
    def run(batches):
        seen = WordHashes()
        for batch in batches:
            found, keys, sigs = [], [], []
            for value in batch.column(2):
                grams = shingle_set(value.as_py(), seen, words)
                found.append(len(grams))
                keys.append(_set_key(grams) if len(grams) else None)
                sigs.append(signature(grams))
            sigs = np.array(sigs, np.uint32).reshape(-1, HASHES)
            ok = np.array(found, np.int64) > 0
            split, flat = bands(sigs), sketch(sigs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([s.tobytes() if o else None for s, o in zip(split, ok)], pa.binary()),
                 pa.array([s.tobytes() if o else None for s, o in zip(flat, ok)], pa.binary())],
                ["id", "row_key", "n_shingles", "set_key", "bands", "sketch"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, row_key long, n_shingles long, set_key binary, bands binary, sketch binary")


def _members(classes: DataFrame) -> DataFrame:
    """(band, v) for every band of every class."""
    def run(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), HASHES // ROWS))], ["band", "v"])

    return classes.select("v", "bands").mapInArrow(run, "band long, v long")


def _counted(pairs: DataFrame, side: str) -> DataFrame:
    return pairs.groupBy(side).agg(F.count("*").alias("n"))


def _near(pairs: DataFrame, classes: DataFrame, rows: int, limit: int) -> DataFrame:
    """The pairs (a, b) whose sketches agree in ``limit`` coordinates or more."""
    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES) for k in (2, 3))
            yield batch.filter(pa.array((x == y).sum(1) >= limit)).select(["a", "b"])

    for side, name in (("a", "sketch_a"), ("b", "sketch_b")):
        known = classes.select(F.col("v").alias(side), F.col("sketch").alias(name)).join(_counted(pairs, side), side)
        pairs = attach(pairs, known, side, "n", rows)
    return pairs.mapInArrow(run, "a long, b long")


def _with_sets(pairs: DataFrame, sets: DataFrame, side: str, rows: int) -> DataFrame:
    """``pairs`` with the shingle set of one side. A vertex of more than rows / HOT_SHARE
    pairs has copies of its set in several tasks, one for each part of its pairs."""
    limit = max(rows // HOT_SHARE, 1)
    parts = F.broadcast(_counted(pairs, side).filter(F.col("n") > limit).select(side, F.ceil(F.col("n") / limit).cast("int").alias("parts")))
    other = "b" if side == "a" else "a"
    one = F.coalesce("parts", F.lit(1))
    spread = pairs.join(parts, side, "left").withColumn("part", F.pmod(F.xxhash64(other), one).cast("int")).drop("parts")
    copies = sets.withColumnRenamed("v", side).withColumnRenamed("grams", f"grams_{side}").join(parts, side, "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), (one - 1).cast("int")))).drop("parts")
    return spread.join(copies, [side, "part"]).drop("part")


def _sets(vertices: DataFrame, classes: DataFrame, source: DataFrame, words: int) -> DataFrame:
    """(v, grams): the shingle sets of ``vertices``, from one text of each class."""
    wanted = pinned(vertices.join(classes, "v").select("row_key", "v", "set_key"))
    if wanted.count() <= NAMED:     # 8 bytes each: texts that nobody asked for stay where they are
        source = source.join(F.broadcast(wanted.select("row_key").distinct()), "row_key", "left_semi")

    def read(batches):
        seen = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), seen, words) for t in batch.column(2)]
            right = pa.array([_set_key(s) == k for s, k in zip(sets, batch.column(1).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["v", "grams"]).filter(right)

    # a row key that two rows share names the wrong text for one of them: its set key shows it
    texts = source.select("row_key", "text").join(wanted, "row_key").select("v", "set_key", "text")
    return pinned(texts.mapInArrow(read, "v long, grams binary").dropDuplicates(["v"]))


def _confirmed(pairs: DataFrame, classes: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links on their full sets."""
    rows = pairs.count()
    if rows == 0:
        return pairs
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct(), classes, source, words)

    def run(batches):
        for batch in batches:
            a, b = batch.column(batch.schema.get_field_index("grams_a")), batch.column(batch.schema.get_field_index("grams_b"))
            keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(a, b)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return _with_sets(_with_sets(pairs, sets, "a", rows), sets, "b", rows).mapInArrow(run, "a long, b long")


def _units(members: DataFrame) -> DataFrame:
    """``members`` of open bands (with q, blocks and parts of the band) dealt into units
    (band, block, part): queries, side 0, before the members that stream past them."""
    block, part = F.pmod(F.xxhash64("v", F.lit(5)), "blocks").cast("int"), F.pmod(F.xxhash64("v"), "parts").cast("int")
    streamed = members.select("band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part.alias("part"), F.lit(1).alias("side"), "v", "component", "q")
    asked = members.filter("q").select("band", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                       F.lit(0).alias("side"), "v", "component", "q")
    return asked.unionByName(streamed)


class Unit:
    """Queries of one unit, and the pairs that a streamed member makes with them."""

    def __init__(self, band: int, limit: int, percent: int):
        self.band, self.limit, self.percent = band, limit, percent
        self.rows: list[tuple] = []

    def add(self, row: tuple) -> None:
        self.rows.append(row)

    def close(self) -> None:
        self.v, self.component, self.size = (np.array([r[k] for r in self.rows], np.int64) for k in range(3))
        self.bands = np.array([r[3] for r in self.rows], np.int64).reshape(-1, HASHES // ROWS)
        self.sketches = np.array([r[4] for r in self.rows], np.uint8).reshape(-1, HASHES)
        self.place = (self.bands == self.band).argmax(1)

    def near(self, v: int, component: int, size: int, keys: np.ndarray, sketch: np.ndarray, also: bool) -> tuple[np.ndarray, np.ndarray]:
        """Queries that may be linked with a member, and their equal coordinates: of
        other components, of fitting size, met in no earlier band. Two queries meet
        from either side and are taken once."""
        at = (self.component != component) & (100 * np.minimum(self.size, size) >= self.percent * np.maximum(self.size, size))
        if also:
            at &= self.v < v
        at = np.flatnonzero(at)
        equal = (self.sketches[at] == sketch).sum(1)
        at, equal = at[equal >= self.limit], equal[equal >= self.limit]
        first = (self.bands[at] == keys).argmax(1) == self.place[at]
        return at[first], equal[first]


def _touched(units: DataFrame, classes: DataFrame, limit: int, percent: int) -> DataFrame:
    """The rows of ``units`` that are near another one of their unit: at most all of
    them, however many pairs they make."""
    def run(batches):
        unit, name, hit = None, None, np.zeros(0, bool)
        schema = ["band", "block", "part", "side", "v", "component", "q"]

        def made(out):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))], schema)

        def asked():
            return [(*name, 0, int(unit.v[k]), int(unit.component[k]), True) for k in np.flatnonzero(hit)]

        for batch in batches:
            out = []
            bands = np.frombuffer(b"".join(batch.column(8).to_pylist()), np.int64).reshape(-1, HASHES // ROWS)
            sketches = np.frombuffer(b"".join(batch.column(9).to_pylist()), np.uint8).reshape(-1, HASHES)
            for k, (band, block, part, side, v, component, q, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(8)))):
                if (band, block, part) != name:
                    out += asked() if len(hit) else []
                    name, unit, hit = (band, block, part), Unit(band, limit, percent), np.zeros(0, bool)
                if side == 0:
                    unit.add((v, component, size, bands[k], sketches[k]))
                    continue
                if len(hit) == 0:
                    unit.close()
                    hit = np.zeros(len(unit.rows), bool)
                at, _ = unit.near(v, component, size, bands[k], sketches[k], q)
                if len(at):
                    hit[at] = True
                    out.append((*name, 1, v, component, q))
            yield made(out)
        if len(hit):
            yield made(asked())

    known = units.join(classes.select("v", "n_shingles", "bands", "sketch"), "v").select(*units.columns, "n_shingles", "bands", "sketch")
    dealt = known.repartition("band", "block", "part").sortWithinPartitions("band", "block", "part", "side", "v")
    return dealt.mapInArrow(run, "band long, block int, part int, side int, v long, component long, q boolean")


def _linked_in_units(touched: DataFrame, classes: DataFrame, sets: DataFrame, limit: int, percent: int) -> DataFrame:
    """Links (a, b) that join the components of each unit, confirmed on full sets, the
    nearest pairs of a member first; pairs that are joined already are passed over."""
    def run(batches):
        unit, name, grams, root, closed = None, None, [], {}, False

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            out_a, out_b = [], []
            bands = np.frombuffer(b"".join(batch.column(8).to_pylist()), np.int64).reshape(-1, HASHES // ROWS)
            sketches = np.frombuffer(b"".join(batch.column(9).to_pylist()), np.uint8).reshape(-1, HASHES)
            held = batch.column(10)
            for k, (band, block, part, side, v, component, q, size) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(8)))):
                if (band, block, part) != name:
                    name, unit, grams, root, closed = (band, block, part), Unit(band, limit, percent), [], {}, False
                mine = np.frombuffer(held[k].as_py(), np.uint64)
                if side == 0:
                    unit.add((v, component, size, bands[k], sketches[k]))
                    grams.append(mine)
                    continue
                if not closed:
                    unit.close()
                    closed = True
                at, equal = unit.near(v, component, size, bands[k], sketches[k], q)
                for j in at[np.argsort(-equal, kind="stable")].tolist():
                    x, y = find(component), find(int(unit.component[j]))
                    if x != y and linked(mine, grams[j], percent):
                        root[max(x, y)] = min(x, y)
                        out_a.append(v)
                        out_b.append(int(unit.v[j]))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    known = touched.join(classes.select("v", "n_shingles", "bands", "sketch"), "v").join(sets, "v").select(*touched.columns, "n_shingles", "bands", "sketch", "grams")
    dealt = known.repartition("band", "block", "part").sortWithinPartitions("band", "block", "part", "side", "v")
    return dealt.mapInArrow(run, "a long, b long")


def _open(placed: DataFrame, rows: int) -> DataFrame:
    """The rows (band, v, component, n_shingles) of bands whose members are in several
    components, with main, the largest one of the band, its size n, and the number of
    members and shingles outside it."""
    shares = placed.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    mixed = shares.groupBy("band").agg(F.max(F.struct("n", "component", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("k"))
    mixed = mixed.filter("k > 1").select("band", F.col("most.component").alias("main"), "n", F.col("n").alias("members"), (F.col("n") - F.col("most.n")).alias("others"),
                                         (F.col("size") - F.col("most.size")).alias("others_size"))
    return pinned(attach(placed, pinned(mixed), "band", "n", rows).filter("main is not null"))


def _placed(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the component of each."""
    grouped = components(links).select(F.col("vertex").alias("v"), F.col("root").alias("component"))
    return pinned(members.join(grouped, "v", "left").withColumn("component", F.coalesce("component", "v")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
                    queries: int = QUERIES, stream: int = STREAM) -> DataFrame:
    """One row for each row of ``docs``: key, n_shingles, component_id, kept."""
    body = F.col(f"`{text}`").cast("string")
    source = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(f"`{key}`", body).alias("row_key"), body.cast("binary").alias("text"))
    found = pinned(_described(source, words))
    limit = fewest(percent)
    classes = found.filter("set_key is not null").groupBy("set_key").agg(
        F.min("id").alias("low"), F.count("*").alias("copies"), F.min("row_key").alias("row_key"),
        F.min("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = pinned(classes.withColumn("v", F.monotonically_increasing_id()))
    rows = classes.count() * (HASHES // ROWS)

    members = _members(classes)
    crowded = members.groupBy("band").agg(F.min("v").alias("leader"), F.max("v").alias("top"), F.count("*").alias("n")).filter("leader <> top")
    led = pinned(attach(members, crowded.select("band", "leader", "n"), "band", "n", rows).filter("v <> leader"))
    first = pinned(led.select(F.col("v").alias("a"), F.col("leader").alias("b")).distinct())
    near = pinned(_near(first, classes, first.count(), limit))
    links = pinned(_confirmed(near, classes, source, words, percent))

    # bands in which members other than the leader are in different components
    followers = led.select("band", "v").join(classes.select("v", "n_shingles"), "v")
    still = _open(_placed(followers, links), rows)
    sized = still.withColumn("q", F.col("component") != F.col("main")).withColumn("parts", F.ceil(F.col("members") / stream).cast("int")).withColumn(
        "blocks", F.greatest(F.ceil(F.col("others") / queries), F.ceil(F.col("others_size") / SHINGLES)).cast("int"))
    touched = pinned(_touched(_units(sized), classes, limit, percent))
    sets = _sets(touched.select("v").distinct(), classes, source, words)
    links = links.unionByName(pinned(_linked_in_units(touched, classes, sets, limit, percent)))

    joined = components(links).select(F.col("vertex").alias("v"), "root")
    named = classes.select("set_key", "v", "low", "copies").join(joined, "v", "left").withColumn("root", F.coalesce("root", "v"))
    named = pinned(named)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    named = attach(named, lowest, "root", "n", named.count()).select("set_key", "component_id", "copies")
    out = attach(found.filter("set_key is not null").select("id", "n_shingles", "set_key"), named, "set_key", "copies", found.count())
    alone = found.filter("set_key is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return out.select("id", "n_shingles", "component_id").unionByName(alone).select(
        F.col("id").alias(key), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL = rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
                            ELSE list_distinct([array_to_string(w[i:i + {WORDS} - 1], ' ') FOR i IN range(1, len(w) - {WORDS} + 2)]) END AS s
        FROM d),
    classes AS (SELECT min(doc_id) AS v, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
    grams AS (SELECT v, n, unnest(s) AS g FROM classes),
    pairs AS (
        SELECT a.v AS a, b.v AS b FROM grams a JOIN grams b ON a.g = b.g AND a.v <> b.v AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
        GROUP BY a.v, b.v, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
    reach AS (SELECT v, v AS other FROM classes UNION SELECT r.v, p.b FROM reach r JOIN pairs p ON p.a = r.other),
    low AS (SELECT v, min(other) AS component_id FROM reach GROUP BY v)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id,
           s.doc_id = coalesce(l.component_id, s.doc_id) AS kept
    FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND list_sort(s.s) = c.s LEFT JOIN low l ON l.v = c.v"""


@query(_SQL)
def op11_circulant_minhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
