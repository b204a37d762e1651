"""Circulant MinHash, fill-in-middle, prefix trie: each against a brute-force version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from invented import sentence

from tierwork.llm import circulant, common, fill_in_middle, prefixes

TURNS = "conv_id long, turn long, role string, text string"


# ---- circulant MinHash -------------------------------------------------------

def shingle_sets(texts, words=4):
    out = []
    for text in texts:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lower)
        n = min(words, len(found))
        out.append({tuple(found[i:i + n]) for i in range(len(found) - n + 1)} if found else set())
    return out


def brute_components(ids, texts):
    sets = shingle_sets(texts)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    low = {}
    for i, key in enumerate(ids):
        if key is not None:
            low[find(i)] = min(key, low.get(find(i), key))
    return [(ids[i], len(sets[i]), low.get(find(i)) if sets[i] else ids[i]) for i in range(len(sets))]


def families(rng):
    """Copies of one text, a chain of near copies, near misses and texts with nothing in common."""
    base = sentence(rng, 120).split()
    texts = [" ".join(base)] * 12 + [sentence(rng, rng.randint(1, 60)) for _ in range(30)]
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = rng.choice(("other", "word", "here"))
        texts.append(" ".join(copy))
    step = list(base)
    for k in range(20):         # each close to the one before, the ends far apart
        step[5 * k:5 * k + 2] = [f"x{k}", f"y{k}"]
        texts.append(" ".join(step))
    return texts + [texts[0].upper(), "a b", "A  b", "a b c d", "É b c", "é b c", "", None, " \t\n ", "...", "x" * 100_000]


@pytest.mark.parametrize("queries, stream", [(circulant.QUERIES, circulant.STREAM), (3, 7)])
def test_components_equal_brute_force(spark, queries, stream):
    rng = random.Random(11)
    texts = families(rng)
    ids = [1000 - i for i in range(len(texts))]
    rng.shuffle(texts)
    ids += [5, 5, None, None]
    texts += [texts[0], texts[1], texts[0], None]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    found = circulant.near_duplicates(docs, queries=queries, stream=stream).collect()
    order = lambda rows: sorted(rows, key=str)      # noqa: E731
    assert order((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == order(brute_components(ids, texts))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_components_of_edge_rows(spark, edge_docs, no_docs, edge_rows):
    clash = edge_docs.selectExpr("doc_id", "text", "lang AS band", "source AS row_key", "n_chars AS v")
    found = [(r[0], r[1], r[2]) for r in circulant.near_duplicates(clash).collect()]
    assert sorted(found, key=str) == sorted(brute_components([r[0] for r in edge_rows], [r[1] for r in edge_rows]), key=str)
    assert circulant.near_duplicates(no_docs).count() == 0


def test_signature_is_a_shifted_permutation():
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 700, dtype=np.int64).astype(np.uint64))
    at = circulant.places(grams)
    low = circulant.signature(grams)
    for k in (0, 1, 17, circulant.HASHES - 1):
        assert low[k] == circulant._order[(at + k) % circulant.CIRCLE].min()
    other = np.concatenate([grams[:600], grams[:50] ^ np.uint64(12345)])
    share = (circulant.signature(np.unique(other)) == low).mean()
    assert abs(share - 600 / 750) < 0.12
    assert circulant.fewest() < 0.8 * circulant.HASHES


def test_attach_is_a_left_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 4)
    big = spark.createDataFrame([(k % 7 if k % 3 else 1, k) for k in range(90)] + [(None, 1), (99, 2)], "k long, x long")
    small = big.filter("k is not null and k < 6").groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "n", "k * 10 AS y")
    found = common.attach(big, small, "k", "n", big.count())
    wanted = big.join(small.select("k", "y"), "k", "left")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.select("k", "x", "y").collect()), key=str)


# ---- fill in the middle ------------------------------------------------------

def brute_fim(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force_and_reads_back(spark):
    rng = random.Random(3)
    letters = "abc é漢😀<PSM>\n"
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 2, 5, 40))))) for k in range(400)]
    rows += [(400, None), (401, "a<P>b"), (402, "<<P"), (403, "S><M"), (None, "no id"), (None, None), (7, "again"), (7, "again"), (404, "漢字" * 90_000)]
    docs = spark.createDataFrame([(*r, "clash", 9) for r in rows], "doc_id long, text string, form string, n int").repartition(3)
    found = fill_in_middle.restore(fill_in_middle.transform(docs)).collect()
    assert sorted((str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"]) for r in found) == sorted(
        (str(k), n, f, str(a), str(b), o) for (k, n, f, a, b, o) in ((k, *brute_fim(k, t)) for k, t in rows))
    assert sorted(r["restored"] for r in found) == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing(spark, no_docs):
    assert fill_in_middle.restore(fill_in_middle.transform(no_docs)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 7, 8, 9, 1000])
def test_rotation_undoes_itself(monkeypatch, size):
    monkeypatch.setattr(fill_in_middle, "PIECE", 4)
    data = np.arange(size, dtype=np.uint8 if size < 256 else np.int64)
    for cut in {0, 1, size // 3, size}:
        if cut > size:
            continue
        turned = data.copy()
        fill_in_middle.rotate(turned, 0, cut, size)
        assert (turned == np.concatenate([data[cut:], data[:cut]])).all()
        fill_in_middle.rotate(turned, 0, size - cut, size)
        assert (turned == data).all()


# ---- prefix trie -------------------------------------------------------------

def brute_trie(rows):
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            convs.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        made[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        children = lambda p: [q for q in nodes if len(q) == len(p) + 1 and q[:len(p)] == p]     # noqa: E731
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0           # noqa: E731
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(path))))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children(path)),
                    sum(not children(p) for p in below), sum((len(nodes[p]) - 1) * words(p) for p in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talks():
    rng = random.Random(13)
    texts = ["one", "two words", "a  b\tc", "", "é   x"]
    rows = []
    for c in [*range(-25, 60), 1000, 1019, 2021]:
        rows += [(c, t, rng.choice(("user", "assistant")) if c % 3 else "user", rng.choice(texts[:2] if c % 2 else texts)) for t in range(rng.choice((1, 1, 2, 3, 4, 6)))]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(5)]     # one conversation again and again
    rows += [(200, None, None, None), (200, 3, "user", None), (200, 3, "user", "tie"), (200, 3, "user", "tie"), (200, 3, None, "tie"), (None, 1, "user", "lost")]
    return rows + [(300, t, "user", f"turn {t % 3}") for t in range(120)] + [(201, 0, "user", "w " * 30_000)]


@pytest.mark.parametrize("block, chunk", [(prefixes.BLOCK, prefixes.CHUNK), (1, 1), (5, 2)])
def test_trie_equals_brute_force(spark, block, chunk):
    rows = talks()
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "role AS seq", "turn AS slice", "text AS key").repartition(4)
    convs = prefixes.rebuilt(prefixes.sequences(turns))
    found = prefixes.trie(convs, block, chunk).drop("key", "parent_key")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefixes.trie(prefixes.rebuilt(prefixes.sequences(spark.createDataFrame([], TURNS)))).count() == 0
    lone = next(c for c in range(21, 60) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(lone, 0, "user", "gone")]
    found = prefixes.trie(prefixes.rebuilt(prefixes.sequences(spark.createDataFrame(rows, TURNS)))).drop("key", "parent_key")
    assert [tuple(r) for r in found.collect()] == brute_trie(rows)


def test_extents_by_halving_equal_a_scan():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 17, 64, 65):
        lcp = np.append(-1, rng.integers(0, 5, size - 1))
        table = prefixes.RangeMin(lcp)
        at, depth = np.repeat(np.arange(size), 5), np.tile(np.arange(5), size)
        left, right = table.extents(at, depth)
        for i, d, a, b in zip(at, depth, left, right):
            lo = hi = i
            while lo > 0 and lcp[lo] >= d:
                lo -= 1
            while hi + 1 < size and lcp[hi + 1] >= d:
                hi += 1
            assert (a, b) == (lo, hi)
        assert all(table.least(np.array([a]), np.array([b]))[0] == lcp[a:b + 1].min() for a in range(size) for b in range(a, size))
