"""Jaccard join, decontamination, neighbours, components."""

import random

import numpy as np
import pytest
from invented import DOCUMENTS, sentence
from pyspark.sql import functions as F

from tierwork.llm import decontaminate, jaccard, neighbours
from tierwork.llm.components import components


def brute_classes(texts):
    seen = jaccard.WordHashes()
    sets = [frozenset(jaccard.shingles(t, seen).tolist()) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))], links


def test_jaccard_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)       # the large group takes several blocks
    rng = random.Random(1)
    base = sentence(rng, 200).split()
    texts = [sentence(rng, rng.randint(1, 80)) for _ in range(40)]
    for _ in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 7)):
            copy[rng.randrange(len(copy))] = "other"
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), "a b", "a  b!", "", None, "..."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(docs).collect()}
    roots, links = brute_classes(texts)
    low = {}
    for i, r in enumerate(roots):
        low[r] = min(i, low.get(r, i))
    assert found == {i: (low[roots[i]], links[i]) for i in range(len(texts))}


def test_pruning_limits():
    limits = jaccard.fewest_matches(0.8, 1e-6)
    assert all(0 < limits[n] < n * 0.8 for n in limits) and limits[128] > limits[64]
    assert jaccard.fewest_matches(0.8, 1e-2)[128] > limits[128]


def test_jaccard_edges(spark, edge_docs, no_docs):
    found = jaccard.near_duplicates(edge_docs.withColumn("set_key", F.lit(1)).withColumn("class_id", F.lit(2)))
    assert found.count() == edge_docs.count()
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[100]["class_id"] == 1 and by[100]["n_links"] == 3 and by[101]["class_id"] == 1
    assert by[103]["n_links"] == 0 and by[103]["class_id"] == 103
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_jaccard_stage_keeps_one_of_each(spark, edge_docs, folder):
    clash = edge_docs.withColumn("_hash", F.lit(1))
    kept = jaccard.stage(spark, clash, None)
    assert kept.columns == clash.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 100 not in ids and 101 not in ids and ids.count(103) == 1 and 107 in ids
    assert len(ids) == edge_docs.count() - 3


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(i, 100) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 160)) and found[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# decontamination

@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(9)
    items = [(i, sentence(rng, 20 + i % 60)) for i in range(30)]
    return items, spark.createDataFrame(items + [(90, None), (91, ""), (92, "too short"), (93, items[3][1])], "item_id long, text string")


def leaky(items, rng):
    """(documents, wanted pairs): verbatim, with words replaced and inserted, and clean."""
    docs, want = [], set()
    for i, (item, text) in enumerate(items):
        words = text.split()
        if i % 3 == 1:
            words = [w if rng.random() > 0.12 else "changed" for w in words]
        if i % 3 == 2:
            for _ in range(len(words) // 10):
                words.insert(rng.randrange(len(words)), "inserted")
        docs.append((i, f"{sentence(rng, 70)} {' '.join(words)} {sentence(rng, 90)}"))
        want |= {(i, item)} | ({(i, 93)} if item == 3 else set())
    docs += [(100 + i, sentence(rng, 300)) for i in range(20)]
    return docs, want


def test_decontamination_matches_planted(spark, benchmark):
    docs, want = leaky(benchmark[0], random.Random(4))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark[1])
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_decontamination_in_blocks(spark, benchmark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 12)
    docs, want = leaky(benchmark[0], random.Random(4))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark[1])
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_items_that_share_a_prompt_are_all_found(spark):
    rng = random.Random(21)
    prompt = sentence(rng, 48)
    items = [(i, f"{prompt} {sentence(rng, 35)}") for i in range(2)] + [(i, sentence(rng, 60)) for i in range(2, 12)]
    docs = [(i, " ".join((sentence(rng, 20 + i), items[0][1], sentence(rng, 200), items[1][1], sentence(rng, 10)))) for i in range(24)]
    # of the second item, the prompt alone stands before the whole
    docs += [(100 + i, " ".join((sentence(rng, 12 * i), prompt, sentence(rng, 205 + i), items[1][1]))) for i in range(12)]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {(i, k) for i in range(24) for k in (0, 1)} | {(100 + i, 1) for i in range(12)}
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_answers_decide_on_paraphrases(spark):
    rng = random.Random(2)
    words = sentence(rng, 40).split()
    half = [w if k % 5 < 3 else "zzz" for k, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(half) + " forty two"), (2, " ".join(half) + " nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words), "forty two")], "item_id long, text string, answer string")
    assert [r["doc_id"] for r in decontaminate.leaks(docs, items).collect()] == [1]


def test_lcs():
    def plain(a, b):
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        return t[-1, -1]
    rng = random.Random(0)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(90))] for _ in range(2))
        assert decontaminate.lcs(a, b) == plain(a, b)


def test_decontamination_edges(spark, edge_docs, no_docs, benchmark):
    assert decontaminate.leaks(edge_docs, benchmark[1]).count() == 0
    assert decontaminate.leaks(no_docs, benchmark[1]).count() == 0
    assert decontaminate.leaks(edge_docs, benchmark[1].limit(0)).count() == 0
    item = spark.createDataFrame([(None, edge_docs.filter("doc_id = 1").first()["text"])], "item_id long, text string")
    found = decontaminate.leaks(edge_docs, item).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 100, 100, 101] and {r["item_id"] for r in found} == {None}


def test_decontamination_stage(spark, folder, benchmark):
    docs, want = leaky(benchmark[0], random.Random(4))
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs] + [(None, None, None, None, None)], DOCUMENTS).withColumn("_hash", F.lit(1))
    kept = decontaminate.stage(spark, df, folder(benchmark=benchmark[1]))
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {None} | {i for i, _ in docs if i >= 100}


# neighbours

def brute(rows, query, k=5):
    a = np.array(query[1], float)
    scored = sorted((-float(np.dot(a, v) / np.sqrt(np.dot(a, a) * np.dot(v, v))), i) for i, v in rows if i != query[0])
    return [(i, round(-s, 9)) for s, i in scored[:k]]


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + 0.4 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.nearest_neighbours(df, df.filter("vec_id % 50 = 0"), probe=200, share=0.05).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], round(r["score"], 9))
    hits = total = 0
    exact = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    for q in found:
        want = brute(exact, exact[q])
        got = [found[q][k] for k in range(1, 6)]
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        hits += len(set(want) & set(got))
        total += 5
    assert len(found) == 60 and hits >= 0.9 * total


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 4)).tolist()
    same = [1.0, 0.0, 0.0, 0.0]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(i, same) for i in range(100, 140)] + [(50, [2.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + [
        (200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 0.0, 0.0]), (204, [float("inf"), 1.0, 0.0, 0.0]),
        (205, [1.0]), (None, same), (206, [])], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest_neighbours(df, df.filter("vec_id in (100, 0, 50, 139, 200, 205)")).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    exact = [(i, np.array(v)) for i, v in rows]
    assert found == {q: brute(exact, next(r for r in exact if r[0] == q)) for q in (100, 0, 50, 139)}
    assert found[100] == [(50, 1.0)] + [(i, 1.0) for i in range(101, 105)]


def test_neighbours_edges(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], schema)
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema)
    assert neighbours.nearest_neighbours(none, none).count() == 0
    assert sorted(tuple(r) for r in neighbours.nearest_neighbours(two, two).collect()) == [(1, 1, 2, 0.0), (2, 1, 1, 0.0)]
    assert neighbours.nearest_neighbours(two, none).count() == 0


def test_pairs_come_in_order_of_distance():
    rng = np.random.default_rng(3)
    a, b = rng.random(7), rng.random(7)
    sizes = {k: 1 for k in range(49)}
    got = neighbours.cells_for(a, b, sizes, 7, 49)
    sums = [a[c // 7] + b[c % 7] for c in got]
    assert sorted(got) == list(range(49)) and sums == sorted(sums)


def test_neighbours_of_repeated_ids_rows_and_vectors(spark):
    rng = np.random.default_rng(7)
    near = [1.0, 0.0, 0.1, 0.0]
    rows = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    rows += [(100, near)] * 8 + [(101, near), (102, near)]                                  # copies under one id and under others
    rows += [(16, near), (16, near), (16, [1.0, 0.0, 0.2, 0.0])]                            # an id with several vectors
    rows += [(200, [1.0, 0.001 * k, 0.1, 0.0]) for k in range(10)]                          # the query's own id all around it
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    wanted = {}
    for query in (16, 100, 200, 3):
        best = {}
        for q in {tuple(v) for i, v in rows if i == query}:
            for i, v in rows:
                if i != query:
                    best[i] = max(best.get(i, -2.0), float(np.dot(q, v) / np.sqrt(np.dot(q, q) * np.dot(v, v))))
        wanted[query] = [(i, round(s, 9)) for s, i in sorted((-s, i) for i, s in best.items())[:5] for s in (-s,)]
    found = {}
    for r in neighbours.nearest_neighbours(df, df.filter("vec_id in (16, 100, 200, 3)")).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert found == wanted
    assert [i for i, _ in found[100]][:2] == [16, 101]


@pytest.mark.parametrize("items, words", [(1, 6), (1, 16), (40, 30), (3, 400)])
def test_small_benchmarks_span_a_space(spark, items, words):
    """Fewer terms than the rank: the space has as many directions as there are terms."""
    rng = random.Random(items)
    known = [f"w{k}" for k in range(30 if items == 40 else words)]
    texts = [" ".join(rng.sample(known, min(words, len(known)))) for _ in range(items)]
    docs = [(k, f"before {t} after") for k, t in enumerate(texts)] + [(1000, sentence(rng, 80)), (1001, ""), (1002, None)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {(k, k) for k in range(items)} <= found and all(d < 1000 for d, _ in found)


def test_items_of_few_words_are_exact_sequences(spark):
    bench = spark.createDataFrame([(1, "Red, green blue!"), (2, "one two three four five"), (3, "too few"), (4, "red GREEN blue"), (5, None)], "item_id long, text string")
    docs = [(1, "a red green blue b"), (2, "red green; or blue"), (3, "zero one two three four five"), (4, "too few words"), (5, "red green blue red green blue"), (6, None)]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["at_word"]) for r in found) == [(1, 1, 1), (1, 4, 1), (3, 2, 1), (5, 1, 0), (5, 4, 0)]
