"""Chat formatting, mixing, fixity audit, the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from invented import DOCUMENTS, sentence
from pyspark.sql import functions as F

from tierwork.llm import chat, decontaminate, jaccard, language, mixing, toxicity, warc

TURNS = "conv_id long, turn long, role string, text string"


# chat

def conversation_rows():
    rng = random.Random(8)
    rows = []
    for c in range(12):
        turns = [("system", "be brief " * 5)] if c % 2 else []
        for k in range(c * 5):
            turns.append(("user" if k % 2 == 0 else "assistant", sentence(rng, rng.randint(1, 60))))
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said), (-8, 0, "tool[/ROLE]", "a\\<s>\\\\"), (-8, 1, "assistant", "\\"), (-8, 1, "assistant", "\\")]
    rows += [(None, 0, "user", "x"), (None, None, None, None), (-9, 0, "assistant", "long " * 9000), (-9, 1, "user", ""), (-9, 2, "assistant", None)]
    return rows


def expected(rows):
    out, by = {}, {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or "")):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(200, 60), (90, 0), (1024, 192)])
def test_windows_read_back(spark, budget, history):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("window", F.lit(1)).withColumn("tokens", F.lit("x"))
    windows = chat.format_windows(df, budget, history).persist()
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(windows).collect()}
    assert found == expected(rows)
    for w in windows.collect():
        assert w["tokens"] <= budget or w["new_turns"] == 1
        turns = list(chat.read_turns(w["text"]))
        assert sum(begin >= w["fresh_from"] for _, _, begin, _ in turns) == w["new_turns"]
        repeated = [t for t in turns if t[2] < w["fresh_from"]]
        if w["window"] and w["conv_id"] is not None and w["conv_id"] > 0 and w["conv_id"] % 2:
            assert repeated and repeated[0][0] == "system"
        assert all(s["start"] >= w["fresh_from"] for s in w["loss"])


def test_history_is_repeated_but_not_learnt(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k} " * 6) for k in range(12)]
    windows = chat.format_windows(spark.createDataFrame(rows, TURNS), 120, 50).orderBy("window").collect()
    assert len(windows) > 1
    for w in windows[1:]:
        assert any(begin < w["fresh_from"] for _, _, begin, _ in chat.read_turns(w["text"]))


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice([*chat.CONTROL, "\\", "<", "[", "a", "\n"]) for _ in range(rng.randint(0, 12)))
        formatted = "<s>" + "".join(chat.turn_parts("x" + text, text))
        assert chat.unescape(chat.escape(text)) == text
        assert [t[:2] for t in chat.read_turns(formatted)] == [("x" + text, text)]


def test_chat_long_system_turn_is_not_repeated(spark):
    """With a budget of 100, system turns of 1004, 54 and 50 tokens."""
    rows = [(c, k, "system" if k == 0 else "user", ("s" if k == 0 else "u") * (size if k == 0 else 40))
            for c, size in ((1, 4000), (2, 200), (3, 184)) for k in range(30)]
    df = spark.createDataFrame(rows, TURNS)
    windows = chat.format_windows(df, 100, 20)
    found = {c: [] for c in (1, 2, 3)}
    for w in windows.orderBy("conv_id", "window").collect():
        found[w["conv_id"]].append(("[ROLE]" in w["text"], w["tokens"], w["new_turns"]))
    assert found[1][0] == (True, 1004, 1)
    for c in (1, 2):
        assert not any(system or tokens > 100 for system, tokens, _ in found[c][1:]) and len(found[c]) < 8
    assert all(system and tokens <= 100 for system, tokens, _ in found[3])
    assert all(sum(n for _, _, n in w) == 30 for w in found.values())
    assert {r["conv_id"]: r["n_turns"] for r in chat.digests(windows).collect()} == {1: 30, 2: 30, 3: 30}


def test_chat_edges(spark):
    assert chat.digests(chat.format_windows(spark.createDataFrame([], TURNS))).count() == 0
    with pytest.raises(ValueError):
        chat.format_windows(spark.createDataFrame([], TURNS), 10, 10)
    path = chat.vocabulary_path()
    if path:
        assert chat.counter(chat.vocabulary_bytes(path))(["", "hello there"]) == [0, 2]


# mixing

def mixable(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.randint(20, 60), "de" if i % 2 else "en"), "x", "b" if i % 2 else "a", 1) for i in range(200) if i % 2 or i % 6 == 0]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_mixing_meets_targets(spark):
    docs = mixable(spark)
    posteriors, classifier, rates, prefix = mixing.mix(docs, {"a": 3.0, "b": 1.0})
    assert classifier.domains == ["a", "b"] and rates.history
    rated = posteriors.withColumn("rate", rates.of(prefix, 2))
    row = rated.agg(*[F.sum(F.col(f"{prefix}t") * F.col("rate") * F.col(f"{prefix}{k}")) for k in (0, 1)], F.min("rate")).first()
    assert row[0] / (row[0] + row[1]) == pytest.approx(0.75, abs=2e-3) and row[2] >= 0
    # against the normal equations of the same least squares problem, done by hand
    table = [tuple(r) for r in rated.select(f"{prefix}t", f"{prefix}0", f"{prefix}1", "rate").collect()]
    total = sum(t for t, *_ in table)
    assert row[0] == pytest.approx(0.75 * total, rel=2e-3) and row[1] == pytest.approx(0.25 * total, rel=2e-3)
    assert all(abs(p + q - 1) < 1e-9 for _, p, q, _ in table)


def test_small_sources_meet_their_targets(spark):
    shares = [0.333] + [0.666 / 18] * 18 + [0.001]      # posteriors of a classifier that knows the shares alone
    n, rows = len(shares), []
    for d, share in enumerate(shares):
        evidence = [c * (0.9 if k == d else 0.1 / (n - 1)) for k, c in enumerate(shares)]
        rows.append((share * 1e6, *[e / sum(evidence) for e in evidence]))
    table = spark.createDataFrame(rows, ", ".join(["mt double", *[f"m{k} double" for k in range(n)]])).coalesce(1)
    rates = mixing.descend(table, [c ** 0.5 for c in shares], "m")
    assert max(abs(e - t) / t for e, t in zip(rates.expected, rates.targets)) < 2e-3
    rated = table.withColumn("rate", rates.of("m", n))
    small = rated.agg(F.sum(F.col("mt") * F.col("rate") * F.col(f"m{n - 1}")), F.min("rate")).first()
    assert small[0] == pytest.approx(rates.targets[-1], rel=2e-3) and small[1] >= 0


def test_unreachable_targets_end_at_the_least_squares(spark):
    table = spark.createDataFrame([(100.0, 0.8, 0.2), (100.0, 0.6, 0.4)], "mt double, m0 double, m1 double").coalesce(1)
    rates = mixing.descend(table, [0.1, 0.9], "m")
    # only the second document has a rate then, on the line of (60, 40): least (60r - 20)^2 / 20 + (40r - 180)^2 / 180
    best = (60 * 20 / 20 + 40 * 180 / 180) / (60 ** 2 / 20 + 40 ** 2 / 180)
    found = [r["rate"] for r in table.withColumn("rate", rates.of("m", 2)).orderBy("m0").collect()]
    assert found == pytest.approx([best, 0.0], abs=2e-3)


def test_rates_agree_with_least_squares_by_hand(spark):
    """Against the rates nearest to 1 among those that meet all targets; where rates
    are held at 0, against the targets."""
    import numpy as np
    rng = np.random.default_rng(4)
    n, rows = 5, 60
    p = rng.dirichlet([0.4] * n, rows)
    t = rng.integers(1, 400, rows).astype(float)
    table = spark.createDataFrame([(x, *y) for x, y in zip(t.tolist(), p.tolist())], ", ".join(["mt double", *[f"m{k} double" for k in range(n)]])).coalesce(1)

    def found(weights):
        rates = mixing.descend(table, weights, "m")
        got = {r["m0"]: r["rate"] for r in table.withColumn("rate", rates.of("m", n)).collect()}
        return rates, np.array([got[x] for x in p[:, 0].tolist()])

    mass = t @ p
    near = (mass * [1.1, 0.9, 1.05, 0.95, 1.0]).tolist()
    rates, got = found(near)
    goal = t.sum() * np.array(near) / sum(near)
    assert got == pytest.approx(1 + p @ np.linalg.solve((p * t[:, None]).T @ p, goal - mass), abs=1e-3) and rates.residual <= 1e-4

    far = [1.0, 2.0, 3.0, 4.0, 5.0]
    rates, got = found(far)
    goal = t.sum() * np.array(far) / sum(far)
    assert got.min() >= 0 and (got == 0).any() and (t * got) @ p == pytest.approx(goal, rel=1e-3)
    assert len(rates.steps) > mixing.CHAIN      # rates that were stored on the way are those of the whole chain
    assert (t * got) @ p == pytest.approx(np.array(rates.expected), rel=1e-6)


def test_rare_domains_are_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SAMPLE", 60)
    rows = [(i, f"word{i % 7} of {i % 11}", "x", "big", 1) for i in range(2000)] + [(5000, "quite other words here", "x", "zz", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    posteriors, classifier, _, prefix = mixing.mix(docs, {"big": 1.0, "absent": 1.0, "zz": 1.0})
    assert classifier.domains == ["absent", "big", "zz"] and classifier.unseen == (0,)
    rare = posteriors.filter("doc_id = 5000").first()
    assert rare[f"{prefix}2"] > 0.05 and rare[f"{prefix}0"] > 0


def test_sample_is_fitted_on_few_partitions(spark, monkeypatch):
    seen = []

    class Watched(mixing.LogisticRegression):
        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return super().fit(df)

    monkeypatch.setattr(mixing, "LogisticRegression", Watched)
    docs = mixable(spark)
    assert mixing.fit(docs.repartition(40), ["a", "b"]).model is not None
    assert seen[0][0] <= 4 and seen[0][1] == docs.filter("source in ('a', 'b')").count()


def test_unnamed_sources_rest_on_the_classifier(spark):
    docs = mixable(spark)
    posteriors, _, _, prefix = mixing.mix(docs.withColumn("source", F.when(F.col("doc_id") % 5 != 0, F.col("source"))), {"a": 1.0, "b": 1.0})
    unnamed = posteriors.filter("source is null").collect()
    right = sum((r[f"{prefix}1"] > 0.5) == bool(r["doc_id"] % 2) for r in unnamed)
    assert right >= 0.9 * len(unnamed) and len(unnamed) > 10


def test_mixing_edges(spark, edge_docs, no_docs):
    for targets in ({}, {"src0": 1.0}, {"src0": 1.0, "nowhere": 0.0}, {"src0": 0.0}):
        posteriors, classifier, rates, prefix = mixing.mix(edge_docs, targets)
        found = posteriors.withColumn("rate", rates.of(prefix, len(classifier.domains))).collect()
        assert len(found) == edge_docs.count() and all(r["rate"] >= 0 for r in found)
    posteriors, classifier, rates, prefix = mixing.mix(no_docs, {"a": 1.0, "b": 2.0})
    assert posteriors.count() == 0 and rates.history == []
    with pytest.raises(ValueError):
        mixing.mix(edge_docs, {"a": -1.0})
    with pytest.raises(ValueError):
        mixing.mix(edge_docs, {str(k): 1.0 for k in range(mixing.MAX_DOMAINS + 1)})


def test_mixing_stage(spark, edge_docs):
    clash = edge_docs.withColumn("rate", F.lit("x")).withColumn("_mix", F.lit(1)).withColumn("words", F.lit(2))
    found = mixing.stage(spark, clash, None)
    assert found.columns == [c for c in clash.columns if c != "rate"] + ["rate", "copies"]
    rows = found.collect()
    assert rows and all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) and r["copies"] > 0 for r in rows)


def test_mixing_has_no_python_in_its_plan(spark, edge_docs):
    posteriors, _, _, _ = mixing.mix(edge_docs, {"src0": 1.0, "src1": 1.0})
    plan = mixing.stage(spark, edge_docs, None)._jdf.queryExecution().toString() + posteriors._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# fixity

PAGES = "page_id long, url string, html string"


def test_audit_names_every_difference(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 1 << 11)
    rng = random.Random(7)
    pages = [(i, f"http://a/{i}", sentence(rng, rng.randint(1, 300))) for i in range(1500)]
    pages += [(3, None, "x"), (3, "", "x"), (3, "", "x"), (None, None, None), (None, "u", ""), (9, "big", "y" * 100_000)]
    records = warc.pack(spark.createDataFrame(pages, PAGES), per_archive=100).persist()
    rows = records.collect()
    assert len(rows) == len(pages)
    for archive in {r["archive"] for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r["archive"] == archive), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
    spot = {(r["archive"], r["offset"]): r for r in rows}
    changed, lost = rng.sample(sorted(spot), 12), set()
    lost, changed = set(changed[:4]), set(changed[4:])
    replica = [(r["archive"], r["offset"], r["length"], "bad" if k in changed else r["digest"], r["key"]) for k, r in spot.items() if k not in lost]
    gap = max(r["offset"] + r["length"] for r in rows if r["archive"] == rows[0]["archive"])
    replica.append((rows[0]["archive"], gap, 10, "new", None))
    other = spark.createDataFrame(replica, records.schema)
    trees = [warc.build(df, 1 << 11) for df in (records, other)]
    found = {(r["archive"], r["offset"]): r["status"] for r in warc.audit(*trees).collect()}
    assert found == {**{k: "changed" for k in changed}, **{k: "missing" for k in lost}, (rows[0]["archive"], gap): "extra"}
    assert warc.audit(trees[0], warc.build(records, 1 << 11)).count() == 0


def test_audit_edges(spark):
    empty = warc.pack(spark.createDataFrame([], PAGES))
    one = warc.pack(spark.createDataFrame([(1, "u", "h")], PAGES))
    trees = {n: warc.build(df) for n, df in (("empty", empty), ("one", one))}
    assert warc.audit(trees["empty"], trees["empty"]).count() == 0
    assert [r["status"] for r in warc.audit(trees["one"], trees["empty"]).collect()] == ["missing"]
    assert [r["status"] for r in warc.audit(trees["empty"], trees["one"]).collect()] == ["extra"]
    moved = one.withColumn("offset", F.col("offset") + 5)
    assert {r["status"] for r in warc.audit(trees["one"], warc.build(moved)).collect()} == {"moved", "extra"}


def test_hot_page_id_is_spread(spark):
    pages = spark.range(6000).select(F.lit(1).cast("long").alias("page_id"), F.col("id").cast("string").alias("url"), F.lit("x").alias("html"))
    sizes = [r["count"] for r in warc.pack(pages, per_archive=100).groupBy("archive").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 1200


# pipeline

def test_pipeline_runs_stage_by_stage(spark, edge_rows, folder):
    import corpus_pipeline

    rng = random.Random(11)
    item = sentence(rng, 40)
    rows = [r for r in edge_rows if r[0] is None or r[0] < 107]
    rows += [(300 + i, sentence(rng, 50) + (" dreadful vermin rubbish" * 3 if i % 3 == 0 else ""), "en", "src1", 1) for i in range(120)]
    rows += [(500, sentence(rng, 30) + " " + item + " " + sentence(rng, 20), "en", "src2", 1), (501, "Ω " * 40 + "ψ", "xx", "src0", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    labels = spark.createDataFrame([(300 + i, int(i % 3 == 0), 1) for i in range(120)], "doc_id long, toxic int, quality int")
    path = folder(documents=docs, labels=labels, benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = corpus_pipeline.run(spark, path).collect()
    # the same decisions, one stage at a time, from the models by hand
    bad_words = toxicity.learn_from(docs, labels)
    scores = {t: bad_words.score(bad_words.features(t)[None])[0] for t in {r[1] for r in rows}}
    kept = [r for r in rows if scores[r[1]] < toxicity.THRESHOLD]
    tongue = language.learn_from(docs)
    kept = [r for r in kept if not tongue.predict(r[1])[2]]
    seen, classes = jaccard.WordHashes(), {}
    for r in sorted(kept, key=lambda r: (r[0] is not None, r[0])):
        grams = set(jaccard.shingles(r[1], seen).tolist())
        if not any(len(grams & g) >= 0.8 * len(grams | g) for _, g in classes.values()):
            classes[len(classes)] = (r, grams)
    kept = [r for r, _ in classes.values() if item not in (r[1] or "")]
    mixed = {r["doc_id"] for r in out}
    assert mixed <= {r[0] for r in kept} and all(r["copies"] > 0 for r in out)
    assert not mixed & {500, 103, 100, 101, 102} and not mixed & {300 + i for i in range(0, 120, 3)}
    assert len(out) >= 0.6 * len(kept)
    assert decontaminate.lcs([1, 2], [2]) == 1


def test_words_found_in_windows_match_a_count_by_window(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(7)
    for cells in (1, 500, decontaminate.CELLS):
        monkeypatch.setattr(decontaminate, "CELLS", cells)
        for _ in range(100):
            at, words = rng.integers(0, 30, rng.integers(6, 300)).astype(np.int32), rng.integers(1, 40, rng.integers(6, 20))
            starts, place = np.arange(0, max(1, len(at) - 36), 12), np.zeros(60, np.int32)
            lows, highs = np.maximum(starts - 20, 0), np.minimum(starts + 68, len(at))
            got = decontaminate._covered(at, lows, highs, *np.unique(words, return_counts=True), place)
            assert got.tolist() == [np.isin(words, at[a:b]).sum() for a, b in zip(lows, highs)] and not place.any()


def test_words_of_latin_and_other_texts():
    texts = ["", None, "Plain words, x_1!", "ÀÉ×ß÷ µ²¼ªº\xa0naïve\x85end\x1cx", "Ünder “quoted” – İstanbul ΑΣ'Β ΟΔΟΣ", *(f"a{chr(c)}B" for c in range(700))]
    for text in texts:
        assert decontaminate.words_of(text) == (re.findall(r"\w+", text.lower()) if text else [])


def test_possible_items_keep_all_that_verify_and_no_scattered_words():
    rng = random.Random(8)
    items = [[rng.randint(1, 12) if rng.random() < 0.4 else rng.randint(13, 90) for _ in range(n)] for n in (6, 7, 15, 18, 40, 59, 120)]
    lengths, places, scratch = np.array([len(x) for x in items]), decontaminate._places([np.array(x) for x in items]), np.zeros(91, np.int32)
    kept = verified = 0
    for _ in range(300):
        words = [rng.randint(0, 14) if rng.random() < 0.5 else 0 for _ in range(rng.choice([4, 30, 200, 900]))]
        for item in rng.sample(items, 2):       # parts of items, with words put in between
            part = [x for w in item if rng.random() < 0.8 for x in (w, *([0] if rng.random() < 0.3 else []))]
            where = rng.randint(0, len(words))
            words[where:where] = part
        at = np.array(words, np.int32)
        able = set(decontaminate._possible(at, 91, places, lengths).tolist())
        kept += len(able)
        windows = dict.fromkeys(range(0, max(1, len(at) - decontaminate.PASSAGE + 12), 12), 1.0)
        for k, item in enumerate(items):
            found = decontaminate._verified(at, windows, np.array(item), item[-6:], *np.unique(item, return_counts=True), scratch)
            verified += found is not None
            assert found is None or k in able
    assert verified > 200 and kept < 300 * len(items)
    scattered = np.zeros(60 * 40, np.int32)
    scattered[::60] = items[4]
    assert 4 not in decontaminate._possible(scattered, 91, places, lengths)
    assert 4 in decontaminate._possible(np.array(items[4], np.int32), 91, places, lengths)
