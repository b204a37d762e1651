"""Toxicity, language, language model, licences."""

import math
import random
import textwrap
import zlib
from collections import Counter

import pytest
from invented import DOCUMENTS, sentence
from pyspark.sql import functions as F

from tierwork.llm import language, language_model, licenses, toxicity


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# toxicity

@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        words = sentence(rng, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["dreadful", "vermin", "rubbish"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def toxic_model(marked):
    return toxicity.learn_from(*marked)


def test_toxicity_on_held_out_rows(marked, toxic_model):
    docs, labels = marked
    found = toxicity.score(docs, toxic_model).join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).collect()
    right = sum(r["predicted"] == r["toxic"] for r in found)
    assert len(found) > 50 and right >= 0.95 * len(found)


def test_toxicity_dictionaries_are_used(toxic_model):
    for word, sign in (("vermin", 1), ("ther", 0)):
        wide = toxicity.widen(f" {word} ").tobytes()
        toxic, ordinary = toxic_model.lengths(wide)
        assert (ordinary - toxic > 5) == bool(sign)


def test_toxicity_edges(edge_docs, no_docs, toxic_model):
    clash = edge_docs.withColumn("score", F.lit("x")).withColumn("predicted", F.lit("y"))
    found = toxicity.score(clash, toxic_model)
    assert found.count() == edge_docs.count() and dict(found.dtypes)["score"] == "double"
    assert all(0 <= r["score"] <= 1 for r in found.select("score").collect())
    empty = {r["score"] for r in found.filter("text is null or trim(text) = ''").collect()}
    assert len(empty) == 1
    assert toxicity.score(no_docs, toxic_model).count() == 0


def test_toxicity_stage_leaves_columns_alone(spark, marked, folder):
    docs, labels = marked
    mine = docs.withColumns({"score": F.lit("mine"), "predicted": F.col("doc_id"), "_toxicity": F.lit(1)})
    kept = toxicity.stage(spark, mine, folder(documents=docs, labels=labels))
    found = kept.collect()
    assert kept.columns == mine.columns and {r["score"] for r in found} == {"mine"}
    ids = {r["doc_id"] for r in found}
    assert sum(i % 4 == 0 for i in ids) <= 5 and len(ids) >= 285


def test_toxicity_without_labels(spark, edge_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(edge_docs, toxicity.learn_from(edge_docs, none)).collect()} == {0.0}
    ones = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(edge_docs, toxicity.learn_from(edge_docs, ones)).collect()} <= {0.0, 1.0}


def test_long_text_is_read_whole(toxic_model):
    plain = "ther and " * 60_000
    assert toxic_model.features(plain + "vermin dreadful rubbish")[0] > toxic_model.features(plain)[0] + 5


# language

def test_language_on_held_out_rows(edge_docs):
    model = language.learn_from(edge_docs)
    found = language.identify(edge_docs.filter("lang is not null and length(text) > 100 and doc_id < 100"), model)
    assert all(r["lang"] == r["lang_pred"] for r in found.collect())


def test_language_edges(edge_docs, no_docs):
    model = language.learn_from(edge_docs)
    found = language.identify(edge_docs.withColumn("score", F.lit(1)).withColumn("rejected", F.lit(1)), model)
    assert found.count() == edge_docs.count()
    no_letters = found.filter("text is null or not text rlike '[a-zA-Z]'").collect()
    assert no_letters and {(r["lang_pred"], r["score"], r["rejected"]) for r in no_letters} == {("und", 0.0, True)}
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert language.identify(no_docs, model).count() == 0
    assert {r["lang_pred"] for r in language.identify(edge_docs, language.learn_from(no_docs)).collect()} == {"und"}


def test_language_rejects_what_is_far(edge_docs):
    model = language.learn_from(edge_docs)
    at, score, rejected = model.predict("Ωψξ Ωψξ Ωψξ ΔΘΛ ΔΘΛ")
    assert rejected and score < 0.2


def test_language_slices_count_like_one(monkeypatch):
    text = "Straße und éau the " * 400
    whole = language.grams(text)
    monkeypatch.setattr(language, "SLICE", 97)
    cut = language.grams(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


# language model

def test_language_model_matches_exact_counts(spark, edge_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 15)     # most tokens take the join
    train = edge_docs.filter(F.coalesce(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10, F.lit(1)) != 0)
    model, counts = language_model.train(train)
    found = language_model.score(edge_docs, model, counts).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda t: language_model._TOKEN.findall((t or "").translate(lower)) + [None]
    c = Counter()
    for r in edge_rows:
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10:
            c.update(tokens(r[1]))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(r[0]), len(tokens(r[1])), sum(c[t] > 0 for t in tokens(r[1])), n,
                   round(sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r[1])), 4)) for r in edge_rows)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found) == want
    assert all(r["score"] <= 1e-9 for r in found)


def test_filter_holds_every_level(spark):
    docs = spark.createDataFrame([("a b " * 50 + "c d",)], "text string")
    model, _ = language_model.train(docs)
    seen = language_model._Hashes()
    tokens = language_model.tokens_of("a b", seen)
    two = language_model.bigrams(tokens)
    assert model.levels(two[1:2])[0] >= language_model.level_of(language_model.np.array([50]))[0]
    assert model.levels(language_model.mixed(tokens[:1] * language_model._M3))[0] >= language_model.level_of(language_model.np.array([50]))[0]


def test_bounded_filter_cuts_rare_bigrams(spark, edge_docs):
    model, _ = language_model.train(edge_docs, filter_mb=0.01)
    assert model.blocks <= 2 and model.cutoffs["bigrams"] > 1


def test_no_ngram_is_dropped_beyond_the_broadcast_bound(spark, edge_docs, monkeypatch):
    def scores(model, counts):
        found = language_model.score(edge_docs, model, counts).collect()
        return sorted(((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in found))

    monkeypatch.setattr(language_model, "FILL", 1e-4)       # asks for more than FILTER_MB
    monkeypatch.setattr(language_model, "FREQUENT", 15)
    monkeypatch.setattr(language_model, "STREAM", 500)      # several streams a task
    model, counts = language_model.train(edge_docs)
    assert model.cutoffs == {"unigrams": 1, "bigrams": 1} and model.bits is None
    apart = scores(model, counts)
    monkeypatch.setattr(language_model, "FILTER_MB", 1000)
    model, counts = language_model.train(edge_docs)
    assert model.stored is None and len(apart) == edge_docs.count()
    assert apart == scores(model, counts)


def test_stored_ranges_answer_counts_without_a_join(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 15)
    small, counts = language_model.train(edge_docs)
    want = sorted((repr(r["doc_id"]), r["n_known"], round(r["base_score"], 4)) for r in language_model.score(edge_docs, small, counts).collect())
    monkeypatch.setattr(language_model, "FILL", 1e-4)
    model, counts = language_model.train(edge_docs)
    scored = language_model.score(edge_docs, model, counts)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted((repr(r["doc_id"]), r["n_known"], round(r["base_score"], 4)) for r in scored.collect()) == want


def test_sorted_hashes_take_the_bytes_of_their_gaps():
    np = language_model.np
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 44, 100_000).astype(np.uint64))
    data = language_model._packed(keys)
    assert (language_model._unpacked(data) == keys).all() and len(data) < 4.2 * len(keys)


def test_language_model_without_rows(edge_docs, no_docs):
    model, counts = language_model.train(no_docs)
    found = language_model.score(edge_docs, model, counts).collect()
    assert {(r["train_tokens"], r["base_score"], r["score"], r["n_known"]) for r in found} == {(0, 0.0, 0.0, 0)}
    assert language_model.score(no_docs, model, counts).count() == 0


# licences

def test_license_rules(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    docs = spark.createDataFrame([
        (1, f"{apache}.\nx.\nYou may not use this file except in compliance with the License.\nAll rights reserved.", "a"),
        (2, f"{apache}. Foo. {apache}.", "b"), (3, None, None), (4, "", "d"), (5, "You may not use this file except in compliance with the License.", "e"),
        (6, "y.\n" * 5000 + "RELEASED  UNDER the MIT license!", "f"),
        (7, "MIT License\na\nb\nc\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction.\nThe above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software.", "g"),
    ], "doc_id long, text string, licenses string")
    found = {r["doc_id"]: (r["sentence_ids"], r["licenses"], r["matches"]) for r in licenses.scan(docs).collect()}
    assert found[1] == (["apache2.notice", "apache2.comply", "rights"], ["Apache-2.0", "Proprietary"], 2)
    assert found[2] == (["apache2.notice"] * 2, ["Apache-2.0"], 2)
    assert found[3] == found[4] == ([], [], 0)
    assert found[5] == (["apache2.comply"], [], 0)
    assert found[6] == (["mit.notice"], ["MIT"], 1)
    assert found[7] == (["mit.name", "mit.grant", "mit.condition"], ["MIT"], 1)     # the longer rule lies too far apart


MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the rest.
"""
GPL = """This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{stop} either version {n} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
"""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy was not distributed, get one."


def test_unmodified_licenses(spark):
    texts = {
        "MIT": MIT, "BSD-2-Clause": BSD2 + AS_IS, "BSD-3-Clause": BSD3 + AS_IS, "Apache-2.0": APACHE, "MPL-2.0": MPL,
        "GPL-3.0-or-later": GPL.format(mark=":", stop=",", n=3), "GPL-2.0-or-later": GPL.format(mark=";", stop=";", n=2)}

    def wrapped(text, width, sign):
        return "\n".join(line for part in text.split("\n") for line in textwrap.wrap(part, width, initial_indent=sign, subsequent_indent=sign) or [sign])

    rows = [(name, f"{before}{t}") for name, text in texts.items() for before in ("", "prose\n\n")
            for t in (text, wrapped(text, 72, ""), wrapped(text, 60, " * "), wrapped(text, 78, "# ").replace("\n", "\r\n"))]
    found = licenses.scan(spark.createDataFrame(rows, "name string, text string")).collect()
    assert [(r["name"], r["licenses"], r["matches"]) for r in found] == [(name, [name], 1) for name, _ in rows]
    telling = ["mit.grant", "mit.condition"]
    assert all(r["sentence_ids"][-2:] == telling for r in found if r["name"] == "MIT")
    assert licenses.scan(spark.createDataFrame([("not " + MPL,), (MPL.replace("2.0.", "2.0 or"),)], "text string")).filter("matches > 0").count() == 0


def test_license_edges(edge_docs, no_docs):
    assert licenses.scan(edge_docs.withColumn("matches", F.lit("x"))).filter("matches > 0").count() == 0
    assert licenses.scan(no_docs).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(edge_docs, rules=[("X", ("no.such",))])


def test_toxicity_stage_keeps_documents_when_nothing_was_learnt(spark, folder):
    rng = random.Random(6)
    docs = spark.createDataFrame([(k, sentence(rng, 30), "en", "s", 1) for k in range(60)], DOCUMENTS)
    labels = spark.createDataFrame([(k, 1, 1) for k in range(2)], "doc_id long, quality int, toxic int")
    assert toxicity.stage(spark, docs, folder(documents=docs, labels=labels)).count() == 60


def test_language_keeps_a_column_of_the_helper_name(spark, edge_docs):
    model = language.learn_from(edge_docs)
    plain = language.identify(edge_docs, model)
    clash = language.identify(edge_docs.withColumn("_language", F.lit("mine")), model)
    assert clash.columns == [*edge_docs.columns, "_language", "lang_pred", "score", "rejected"]
    rows = lambda df: sorted((tuple(r) for r in df.drop("_language", "text").collect()), key=str)      # noqa: E731
    assert rows(clash) == rows(plain) and {r["_language"] for r in clash.select("_language").collect()} == {"mine"}
