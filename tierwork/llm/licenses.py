"""License scans by sentence rules.

A text is cut into sentences (at line ends and after . ! ? ; followed by a gap),
each is normalised (lower case, everything but letters and digits as one space,
trimmed) and mapped to the identifier of a known licence sentence. Before the cut,
known sentences that begin and end where a sentence may are found by their words,
whatever stands between these, and set on a line of their own: so wrapped lines,
comment signs and breaks within a sentence (``v. 2.0``, ``WARRANTY; without``) do
not hide one. WORDINGS has the full wording of licences where SENTENCES has less,
with the numbered clauses of BSD. The identifiers
of a text, in order, form its sequence. Ordered licence rules, each a sequence of
identifiers, are matched against it: a rule matches where its identifiers follow
each other with at most ``gap`` unknown sentences in between. Rules are tried in
order; sentences that a rule has used are not used by a later one, so a specific
rule comes before what it contains.

The known sentences and rules are small fixed tables, part of the expression; no
Python runs and no row leaves its task.

Defined cases: NULL and empty texts and texts without a known sentence have no
licences and an empty list. A sentence that repeats gives its licence once per
match in ``matches``, once in ``licenses``. Other columns are ignored by the query;
``scan`` keeps them and replaces those named like its results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, query, table

# Normalised sentences of well-known licence notices, by identifier.
SENTENCES = {
    "apache2.notice": "licensed under the apache license version 2 0",
    "apache2.comply": "you may not use this file except in compliance with the license",
    "apache2.copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit.notice": "released under the mit license",
    "mit.name": "mit license",
    "mit.licensed": "licensed under the mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit.condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl3.notice": "this work is licensed under the gnu general public license version 3",
    "gpl3.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl.hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl.more": "see the gnu general public license for more details",
    "gpl2.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "bsd.redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd.asis": "this software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed",
    "ccbync4.notice": "licensed under cc by nc 4 0",
    "ccby4.notice": "licensed under cc by 4 0",
    "ccbysa4.notice": "licensed under cc by sa 4 0",
    "cc0.notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "mpl2.notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "rights": "all rights reserved",
}

# Ordered rules, each a licence and the identifiers that follow each other.
RULES = [
    ("Apache-2.0", ("apache2.notice", "apache2.comply", "apache2.copy", "asis")),
    ("Apache-2.0", ("apache2.notice", "apache2.comply")),
    ("Apache-2.0", ("apache2.notice",)),
    ("MIT", ("mit.name", "mit.grant", "mit.condition")),
    ("MIT", ("mit.grant", "mit.condition")),
    ("MIT", ("mit.notice",)),
    ("MIT", ("mit.licensed",)),
    ("GPL-3.0-or-later", ("gpl3.free", "gpl.hope", "gpl.more")),
    ("GPL-3.0-or-later", ("gpl3.free", "gpl.hope")),
    ("GPL-2.0-or-later", ("gpl2.free", "gpl.hope", "gpl.more")),
    ("GPL-2.0-or-later", ("gpl2.free", "gpl.hope")),
    ("GPL-3.0-only", ("gpl3.notice",)),
    ("BSD-3-Clause", ("bsd.redistribute", "bsd.endorse", "bsd.asis")),
    ("BSD-2-Clause", ("bsd.redistribute", "bsd.asis")),
    ("CC-BY-NC-4.0", ("ccbync4.notice",)),
    ("CC-BY-SA-4.0", ("ccbysa4.notice",)),
    ("CC-BY-4.0", ("ccby4.notice",)),
    ("CC0-1.0", ("cc0.notice",)),
    ("MPL-2.0", ("mpl2.notice",)),
    ("Proprietary", ("rights",)),
]
# Further wordings of known sentences, normalised; words in brackets
# may be missing.
WORDINGS = {
    "apache2.notice": ("licensed under the apache license version 2 0 the license",),
    "apache2.copy": ("you may obtain a copy of the license at https www apache org licenses license 2 0",),
    "mit.grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
        "and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "bsd.redistribute": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "[1] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "[2] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution",),
    "bsd.endorse": (
        "[3] neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "bsd.asis": (
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
}
HINT = r"(?i)licen[sc]e|copyright|redistribut|permission|warrant|reserved"      # every known sentence has one of these
GAP = 2
BREAK = r"[\r\n]+|(?<=[.!?;])[ \t]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def wording(sentence: str) -> str:
    """A pattern of the words of a sentence, whatever stands between them, from where
    a sentence may begin to where it may end."""
    out = ""
    for w in sentence.split():
        if w.startswith("["):
            out += f"(?:{w[1:-1]}[^a-zA-Z0-9]+)?"
        else:
            out += w + "[^a-zA-Z0-9]+"
    begin = r"(?i)(?:^|(?<=[\r\n])|(?<=[.!?;][ \t]{1,9}))[^a-zA-Z0-9\r\n]*"
    end = r"(?:[^a-zA-Z0-9\r\n]*(?=[\r\n]|$)|[^a-zA-Z0-9\s]*[.!?;:][^a-zA-Z0-9\s]*[ \t]+)"
    return begin + out.removesuffix("[^a-zA-Z0-9]+") + end


def unwrapped(text: Column, sentences: dict[str, str]) -> Column:
    """The text with each known sentence, in its normal form, on a line of its own."""
    forms = [(s, s) for s in sentences.values()] + [(w, sentences[i]) for i, ws in WORDINGS.items() if sentences.get(i) == SENTENCES[i] for w in ws]
    out = text
    for form, sentence in sorted(forms, key=lambda f: -len(f[0])):      # long ones may begin like short ones
        out = F.regexp_replace(out, F.lit(wording(form)), F.lit(f"\n{sentence}\n"))
    return out if sentences is not SENTENCES else F.when(text.rlike(HINT), out).otherwise(text)


def sequence(text: Column, sentences: dict[str, str]) -> Column:
    """The identifiers of a text in order, as one string ``|id|id|``; an unknown
    sentence stands as ``|-|``."""
    longest = max(map(len, sentences.values()), default=0)
    known = F.create_map(*[F.lit(x) for identifier, s in sentences.items() for x in (s, identifier)])
    parts = F.split(unwrapped(F.coalesce(text.cast("string"), F.lit("")), sentences), BREAK)
    # a sentence far longer than any known one needs no normalising
    found = F.transform(parts, lambda s: F.when(F.length(s) > 4 * longest + 80, "-").otherwise(
        F.coalesce(F.try_element_at(known, normalised(s)), F.lit("-"))))
    return F.concat(F.lit("|"), F.array_join(found, "||"), F.lit("|"))


def pattern(identifiers: tuple[str, ...], gap: int) -> str:
    unknown = rf"(?:\|-\|){{0,{gap}}}" if gap else ""
    return unknown.join(rf"\|{i.replace('.', '[.]')}\|" for i in identifiers)


def scan(
    docs: DataFrame, text: str = "text", sentences: dict[str, str] | None = None,
    rules: list[tuple[str, tuple[str, ...]]] | None = None, gap: int = GAP,
) -> DataFrame:
    """``docs`` with sentence_ids (in order), licenses (distinct, in rule order) and
    matches (rules matched, counting repeats)."""
    sentences, rules = SENTENCES if sentences is None else sentences, RULES if rules is None else rules
    missing = {i for _, ids in rules for i in ids} - set(sentences)
    if missing or not all(ids for _, ids in rules):
        raise ValueError(f"rules must name known sentences: {sorted(missing)}")
    seq, found = fresh(docs, "sequence"), fresh(docs, "found")
    # longer runs of unknown sentences can't lie within a match
    run = "|-|" * (gap + 1)
    df = docs.withColumn(seq, F.regexp_replace(sequence(F.col(text), sentences), r"(?:\|-\|){%d,}" % (gap + 1), run))
    telling = F.col(seq).rlike(r"\|[a-z]")
    # each rule takes what it matches out of the sequence and leaves a mark in its place
    state = F.struct(F.col(seq).alias("rest"), F.array().cast("array<string>").alias("found"))
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(pattern(ids, gap)).alias("pattern")) for name, ids in rules])
    used = F.aggregate(steps, state, lambda acc, rule: F.struct(
        F.regexp_replace(acc["rest"], rule["pattern"], F.lit("|=|")).alias("rest"),
        F.concat(acc["found"], F.array_repeat(rule["name"], F.regexp_count(acc["rest"], rule["pattern"]))).alias("found")))
    df = df.withColumn(found, F.when(telling, used["found"]).otherwise(F.array().cast("array<string>")))
    ids = F.filter(F.split(F.regexp_replace(F.trim(F.translate(F.col(seq), "|", " ")), " +", " "), " "), lambda x: (x != "-") & (x != ""))
    results = {"sentence_ids": ids, "licenses": F.array_distinct(found), "matches": F.size(found)}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in results]
    return df.select(*kept, *[c.alias(n) for n, c in results.items()])


def _sql() -> str:
    """The same over the given texts in DuckDB: rules of one sentence, whose
    sentences lie on lines of their own or behind a sentence end."""
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    order = {ids[0]: (k, name) for k, (name, ids) in reversed(list(enumerate(RULES))) if len(ids) == 1}
    ranked = ", ".join(f"('{i}', {k}, '{name}')" for i, (k, name) in order.items())
    return f"""
        WITH known(sentence, id) AS (VALUES {known}), rules(id, place, license) AS (VALUES {ranked}),
        lines AS (
            SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), '[\\r\\n]+')) AS line,
                   generate_subscripts(string_split_regex(regexp_replace(text, '([.!?;])[ \\t]+', '\\1' || chr(10), 'g'), '[\\r\\n]+'), 1) AS pos
            FROM documents),
        hits AS (
            SELECT l.doc_id, l.pos, k.id, r.place, r.license
            FROM lines l JOIN known k ON trim(regexp_replace(lower(l.line), '[^a-z0-9]+', ' ', 'g')) = k.sentence LEFT JOIN rules r ON r.id = k.id),
        found AS (
            SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids, count(license) AS matches FROM hits GROUP BY doc_id),
        named AS (
            SELECT doc_id, string_agg(license, ',' ORDER BY place) AS licenses
            FROM (SELECT doc_id, license, min(place) AS place FROM hits WHERE license IS NOT NULL GROUP BY doc_id, license) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(f.ids, '') AS sentence_ids, coalesce(n.licenses, '') AS licenses, CAST(coalesce(f.matches, 0) AS INTEGER) AS matches
        FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id"""


@query(_sql())
def op5_license_rules(spark, folder):
    found = scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), "matches")
