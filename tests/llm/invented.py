"""Invented texts for the tests."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "th er on an re he in ed nd ha at en es or is".split(), "de": "sch ein ich der und ung keit lich ver zu ge be te".split()}


def sentence(rng: random.Random, words: int, lang: str = "en") -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))
