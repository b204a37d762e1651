"""Language by nearest centroid over TF-IDF character n-grams.

Letters of a text (lower case, other characters as gaps) give hashed n-grams of
one to three characters, counted over the whole text. Document frequencies come
from every training document. A text's vector is log(1 + count) times the inverse
document frequency, scaled to length one. Each language has several centroids,
found by spherical k-means on a bounded sample of its training documents; a text
belongs to the language of the centroid with the largest cosine. It is rejected
when that cosine is below what all but a small share of the sample reach for the
same centroid.

Defined cases: NULL text or text without a letter is ``und`` with score 0 and is
rejected. Ties between languages go to the smaller name. Without any training
row every text is ``und``. A language with fewer documents than centroids has as
many centroids as documents. Equal texts get equal results; columns of the input
are kept, and one named like a result column is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import counts_in_batches, fold, fresh, query, table

BUCKETS = 1 << 14
SAMPLE_PER_LANGUAGE = 1500      # documents of each language that centroids are fitted on
CENTROIDS = 3
ROUNDS = 8
REJECT_SHARE = 0.001            # share of the sample below the rejection limit
REJECT_MARGIN = 0.5             # of the cosine at that share
SLICE = 200_000                 # characters hashed at once
_GAP = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    return _GAP.sub(" ", f" {text} ".lower()) if text else " "


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams, ascending, and their counts."""
    clean = letters(text)
    if not clean.strip():
        return np.empty(0, np.int64), np.empty(0)
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(clean), SLICE):      # slices overlap by two characters
        c = np.frombuffer(clean[max(0, at - 2):at + SLICE].encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        new = min(2, at)
        for n, salt in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
            if len(c) < n:
                continue
            h = np.full(len(c) - n + 1, salt, np.uint64)
            for k in range(n):
                h = (h ^ c[k:len(c) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            total += np.bincount((h[max(0, new - n + 1):] >> np.uint64(17)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at].astype(float)


@dataclass
class Model:
    languages: list[str]        # of each centroid
    centroids: np.ndarray       # (centroids, BUCKETS) of length one
    idf: np.ndarray
    limits: np.ndarray          # cosine below which a text is rejected

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        at, n = grams(text)
        v = np.log1p(n) * self.idf[at]
        return at, v / (np.linalg.norm(v) or 1.0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        at, v = self.vector(text)
        if not len(at) or not self.languages:
            return "und", 0.0, True
        cosines = np.round(self.centroids[:, at] @ v, 12)
        best = min(range(len(cosines)), key=lambda k: (-cosines[k], self.languages[k]))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[best], score, bool(score < self.limits[best])


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Of every bucket, over all documents; tasks send sums of at most BUCKETS rows."""
    def keys_of(batch):
        seen = np.zeros(BUCKETS, np.int64)
        for value in batch.column(0).to_pylist():
            seen[grams(value)[0]] += 1
        at = np.flatnonzero(seen)
        yield at.astype(np.uint64), seen[at]

    found = counts_in_batches(docs.select(F.col(text).cast("string")), keys_of).collect()
    out = np.zeros(BUCKETS)
    for row in found:
        out[row["key"]] = row["n"]
    return out


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from spread-out first centres; deterministic."""
    centres = [vectors.mean(0)]
    centres[0] /= np.linalg.norm(centres[0]) or 1.0
    nearest = vectors @ centres[0]
    while len(centres) < k:
        centres.append(vectors[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, vectors @ centres[-1])
    centre = np.array(centres)
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centre.T, axis=1)
        for c in range(k):
            if (own == c).any():
                m = vectors[own == c].mean(0)
                centre[c] = m / (np.linalg.norm(m) or 1.0)
    return centre


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from rows with a language. Frequencies count all of them; centroids
    are fitted where the sample of a language, at most SAMPLE_PER_LANGUAGE
    documents, comes together: one group for each language."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    n = sum(sizes.values())
    idf = np.log((n + 1) / (document_frequencies(rows) + 1)) + 1e-3
    base = Model([], np.zeros((0, BUCKETS)), idf, np.zeros(0))
    if not sizes:
        return base
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key", F.lit(23)), F.xxhash64("text"))
    # the choice needs no text: the ids are drawn first, their texts read afterwards
    share = F.create_map(*[x for name, size in sizes.items() for x in (F.lit(name), F.lit(min(1.0, 1.2 * SAMPLE_PER_LANGUAGE / size)))])
    drawn = rows.filter(F.pmod(F.xxhash64("key", F.lit(23)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    sample = drawn.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= SAMPLE_PER_LANGUAGE).drop("_r")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in group["text"] if letters(t).strip()]
        if not texts:
            return pd.DataFrame({"lang": [], "k": [], "limit": [], "centroid": []})
        x = np.zeros((len(texts), BUCKETS), np.float32)
        for k, t in enumerate(texts):
            at, v = base.vector(t)
            x[k, at] = v
        centre = _cluster(x, min(CENTROIDS, len(np.unique(x.sum(1))), len(texts)))
        cosines = x @ centre.T
        own = cosines.argmax(1)
        limit = [float(np.quantile(cosines[own == c, c], REJECT_SHARE)) * REJECT_MARGIN if (own == c).any() else 0.0 for c in range(len(centre))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "k": range(len(centre)), "limit": limit, "centroid": [c.astype(np.float32).tobytes() for c in centre]})

    fitted = sorted(sample.groupBy("lang").applyInPandas(fit, "lang string, k int, limit double, centroid binary").collect(), key=lambda r: (r["lang"], r["k"]))
    base.languages = [r["lang"] for r in fitted]
    base.centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in fitted], float).reshape(len(fitted), BUCKETS)
    base.limits = np.array([r["limit"] for r in fitted])
    return base


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # centroids x BUCKETS numbers

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    names = ("lang_pred", "score", "rejected")
    kept, found = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names], fresh(docs, "language")
    return docs.select(*kept, of(F.col(text).cast("string")).alias(found)).select(
        *kept, *[F.col(f"{found}.{n}").alias(n) for n in names])


def learn_from(docs: DataFrame) -> Model:
    return train(docs.select("doc_id", "text", "lang").filter(fold("doc_id", 5) != 0))


@query()
def op7_centroid_language(spark, folder):
    docs = table(spark, folder, "documents")
    found = identify(docs.select("doc_id", "text"), learn_from(docs))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def stage(spark, docs, folder):
    """Drop the documents whose language is rejected: no letters, or far from
    every centroid. The language column itself is left as it came."""
    model = learn_from(table(spark, folder, "documents"))
    mark = "_language_rejected"
    while mark in docs.columns:
        mark = f"_{mark}"
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def rejected(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.predict(t)[2] for t in texts], dtype="bool")

    return docs.withColumn(mark, rejected(F.col("text"))).filter(~F.col(mark)).drop(mark)
