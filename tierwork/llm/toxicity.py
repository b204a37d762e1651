"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on what marks toxic text and one on
what marks ordinary text. A window of a text is compressed with either; the bytes
that the toxic dictionary saves against the ordinary one, alone and as a share of
the window, are its distance. Windows are aligned to words, one word each. The
share of a window and the saved bytes are counted against thresholds, and a
logistic regression over these counts calibrates the score of a whole text.

Two things make lengths of short windows comparable. Characters are widened: each
becomes three bytes that hash the character and the one before it, so literals
cost their full length while a match costs a few bytes. And a dictionary holds
only word beginnings that set its class apart (document frequency, z-score and
lift on the training rows), the shortest that do, so that text common to both
classes costs the same in both and a whole match saves more than part of one.
zstandard's own trainer picks what is frequent in both classes instead; it
separated the given data far worse (README).

Defined cases: a NULL or empty text, or one without letters or digits, has no
windows and gets the score of zero distances. Equal texts get equal scores.
Training without rows of both classes scores every text by the observed share
(0 without any). Unlabelled or NULL labels are not learnt from. Columns of the
input are kept; one named like a result column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import about, fold, fresh, pinned, query, table

SAMPLE_PER_CLASS = 4000     # documents of each class that dictionaries are trained on
MIN_Z, RELATIVE_Z, MIN_LIFT = 6.0, 0.25, 4.0     # of a toxic fragment; its z-score also against the largest
ORDINARY_Z, ORDINARY_LIFT = 4.0, 3.0
MAX_FRAGMENTS = 400
THRESHOLD = 0.3
SHARES = (0.25, 0.35, 0.45, 0.55)
SAVED = 8               # bytes; part of a shortest fragment saves less
CACHE = 400_000             # distinct words whose distance a task keeps
_GAP = re.compile(r"[\W_]+")


def words_of(text: str | None) -> list[str]:
    return _GAP.sub(" ", text.lower()).split() if text else []


def fragments(words: list[str]) -> set[str]:
    """Word beginnings of a text."""
    return {w[:k] for w in set(words) if len(w) >= 4 for k in {4, 5, 6, 7, 8, 10, min(len(w), 12)} if k <= len(w)}


def widen(text: str) -> np.ndarray:
    """Three bytes for each character, from the character and the one before."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    before = np.empty_like(code)
    before[:1], before[1:] = 32, code[:-1]
    h = (code * np.uint32(0x9E3779B1)) ^ (before * np.uint32(0x85EBCA77))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h.view(np.uint8).reshape(-1, 4)[:, :3]


def chosen(scored: list[tuple[str, float]]) -> list[str]:
    """Fragments by rising z-score, without those that begin like a kept one; of a
    chain of beginnings the shortest that is nearly as telling stays."""
    kept: list[list] = []
    for fragment, z in sorted(scored, key=lambda x: (-x[1], x[0])):
        alike = [k for k in kept if fragment.startswith(k[0]) or k[0].startswith(fragment)]
        if not alike and len(kept) < MAX_FRAGMENTS:
            kept.append([fragment, z])
        elif len(alike) == 1 and alike[0][0].startswith(fragment) and z >= 0.9 * alike[0][1]:
            alike[0][0] = fragment
    return [k[0] for k in reversed(kept)]


@dataclass
class Model:
    """Small and picklable: two dictionaries and the calibration."""

    toxic: bytes
    ordinary: bytes
    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    _tools: list = field(default_factory=list, repr=False)
    _seen: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_tools": [], "_seen": {}}

    def lengths(self, window: bytes) -> tuple[int, int]:
        """Compressed bytes with the toxic and with the ordinary dictionary."""
        if not self._tools:
            settings = zstandard.ZstdCompressionParameters(
                window_log=14, hash_log=12, chain_log=12, search_log=6, min_match=6, target_length=64,
                strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_checksum=0, write_dict_id=0)
            for content in (self.toxic, self.ordinary):
                trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                trained.precompute_compress(compression_params=settings)
                self._tools.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=trained))
        return len(self._tools[0].compress(window)), len(self._tools[1].compress(window))

    def learn_windows(self, words: set[str]) -> None:
        new = [w for w in words if w not in self._seen]
        if len(self._seen) + len(new) > CACHE:
            self._seen.clear()
            new = list(words)
        wide, at = widen("".join(f" {w} " for w in new)), 0
        for w in new:
            window = wide[at:at + len(w) + 2].tobytes()
            at += len(w) + 2
            toxic, ordinary = self.lengths(window)
            self._seen[w] = (ordinary - toxic, (ordinary - toxic) / (len(window) + 9))

    def features(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(8 + len(SHARES))
        found = np.empty((len(words), 2))
        for at in range(0, len(words), 50_000):     # bounds the cache for very long texts
            part = words[at:at + 50_000]
            self.learn_windows(set(part))
            found[at:at + len(part)] = list(map(self._seen.__getitem__, part))
        top = min(4, len(words))
        saved, share = (-np.partition(-found[:, k], range(top))[:top] for k in (0, 1))
        over = found[:, 1]
        return np.array([
            saved[0], saved[:2].sum() / 2, saved.sum() / 4, share[0], share[:2].sum() / 2, share.sum() / 4,
            (over > SHARES[1]).mean(), np.log1p((found[:, 0] >= SAVED).sum()), *(np.log1p((over > s).sum()) for s in SHARES)])

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        # summed row by row, so that a score does not depend on the rows beside it
        z = self.weights[0] + ((features - self.mean) / self.scale * self.weights[1:]).sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton steps for a logistic regression; ``x`` has a leading column of ones."""
    ridge = np.r_[1e-6, np.full(x.shape[1] - 1, penalty)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        w -= np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return w


def _fragment_counts(batches):
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int32()), pa.array(list(held.values()), pa.int64())],
            ["fragment", "label", "n"])

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.update((f, label) for f in fragments(words_of(text)))
            if len(held) > 300_000:
                yield out()
                held.clear()
    if held:
        yield out()


def feature_column(model: Model, text: Column) -> Column:
    shared = model

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.features(t).tolist() for t in texts])

    return of(text)


def train(docs: DataFrame, marks: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """Learn from the texts of ``docs`` whose key ``marks`` labels 0 or 1 (one row
    for each key). Dictionaries and calibration use about SAMPLE_PER_CLASS
    documents of each class, taken by a hash of the key before any text is read;
    the texts are read whole and stay on the executors."""
    rows = marks.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2:
        return Model(b"", b"", prior)
    part = {c: about(rows.filter(F.col("label") == c), F.col("key"), sizes[c], SAMPLE_PER_CLASS) for c in (0, 1)}
    ids = F.broadcast(part[0].unionByName(part[1]))     # about twice SAMPLE_PER_CLASS rows
    texts = docs.select(F.col(text).alias("text"), F.col(key).alias("key")).join(ids, "key")
    sample = pinned(texts.withColumn("hash", F.xxhash64("text")).dropDuplicates(["hash", "label"]).select("text", "label"))     # copies count once
    n = {0: 0, 1: 0} | {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not all(n.values()):
        return Model(b"", b"", prior)
    a = (F.col("n1") + 0.5) / (n[1] + 1)
    b = (F.col("n0") + 0.5) / (n[0] + 1)
    pooled = (F.col("n1") + F.col("n0") + 1) / (n[1] + n[0] + 2)
    deviation = F.sqrt(pooled * F.greatest(1 - pooled, F.lit(1e-6)) * (1 / n[1] + 1 / n[0]))
    telling = (
        sample.select("text", "label").mapInArrow(_fragment_counts, "fragment string, label int, n long")
        .groupBy("fragment").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
                                 F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"))
        .filter(F.col("n1") + F.col("n0") >= 5).withColumn("z", (a - b) / deviation)
        .withColumn("toxic", (F.col("z") >= MIN_Z) & (a >= MIN_LIFT * b))
        .withColumn("ordinary", (F.col("z") <= -ORDINARY_Z) & (b >= ORDINARY_LIFT * a))
    )
    telling = pinned(telling.filter("toxic or ordinary").select("fragment", "z", "toxic", "ordinary"))
    best = {c: [(r["fragment"], abs(r["z"])) for r in telling.filter(F.col(c)).orderBy(F.abs("z").desc(), "fragment").limit(4 * MAX_FRAGMENTS).collect()]
            for c in ("toxic", "ordinary")}
    least = RELATIVE_Z * max((z for _, z in best["toxic"]), default=0.0)
    best["toxic"] = [(f, z) for f, z in best["toxic"] if z >= least]
    toxic = widen("".join(f" {w}" for w in chosen(best["toxic"])) + " " * 4).tobytes()
    ordinary = widen("".join(f" {w}" for w in chosen(best["ordinary"])) + " " * 4).tobytes()[-len(toxic):]
    model = Model(toxic, ordinary.rjust(len(toxic), b"\0"), prior)
    seen = sample.select("label", feature_column(model, F.col("text")).alias("f")).collect()
    x, y = np.array([r["f"] for r in seen]), np.array([r["label"] for r in seen], float)
    if not len(y) or y.min(initial=1) == y.max(initial=0):
        return model
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    w = logistic(np.c_[np.ones(len(x)), (x - model.mean) / model.scale], y)
    # the sample is balanced to a degree; the intercept goes back to the true shares
    w[0] += np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (len(y) - y.sum()))
    model.weights = w
    return model


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)    # two dictionaries of at most some 20 KB

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series(m.score(np.array([m.features(t) for t in texts]).reshape(len(texts), -1)), dtype="float64")

    return of(text.cast("string"))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    scored = docs.withColumn("score", score_column(docs.sparkSession, model, F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def learn_from(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on labelled documents outside the held-out fold. Ids that repeat in
    ``labels`` count once, with their largest label."""
    marks = labels.filter(F.col("toxic").isNotNull() & (fold("doc_id", 4) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return train(docs, marks)


@query()
def op6_compression_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = learn_from(docs, table(spark, folder, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def stage(spark, docs, folder):
    """Drop the documents predicted to be toxic. Labels from which nothing could be
    learnt (one class alone, or no telling words) drop no document: their share of
    toxic rows says nothing about a text."""
    model = learn_from(table(spark, folder, "documents"), table(spark, folder, "labels"))
    if model.weights is None:
        return docs
    mark = fresh(docs, "toxicity")
    return docs.withColumn(mark, score_column(spark, model, F.col("text"))).filter(F.col(mark) < THRESHOLD).drop(mark)
