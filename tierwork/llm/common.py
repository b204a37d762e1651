"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import pinned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its own name."""
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, so that helper columns never
    clash with columns of the input."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as the empty text."""
    key = F.col(f"`{doc_id}`") if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts


def about(df: DataFrame, key: Column, rows: int, bound: int) -> DataFrame:
    """About ``bound`` of the ``rows`` rows of ``df``, chosen by a hash of ``key``
    so that the choice is the same on every run."""
    if rows <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 20)) < int(bound / rows * (1 << 20)))


def counts_in_batches(
    df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], flush: int = 400_000,
) -> DataFrame:
    """Sum counts by 64-bit key. Each task sums what it has read before it sends
    anything, in a buffer of bounded size."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            where, unique = pd.factorize(keys)
            return unique, np.bincount(where, weights=counts, minlength=len(unique)).astype(np.int64)

        for batch in batches:
            for keys, counts in keys_of(batch):
                held.append((keys.view(np.int64), counts))
                size += len(keys)
                if size > flush:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > flush // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], ["key", "n"])
                        held, size = [], 0
        if held:
            keys, counts = merged()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    return df.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


HOT_SHARE = 1024


def attach(big: DataFrame, small: DataFrame, key: str, weight: str, rows: int) -> DataFrame:
    """Left join of ``big`` with ``small``, which is unique by ``key`` and knows in
    ``weight`` how many of the ``rows`` rows of ``big`` have that key. Keys of more
    than rows / HOT_SHARE rows, at most HOT_SHARE of them, are broadcast and their
    rows stay where they are; all others are shuffled. ``big`` is read twice."""
    hot, limit = fresh(big, "hot"), rows // HOT_SHARE
    values = [c for c in small.columns if c not in (key, weight)]
    frequent = small.filter(F.col(weight) > limit).select(key, F.struct(F.lit(1).alias("one"), *values).alias(hot))
    marked = big.join(F.broadcast(frequent), key, "left")
    here = marked.filter(F.col(hot).isNotNull()).select(*big.columns, *[F.col(f"{hot}.{c}").alias(c) for c in values])
    rest = marked.filter(F.col(hot).isNull()).drop(hot).join(
        small.filter(F.col(weight) <= limit).select(key, *values), key, "left").select(*big.columns, *values)
    return here.unionByName(rest)


__all__ = ["QUERIES", "SQL", "about", "attach", "counts_in_batches", "fold", "fresh", "pinned", "query", "table"]
