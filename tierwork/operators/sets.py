"""Unions, insert-if-absent, upsert and top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from . import skew
from .windows import dedupe


def replace_rows(current: DataFrame, key: str, value, fresh: DataFrame) -> DataFrame:
    """Replace the rows of one key and keep all others."""
    return current.filter(F.col(key) != F.lit(value)).unionByName(fresh)


def stacked(reports: dict[str, DataFrame], label: str) -> DataFrame:
    """Concatenate reports, each labelled in the first column."""
    labelled = [df.select(F.lit(name).alias(label), "*") for name, df in reports.items()]
    return reduce(DataFrame.unionByName, labelled)


def absent_rows(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows, one per key, whose key does not exist yet.

    The existing side is reduced to the keys that occur in the batch first: the
    keys of a batch that measures small are broadcast, and the big table is then
    read (key columns only) without being shuffled. Beyond that both sides are
    shuffled, with the hot keys of the existing side split.
    """
    fresh = dedupe(incoming, keys)
    wanted, there = incoming.select(*keys), existing.select(*keys)
    if skew.fits_broadcast(wanted):
        taken = there.join(F.broadcast(wanted), keys, "left_semi")
    else:
        taken = skew.split_join(there, wanted.distinct(), keys, "left_semi", skew.hot_keys(there, keys, other=wanted))
    return fresh.join(taken.distinct(), keys, "left_anti").select(*incoming.columns)


def insert_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING."""
    return existing.unionByName(absent_rows(incoming, existing, keys))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE: matched rows are replaced, others inserted, none deleted.
    ``incoming`` must be unique by key."""
    kept = existing.join(incoming.select(*keys), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Ordered first k rows; Spark keeps k rows per task (TakeOrderedAndProject).
    Give ``order`` a unique tail to make ties repeatable."""
    return df.orderBy(*order).limit(k)
