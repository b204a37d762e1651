"""Exact distinct counts by bitmaps.

Counting the different ids of a group by shuffling them costs a row for each (group,
id). Here the ids of a group fill bitmaps of 32,768 neighbouring numbers (4 KB), a
map task merges what it has read, and what is shuffled is bounded by groups x buckets
whatever the number of repeats. Bitmaps of finer groups (days) merge into those of
coarser ones (months) by OR. It pays where groups are few or their ids dense; per
person, where a bitmap would hold one or two ids, the ids themselves are smaller.

A task can merge only what it reads. Where the ids of a bucket are dealt over all tasks,
as after a shuffle by a hash of the id, each task would write a bitmap of its own for
every group and bucket, most of them for one or two ids: ``gathered`` brings
neighbouring ids together first, for one narrow row each, and what is written then
follows the ids, however many tasks there are.

Ids must be whole numbers; ``numbered`` gives the values of any other column dense ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import attach_key
from .windows import ordered_surrogate

BUCKET, BITS = "_bucket", "_bits"


def numbered(df: DataFrame, column: str, number: str) -> DataFrame:
    """``df`` with the rank of each value of ``column`` among its distinct values."""
    return attach_key(df, ordered_surrogate(df, column, number), column, number)


def gathered(df: DataFrame, number: str) -> DataFrame:
    """``df`` with neighbouring ids in the same tasks; select few columns before. A
    bucket that repeats hold in large numbers is split over several tasks."""
    return near(df, F.bitmap_bucket_number(F.col(number).cast("bigint")))


def near(df: DataFrame, bucket: Column) -> DataFrame:
    """``df`` dealt by the bucket of its bitmaps."""
    return df.withColumn("_near", bucket).hint("rebalance", "_near").drop("_near")


def id_bitmaps(df: DataFrame, groups: list[str], number: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """One row for each group and bucket: the ids as bits, and further sums. A NULL
    number counts in the sums only."""
    at = F.col(number).cast("bigint")
    placed = df.withColumn(BUCKET, F.bitmap_bucket_number(at)).withColumn("_bit", F.bitmap_bit_position(at))
    return placed.groupBy(*groups, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS), *[c.alias(n) for n, c in (sums or {}).items()])


def merged_bitmaps(parts: DataFrame, groups: list[str], sums: list[str] = ()) -> DataFrame:
    """Bitmaps and sums of coarser groups."""
    return parts.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(c).alias(c) for c in sums])


def bitmap_counts(parts: DataFrame, groups: list[str], count: str, sums: list[str] = ()) -> DataFrame:
    """Different ids of each group, and the sums."""
    return parts.groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(count), *[F.sum(c).alias(c) for c in sums])
