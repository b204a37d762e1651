"""Latest version, deduplication, dominant value and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import pinned


def full_row_order(df: DataFrame, skip: list[str] = ()) -> list[Column]:
    """Total order over a row, used as the last tiebreak so that the surviving
    row does not depend on partitioning."""
    return [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in skip]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key. Spark limits each group before the shuffle
    (WindowGroupLimit), so a hot key sends at most one row per map task."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_version(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """Current state of a change history: the row with the greatest
    ``newest_by`` columns per key, NULLs oldest."""
    newest = [F.col(c).desc_nulls_last() for c in newest_by]
    return first_per_key(df, keys, newest + full_row_order(df, [*keys, *newest_by]))


def dedupe(df: DataFrame, keys: list[str], within: list[str] | None = None) -> DataFrame:
    """Unique key subset with a deterministic survivor: the least full row.

    ``within`` names some of the keys that no hot group shares: rows are then dealt by
    these alone and sorted once, after the shuffle, and rows that agree in them stay
    together in what is written."""
    return first_per_key(df.repartition(*within) if within else df, keys, full_row_order(df, keys))


def dominant_value(df: DataFrame, keys: list[str], value: str, weight: str | None = None, hot: bool = True) -> DataFrame:
    """Most frequent value per key, smallest value on a tie.

    The (key, value) counts are aggregated first; ``weight`` names a count
    column when the input is already aggregated. Where no key is ``hot``, rows move
    once, by key; otherwise partial counts move by key and value and counts by key.
    """
    count = F.count("*") if weight is None else F.sum(weight)
    counts = (df if hot else df.repartition(*keys)).groupBy(*keys, value).agg(count.alias("_cnt"))
    return first_per_key(counts, keys, [F.desc("_cnt"), F.col(value).asc_nulls_first()]).select(*keys, value)


def ordered_surrogate(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """Number the distinct non-null values 1, 2, 3 ... in value order.

    No global window: values are range partitioned and sorted, the position
    inside each slice is checkpointed (range bounds are sampled, so they must
    not be drawn twice), and a running total of the slice sizes, one row per
    slice, turns local positions into global ones.
    """
    low_bits = (1 << 33) - 1
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    placed = pinned(
        values.repartitionByRange(column)
        .sortWithinPartitions(column)
        .withColumn("_at", F.monotonically_increasing_id())
        .select(column, F.shiftright("_at", 33).alias("_slice"), F.col("_at").bitwiseAND(F.lit(low_bits)).alias("_at"))
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice").agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per slice: bounded by the number of shuffle partitions
    numbered = placed.join(F.broadcast(offsets), "_slice")
    return numbered.select((F.col("_offset") + F.col("_at") + 1).alias(id_column), column)
