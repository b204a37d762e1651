"""Aggregations that are used by more than one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import as_col, bin_number, month_start
from ..sources.files import inline_rows
from .contents import row_hash
from .skew import BROADCAST_ROWS


def maximum(df: DataFrame, column: str, default):
    """Greatest value of a column, or ``default`` for an empty table. A control
    value: one row reaches the driver."""
    found = df.agg(F.max(column)).first()[0]
    return default if found is None else found


def duplicate_surplus(df: DataFrame, keys: list[str], nulls_equal: bool = True) -> DataFrame:
    """Rows, distinct keys and the surplus, in two aggregation levels (no
    DISTINCT expansion). With ``nulls_equal=False`` rows with a NULL in the key
    count as rows but not as distinct keys, like ``count(DISTINCT k)``."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    counted = F.count("*") if nulls_equal else F.count_if(complete)
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), counted.alias("distinct_keys")
    ).withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys"))


def fingerprint_counts(df: DataFrame, keys: list[str], nulls_equal: bool = True, fingerprint: Column | None = None) -> DataFrame:
    """Rows per 64-bit fingerprint of the key: ``_fp``, ``_n``. Eight bytes a key are
    shuffled, however wide the key is. With ``nulls_equal=False`` all rows with a NULL
    in the key are counted under a NULL fingerprint."""
    made = row_hash(keys) if fingerprint is None else fingerprint
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.select((made if nulls_equal else F.when(complete, made)).alias("_fp")).groupBy("_fp").agg(F.count("*").alias("_n"))


def duplicate_surplus_by_fingerprint(
    df: DataFrame, keys: list[str], nulls_equal: bool = True, fingerprint: Column | None = None, max_repeated: int = BROADCAST_ROWS,
) -> DataFrame:
    """:func:`duplicate_surplus` for wide keys, in two phases, with the same exact result.

    Fingerprints are counted first. One that occurs once stands for one key. Where some
    repeat, the rows that have one of these are read again with their whole keys, so
    that different keys of equal fingerprint are told apart. The repeated ones are
    broadcast up to ``max_repeated``; a table with more takes the plain way. One row of
    counts reaches the driver after each phase. ``df`` must read the same twice."""
    made = row_hash(keys) if fingerprint is None else fingerprint
    counts = fingerprint_counts(df, keys, nulls_equal, made)
    repeats = (F.col("_n") > 1) & F.col("_fp").isNotNull()
    seen = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count("_fp").alias("fingerprints"), F.count_if(repeats).alias("repeated")).first()
    if seen["repeated"] > max_repeated:
        return duplicate_surplus(df, keys, nulls_equal)
    keys_found = seen["fingerprints"] - seen["repeated"]
    if seen["repeated"]:
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        rows = df if nulls_equal else df.filter(complete)
        doubtful = rows.select(*keys, made.alias("_fp")).join(F.broadcast(counts.filter(repeats).select("_fp")), "_fp", "left_semi")
        keys_found += doubtful.groupBy(*keys).agg(F.count("*")).count()
    return inline_rows(
        df.sparkSession, [(seen["total"], keys_found, seen["total"] - keys_found)], "total_rows bigint, distinct_keys bigint, duplicates bigint")


def frequency(df: DataFrame, column: str, name: str = "cnt") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc_nulls_first(column))


def histogram(df: DataFrame, column: str | Column, low: float, high: float, bins: int) -> DataFrame:
    """Equal-width histogram after clipping to [low, high]; NULLs are left out."""
    value = as_col(column)
    return (
        df.select(bin_number(value, low, high, bins).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.count("*").alias("cnt"))
    )


def monthly_counts_filled(df: DataFrame, ts: str) -> DataFrame:
    """Rows per month between the first and the last month, empty months as 0.

    Each month fills the gap up to its successor, so the table is read once. The
    window without a partition sees one row per month, never the table's rows.
    """
    counts = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(month_start(ts).alias("month")).agg(F.count("*").alias("cnt"))
    )
    following = F.lead("month").over(Window.orderBy("month"))
    filled = counts.withColumn("_last", F.coalesce(F.add_months(following, -1), F.col("month"))).select(
        F.col("month").alias("_own"), "cnt", F.explode(F.sequence("month", "_last", F.expr("interval 1 month"))).alias("month"))
    return filled.select("month", F.when(F.col("month") == F.col("_own"), F.col("cnt")).otherwise(0).alias("cnt"))
