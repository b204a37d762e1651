"""Content fingerprints: what rows a table or a partition holds, in a few numbers.

A row is hashed to 64 bits over its columns by name, NULLs included; the rows of a
group are summed, so order, files and partitioning don't matter and copies count. The
sums merge map-side, whatever share of the rows a partition holds. Equal contents have
equal fingerprints; different ones agree with a chance of about 2^-64. Columns of type
map have no hash and are refused by Spark.

A comparison of two versions looks at fingerprints first and reads rows only of the
partitions that differ.

Defined cases: an empty table has count 0 and sums 0; NULL is a partition value like
any other; -0.0 and 0.0 are the same value, as are all NaNs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .skew import fits_broadcast

# A 64-bit hash is summed in three parts, so that a sum of longs holds 2^41 rows.
PARTS = ((0, 22), (22, 21), (43, 21))
SUMS = [f"_h{i}" for i in range(len(PARTS))]


def row_hash(columns: list[str]) -> Column:
    """Hash of a row. A column's NULL is hashed as a flag, since the hash function
    itself passes over NULLs and (NULL, 1) must differ from (1, NULL)."""
    named = [F.col(f"`{c}`") for c in sorted(columns)]
    return F.xxhash64(*[x for c in named for x in (c.isNull(), c)])


def measures(columns: list[str]) -> dict[str, Column]:
    """The sums, for an aggregate or for the stage that writes a table."""
    value = row_hash(columns)
    return {
        name: F.coalesce(F.sum(F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << bits) - 1))), F.lit(0)).alias(name)
        for name, (shift, bits) in zip(SUMS, PARTS)
    }


def fingerprints(df: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """``by``, row_count and the sums of each group; one row for the whole table
    without ``by``."""
    chosen = columns or df.columns
    found = [F.count("*").alias("row_count"), *measures(chosen).values()]
    return df.groupBy(*by).agg(*found) if by else df.agg(*found)


def whole(df: DataFrame, columns: list[str] | None = None) -> tuple:
    """Row count and sums of a table; one row reaches the driver."""
    return tuple(fingerprints(df, columns=columns).first())


def differing(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose :func:`fingerprints` differ: ``by``, rows_before, rows_after.
    A group that one side lacks has 0 rows there. The sides are unioned and grouped,
    so NULL values meet and no join is needed."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = F.col("row_count")
        return df.select(
            *by, (rows if sign < 0 else F.lit(0)).cast("bigint").alias("rows_before"), (rows if sign > 0 else F.lit(0)).cast("bigint").alias("rows_after"),
            *[(sign * F.col(c)).alias(c) for c in SUMS])

    both = side(before, -1).unionByName(side(after, 1)).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("rows_before", "rows_after", *SUMS)])
    unequal = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS], F.col("rows_before") != F.col("rows_after"))
    return both.filter(unequal).select(*by, "rows_before", "rows_after")


def only_in(df: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the given groups. A small list of groups is broadcast, which prunes the
    partitions that a stored table reads."""
    wanted = groups.select(*[F.col(c).alias(f"_of_{c}") for c in by])
    listed = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return df.join(listed, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]), "left_semi")


def changed_rows(before: DataFrame, after: DataFrame, by: list[str], groups: DataFrame | None = None) -> DataFrame:
    """The rows by which two versions differ, as rows of the table with
    ``change``: how many times more often ``after`` holds the row (negative: less
    often). Only partitions whose fingerprints differ are read for it; ``groups``
    names them where stored fingerprints have told them already."""
    columns = before.columns
    if groups is None:
        groups = differing(fingerprints(before, by, columns), fingerprints(after, by, columns), by)
    signed = only_in(before, groups, by).withColumn("change", F.lit(-1).cast("bigint")).unionByName(
        only_in(after, groups, by).select(*columns).withColumn("change", F.lit(1).cast("bigint")))
    return signed.groupBy(*columns).agg(F.sum("change").alias("change")).filter(F.col("change") != 0)
