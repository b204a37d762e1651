"""Joins that stay balanced when one key holds a large share of the rows.

Order of preference in this package:

1. aggregate by the join key before joining, so that a hot key arrives as a
   handful of partial rows (see ``plans.marts``);
2. broadcast the other side when its measured size is small;
3. split the hot keys explicitly, as below. Every key that is not split takes
   the ordinary shuffle join, where adaptive execution still applies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# A key is split when it holds more than 1/SPLIT_SHARE of the rows, so there can
# never be more than SPLIT_SHARE such keys: the list is bounded by construction.
SPLIT_SHARE = 2048
SKETCH_ITEMS = 32768
MIN_HOT_ROWS = 100_000

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class HotKey:
    key_hash: int
    parts: int


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a candidate for broadcasting. The row count of a Parquet table is
    answered from footers; text is measured only when the count is small. Nested
    and binary columns have no cheap measure and rule broadcasting out."""
    if any(isinstance(f.dataType, (ArrayType, BinaryType, MapType, StructType)) for f in df.schema.fields):
        return False
    rows = df.count()
    if rows > max_rows:
        return False
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    fixed = 16 * (len(df.columns) - len(text)) * rows
    if not text:
        return fixed <= max_bytes
    measured = df.agg(F.sum(sum(F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in text)).alias("b")).first()["b"]
    return fixed + (measured or 0) <= max_bytes


def common_types(left: DataFrame, right: DataFrame, keys: list[str]) -> dict[str, str]:
    """The type in which a join compares each key; no job is run."""
    typed = left.sparkSession.range(0).select(*[
        F.coalesce(F.lit(None).cast(left.schema[k].dataType), F.lit(None).cast(right.schema[k].dataType)).alias(k) for k in keys])
    return dict(typed.dtypes)


def key_hash(keys: list[str], types: dict[str, str]) -> Column:
    """Hash of the key in the compared types; equal keys have equal hashes, also
    INT 1 and BIGINT 1, or -0.0 and 0.0."""
    parts = [F.col(k).cast(types[k]) for k in keys]
    return F.xxhash64(*[p + F.lit(0.0).cast(types[k]) if types[k] in ("float", "double") else p for k, p in zip(keys, parts)])


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = MIN_HOT_ROWS, other: DataFrame | None = None) -> list[HotKey]:
    """Keys that hold more than 1/SPLIT_SHARE of the rows, found with a mergeable
    frequent-items sketch: one pass over the key columns and no shuffle of keys.
    ``other`` is the side that ``df`` is joined with, if its key types may differ.

    The list only steers balance. A missed or a surplus key, or two keys that
    share a hash, cannot change a join result.
    """
    types = common_types(df, df if other is None else other, keys)
    found = (
        df.select(key_hash(keys, types).alias("key_hash"))
        .agg(
            F.count("*").alias("total"),
            F.expr(f"approx_top_k(key_hash, {SPLIT_SHARE}, {SKETCH_ITEMS})").alias("items"),
        )
        .first()
    )
    unit = max(found["total"] / SPLIT_SHARE, min_rows)
    return [
        HotKey(item["item"], int(item["count"] // unit) + 1)
        for item in found["items"] or []
        if item["count"] > unit
    ]


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: list[HotKey]) -> DataFrame:
    """Equi join in which each hot key is spread over ``parts`` tasks.

    A left row goes to the part named by its input partition, which is the same
    after a task is retried and also separates rows that are exact copies. The
    right rows of a hot key are repeated once per part, so every left row still
    meets all its partners exactly once; hence only joins that keep the left
    side's grain are accepted. Both sides hash the key in the type the join
    compares, so keys of different types are repeated alike.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a {how} join")
    if not hot:
        return left.join(right, keys, how)
    spark = left.sparkSession
    types = common_types(left, right, keys)
    parts = F.broadcast(spark.createDataFrame([(h.key_hash, h.parts) for h in hot], "_key_hash bigint, _parts int"))

    def with_parts(df: DataFrame) -> DataFrame:
        return df.withColumn("_key_hash", key_hash(keys, types)).join(parts, "_key_hash", "left").drop("_key_hash")

    spread = with_parts(left).withColumn(
        "_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.spark_partition_id(), F.col("_parts")))
    ).drop("_parts")
    repeated = with_parts(right).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    ).drop("_parts")
    return spread.join(repeated, [*keys, "_part"], how).drop("_part")


def sized_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
    measured: DataFrame | None = None, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join with a lookup or keyed aggregate: broadcast it when it measures
    small, otherwise shuffle both sides with the hot keys of ``left`` split.
    ``measured`` names a cheaper frame that is at least as large as ``right``."""
    if fits_broadcast(right if measured is None else measured):
        return left.join(F.broadcast(right), keys, how)
    return split_join(left, right, keys, how, hot_keys(left, keys, min_rows, right))
