"""Which batches of a table may hold a key: Bloom filters kept with the batches.

A filter has BITS_PER_ROW bits for each row of its batch (a power of two of them), cut
into bitmaps of 4 KB, each made where its bits are brought together. A key that is not
in a batch passes its filter with a chance of about one in 400; a key that is in it
always passes, so a filter only saves reads and can't change a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .distinct import near

BITS_PER_ROW = 16
HASHES = 4
BITMAP_LOG2 = 15    # bits of a bitmap, fixed by the aggregate


def _hashes(keys: list[str]) -> Column:
    return F.array(*[F.xxhash64(F.lit(i), *[F.col(f"`{k}`") for k in keys]) for i in range(HASHES)])


def _place(hashed: Column, size_log2: Column) -> Column:
    return hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), size_log2) - 1)


def size_log2(rows: int) -> int:
    return max(BITMAP_LOG2, math.ceil(math.log2(max(rows, 1) * BITS_PER_ROW)))


def sketch(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The filter of ``df`` (size_log2, bucket, bits), ``rows`` being its row count.
    Where it is cut into several bitmaps, every task would write nearly all of them, so
    the bits of a bitmap are brought together before they are set."""
    size = size_log2(rows)
    at = df.select(F.explode(_hashes(keys)).alias("h")).select(_place(F.col("h"), F.lit(size)).alias("p"))
    if size > BITMAP_LOG2:
        at = near(at, F.shiftright("p", BITMAP_LOG2))
    return at.groupBy(F.shiftright("p", BITMAP_LOG2).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << BITMAP_LOG2) - 1))).alias("bits")).select(F.lit(size).alias("size_log2"), "bucket", "bits")


def may_hold(asked: DataFrame, sketches: DataFrame, keys: list[str], sizes: dict[int, int]) -> list[int]:
    """Of the batches in ``sizes`` (batch -> size_log2), those whose filter (rows of
    ``sketches``: batch_id, bucket, bits) passes at least one key of ``asked``. One
    number a batch reaches the driver."""
    if not sizes:
        return []
    batches = F.array(*[F.struct(F.lit(b).cast("bigint").alias("batch_id"), F.lit(s).alias("size")) for b, s in sorted(sizes.items())])
    probes = (
        asked.select(_hashes(keys).alias("of")).distinct()
        .select("of", F.explode(batches).alias("b")).select("of", "b.*", F.explode("of").alias("h"))
        .select("of", "batch_id", _place(F.col("h"), F.col("size")).alias("p"))
        .withColumn("bucket", F.shiftright("p", BITMAP_LOG2)))
    byte = F.expr(f"cast(conv(hex(substring(bits, cast(shiftright(p & {(1 << BITMAP_LOG2) - 1}, 3) AS int) + 1, 1)), 16, 10) AS int)")
    bit = F.call_function("shiftright", byte, F.col("p").bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
    met = probes.join(sketches.select("batch_id", "bucket", "bits"), ["batch_id", "bucket"]).filter(bit)
    passed = met.groupBy("of", "batch_id").agg(F.count("*").alias("n")).filter(F.col("n") == HASHES)
    return sorted(r["batch_id"] for r in passed.select("batch_id").distinct().collect())
