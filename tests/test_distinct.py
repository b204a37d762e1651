"""Exact distinct counts by bitmaps."""

import random

from pyspark.sql import functions as F

from tierwork.operators.distinct import bitmap_counts, gathered, id_bitmaps, merged_bitmaps, numbered
from tierwork.plans import gold, marts

EDGES = [0, 1, 32767, 32768, 32769, 65536, 1 << 40, -1, -32768]


def rows():
    rnd = random.Random(2)
    made = [(g, f, rnd.choice(EDGES + [rnd.randrange(100_000)]), 1) for g, f in ((rnd.choice("ab"), rnd.choice("xyz")) for _ in range(4000))]
    return made + [("only null", "x", None, 1), ("a", "x", None, 1), (None, None, 5, 1), (None, None, 5, 1)]


def test_bitmap_counts_equal_count_distinct(spark):
    df = spark.createDataFrame(rows(), "g string, f string, id long, v long").repartition(7)
    fine = id_bitmaps(df, ["g", "f"], "id", {"v": F.sum("v")})
    found = bitmap_counts(merged_bitmaps(fine, ["g"], ["v"]), ["g"], "n", ["v"])
    wanted = df.groupBy("g").agg(F.countDistinct("id").alias("n"), F.sum("v").alias("v"))
    assert sorted(map(tuple, found.select("g", "n", "v").collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    assert bitmap_counts(id_bitmaps(df.limit(0), ["g"], "id"), ["g"], "n").count() == 0


def test_text_ids_get_dense_numbers(spark):
    df = spark.createDataFrame([(f"o{k % 50}", k % 3) for k in range(400)] + [(None, 1)], "id string, g long")
    dense = numbered(df, "id", "number")
    assert dense.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first() == (1, 50, 50)
    found = bitmap_counts(id_bitmaps(dense, ["g"], "number"), ["g"], "n")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.groupBy("g").agg(F.countDistinct("id")).collect()))


def test_no_id_is_shuffled(spark):
    """Every exchange carries groups, buckets, bits and sums; never the id itself."""
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("order_no"))
    plan = bitmap_counts(id_bitmaps(df, ["g"], "order_no"), ["g"], "n")._jdf.queryExecution().sparkPlan().toString()
    prepared = bitmap_counts(id_bitmaps(df, ["g"], "order_no"), ["g"], "n")._jdf.queryExecution().executedPlan()
    exchanges = [line for line in prepared.toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and not any("order_no" in line for line in exchanges) and "bitmap_construct_agg" in plan
    written = id_bitmaps(df, ["g"], "order_no")
    assert written.count() <= 3 * (200_000 // 32768 + 2)


def test_ids_dealt_over_all_tasks_are_gathered(spark):
    """A bucket's ids meet in one task (or few), so a task writes few bitmaps."""
    df = spark.range(320_000).select("id").repartition(8, F.xxhash64("id"))
    placed = F.bitmap_bucket_number("id").alias("bucket"), F.spark_partition_id().alias("task")
    assert df.select(*placed).distinct().count() > 60
    assert gathered(df, "id").select(*placed).distinct().count() <= 20
    assert gathered(df, "id").columns == ["id"]


def test_months_are_attached_before_bitmaps(spark):
    """One bitmap for each month and bucket, not for each day; the rows are gathered."""
    sold = spark.range(2_000).selectExpr(
        "id % 700 AS order_id", "20240101 + id % 28 AS purchase_date_id", "'delivered' AS order_status", "1.0D AS total_revenue")
    mart = marts.monthly_revenue(sold, gold.dim_date(spark, "2024-01-01", "2024-01-31"), order_number="order_id")
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    made = next(line for line in plan.splitlines() if "bitmap_construct_agg" in line)
    assert "purchase_date_id" not in made and "month" in made and "RebalancePartitions" in plan
    assert [tuple(r) for r in mart.collect()] == [(2024, 1, 2000.0, 700)]
