"""The physical plans that the design counts on."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tierwork.functions import columns as c
from tierwork.operators import sets, windows
from tierwork.plans import marts
from tierwork.registry.all import QUERIES, Tables
from tierwork.sources.jdbc import JdbcSource, Slices


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.fixture
def given():
    if not os.path.isdir(entry.SMOKE_DIR):
        pytest.skip("given data not present")
    return entry.SMOKE_DIR


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_groups_are_limited_before_the_shuffle(spark):
    df = windows.latest_version(spark.range(10).select((F.col("id") % 3).alias("id"), F.col("id").alias("at")), ["id"], ["at"])
    before_exchange = plan(df).split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_month_slice_prunes_in_the_scan(spark, given):
    found = plan(QUERIES["month_slice"](Tables(spark, given)))
    assert "GreaterThanOrEqual(o_orderdate" in found and "LessThan(o_orderdate" in found
    assert "o_orderpriority" not in found


def test_top_k_never_sorts_globally(spark, given):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](Tables(spark, given)))


def test_no_query_uses_python_rows_or_cartesian_products(spark, given):
    for name in ["mart_monthly_revenue", "mart_state_performance", "mart_category_ranking", "mart_review_by_category",
                 "fact_orders", "silver_payments", "dq_fk", "dq_counts", "upsert_key", "insert_absent", "top_categories"]:
        found = plan(QUERIES[name](Tables(spark, given)))
        assert not re.search(r"CartesianProduct|PythonUDF|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", found), name


def test_facts_are_combined_before_the_dimension_join(spark, no_broadcast):
    facts = spark.range(100).select(
        F.col("id").alias("order_id"), (F.col("id") % 3).alias("customer_id"), F.lit("shipped").alias("order_status"),
        F.lit(1.0).alias("total_revenue"), F.lit(1).alias("delivery_days"))
    people = spark.range(3).select(F.col("id").alias("customer_id"), F.lit("SP").alias("state"))
    found = plan(marts.state_performance(facts, people, orders_unique=True))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", found)) == 2  # one per side, none for the join itself
    assert "partial_count(order_id" in found or "partial_count" in found


def test_adaptive_execution_splits_a_hot_key(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(80_000, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("order_id"), F.col("id").alias("n"))
        valid = spark.range(0, 1000, 1, 4).select(F.col("id").alias("order_id"))
        assert "skew=true" in final_plan(items.join(valid, ["order_id"], "left_semi"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    spark.range(200_000).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(f"{tmp_path}/old")
    incoming = spark.createDataFrame([(5, 0), (-1, 0)], "k bigint, v bigint")
    fresh = sets.absent_rows(incoming, spark.read.parquet(f"{tmp_path}/old"), ["k"])
    assert [tuple(r) for r in fresh.collect()] == [(-1, 0)]
    scan = plan(fresh).split("FileScan")[1]
    assert "ReadSchema: struct<k:bigint>" in scan
    assert "BroadcastHashJoin [k" in plan(fresh)


def test_items_move_twice_to_a_small_dimension(spark, given):
    found = plan(QUERIES["mart_review_by_category"](Tables(spark, given)))
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)", found)
    assert sum("category_name_english" in m and "order_id" in m for m in moved) == 1
    assert not any("product_id" in m and "order_id" in m for m in moved)


def test_versions_are_read_by_partition(spark, given):
    found = plan(QUERIES["version_as_of"](Tables(spark, given)))
    assert re.search(r"PartitionFilters: \[[^]]*batch_id", found)


def test_half_open_month_matches_any_timestamp_type(spark):
    df = spark.sql("SELECT timestamp'2020-02-29 23:00:00' AS zoned, timestamp_ntz'2020-02-29 23:00:00' AS plain")
    assert df.select(c.in_month("zoned", "2020-02"), c.in_month("plain", "2020-02")).first() == (True, True)


def test_jdbc_options():
    source = JdbcSource("jdbc:x://h/db", "org.x.Driver", "shop", {"user": "u"})
    assert source.qualified("orders") == "shop.orders"
    got = source.options(dbtable="shop.orders", **Slices("id", 1, 100, 8).options())
    assert got == {
        "url": "jdbc:x://h/db", "driver": "org.x.Driver", "user": "u", "dbtable": "shop.orders",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
    }


def test_payments_move_once_without_hot_orders(spark):
    from tierwork.plans import silver
    df = spark.range(2000).selectExpr(
        "id div 8 AS order_id", "CAST(id % 4 AS INT) AS payment_sequential", "'a' AS payment_type", "1 AS payment_installments",
        "CAST(id AS DOUBLE) AS payment_value")
    found = final_plan(silver.order_payments(df)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning", found)) == 1 and "Join" not in found


def test_orders_find_their_category_in_two_moves(spark, no_broadcast):
    items = spark.range(4000).selectExpr("id div 4 AS order_id", "id % 50 AS product_id")
    products = spark.range(50).selectExpr("id AS product_id", "concat('c', id % 3) AS category_name_english")
    once, more = (marts.order_category(items, products, [], hot_orders) for hot_orders in ([], None))
    moves = [len(re.findall(r"Exchange hashpartitioning\(order_id", final_plan(df).split("== Initial Plan ==")[0])) for df in (once, more)]
    assert moves == [1, 2]
    assert sorted(once.collect()) == sorted(more.collect())


def test_the_day_of_a_load_is_no_work_per_row(spark, tmp_path):
    """Rows that share the partition value are neither sorted by it nor formatted."""
    from tierwork.sinks.tables import OPEN_FILES, Warehouse, replace_table, stage_tables
    wh = Warehouse(spark, str(tmp_path), namespace="dayload_")
    wh.bootstrap()
    before = spark.conf.get(OPEN_FILES)
    df = spark.range(0, 400, 1, 1).selectExpr("id", "id % 7 AS part", "399 - id AS falling")
    staged = stage_tables(wh, {"bronze.t": df}, {"bronze.t": "part"})["bronze.t"]
    replace_table(wh, df, "bronze.u", "part")
    assert spark.conf.get(OPEN_FILES) == before
    for got in (staged.rows(spark), wh.table("bronze.u")):
        assert sorted(map(tuple, got.select("id", "part", "falling").collect())) == [(i, i % 7, 399 - i) for i in range(400)]
    assert len(os.listdir(staged.path)) >= 7
