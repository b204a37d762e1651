"""Joins and totals of bucketed tables: without an exchange, equal to plain ones."""

import uuid

import pytest
from pyspark.sql import functions as F

from tierwork.sinks.bucketed import bucket_join, bucket_totals, open_bucketed, write_bucketed
from tierwork.sinks.tables import Warehouse


@pytest.fixture
def wh(spark, tmp_path):
    made = Warehouse(spark, f"{tmp_path}/wh", namespace=f"b{uuid.uuid4().hex[:10]}_")
    made.bootstrap()
    return made


@pytest.fixture
def given(spark):
    orders = spark.range(300).select(F.concat(F.lit("o"), "id").alias("order_id"), (F.col("id") % 4).alias("status"))
    # order 7 holds half of the items; some items have no order, or none that is known
    items = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "o7").when(F.col("id") % 501 == 0, None).otherwise(F.concat(F.lit("o"), F.col("id") % 310)).alias("order_id"), F.col("id").alias("line"))
    return orders, items


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("min_hot_rows", [100, 100_000])
def test_joins_equal_plain_ones(wh, given, how, min_hot_rows):
    orders, items = given
    a = write_bucketed(wh, items, "gold.items", "order_id", 8, min_hot_rows=min_hot_rows)
    b = write_bucketed(wh, orders, "gold.orders", "order_id", 8, unique=True)
    assert len(a.hashes) == (1 if min_hot_rows == 100 else 0) and a.hot.count() == (items.filter("order_id = 'o7'").count() if a.hashes else 0)
    found = bucket_join(a, b, how, where=F.col("status") != 3)
    wanted = items.join(orders.filter("status <> 3"), "order_id", how)
    assert rows(found, *wanted.columns) == rows(wanted, *wanted.columns)
    assert exchanges(found) == []
    assert rows(wh.table("gold.items"), "order_id", "line") == rows(items, "order_id", "line") == rows(open_bucketed(wh, "gold.items").rows(), "order_id", "line")


@pytest.mark.parametrize("min_hot_rows", [100, 100_000])
def test_totals_equal_plain_ones(wh, given, min_hot_rows):
    orders, items = given
    child = write_bucketed(wh, items, "gold.items", "order_id", 8, min_hot_rows=min_hot_rows)
    parent = write_bucketed(wh, orders, "gold.orders", "order_id", 8, unique=True)
    totals = {"n": F.count("*"), "s": F.sum("line")}
    found = bucket_totals(parent, child, totals)
    wanted = orders.join(items.groupBy("order_id").agg(*[c.alias(n) for n, c in totals.items()]), "order_id", "left")
    assert rows(found, *wanted.columns) == rows(wanted, *wanted.columns)
    # only the few rows of hot keys are summed over an exchange
    assert len(exchanges(found)) == (1 if child.hashes else 0)


def test_a_new_version_leaves_readers_of_the_old_one(wh, given):
    orders, _ = given
    old = write_bucketed(wh, orders, "gold.orders", "order_id", 4, unique=True)
    new = write_bucketed(wh, old.rows().filter("status = 1"), "gold.orders", "order_id", 4, unique=True)
    assert (old.rows().count(), new.rows().count(), wh.table("gold.orders").count()) == (300, 75, 75)


def test_refused(wh, given):
    orders, items = given
    a = write_bucketed(wh, orders, "gold.orders", "order_id", 4, unique=True)
    b = write_bucketed(wh, items, "gold.items", "order_id", 8)
    with pytest.raises(ValueError, match="same key"):
        bucket_join(b, a)
    with pytest.raises(ValueError, match="cannot join"):
        bucket_join(a, a, "full")
    with pytest.raises(LookupError):
        wh.spark.sql(f"CREATE VIEW {wh.catalog_name('gold.plain')} AS SELECT 1 AS x")
        open_bucketed(wh, "gold.plain")
