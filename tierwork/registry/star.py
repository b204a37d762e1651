"""Silver, gold and platinum tables over the given data."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.skew import hot_keys
from ..plans import gold, marts, pipeline, silver
from ..sinks.bucketed import write_bucketed
from . import roles
from .base import SQL, Tables, query
from .roles import table_sql, with_ctes


# ---- tables by layer, shared by the queries below --------------------------------

def _silver_orders(t: Tables) -> DataFrame:
    return silver.orders(roles.bronze_orders(t))


def _silver_items(t: Tables) -> DataFrame:
    return silver.order_items(roles.order_items(t))


def _silver_products(t: Tables) -> DataFrame:
    return silver.products(roles.products(t), roles.translation(t))


def _fact_orders(t: Tables) -> DataFrame:
    return gold.fact_orders(_silver_orders(t), _silver_items(t))


def _dim_customer(t: Tables) -> DataFrame:
    return gold.dim_customer(silver.customers(roles.customers(t)))


def _dim_product(t: Tables) -> DataFrame:
    return gold.dim_product(_silver_products(t))


def _dim_payment_type(t: Tables) -> DataFrame:
    # deduplication by (order, sequence) cannot add a type, and the surrogate
    # only needs the distinct types of what remains
    return gold.dim_payment_type(silver.order_payments(roles.payments(t)))


# ---- silver ------------------------------------------------------------------------

@query(table_sql("silver_orders"))
def silver_orders(t: Tables) -> DataFrame:
    return _silver_orders(t)


@query(table_sql("silver_items"))
def silver_items(t: Tables) -> DataFrame:
    return _silver_items(t)


@query(table_sql("silver_customers"))
def silver_customers(t: Tables) -> DataFrame:
    return silver.customers(roles.customers(t))


@query(table_sql("silver_products"))
def silver_products(t: Tables) -> DataFrame:
    return _silver_products(t)


@query(table_sql("silver_sellers"))
def silver_sellers(t: Tables) -> DataFrame:
    return silver.sellers(roles.sellers(t))


@query(table_sql("silver_payments"))
def silver_payments(t: Tables) -> DataFrame:
    return silver.order_payments(roles.payments(t))


@query(table_sql("silver_reviews"))
def silver_reviews(t: Tables) -> DataFrame:
    return silver.order_reviews(roles.reviews(t))


@query(roles.first_row(
    """(SELECT c_custkey AS geolocation_id, c_nationkey AS geolocation_zip_code_prefix,
               c_acctbal / 200 - 40 AS geolocation_lat, -80.0::DOUBLE + c_custkey % 60 AS geolocation_lng,
               c_mktsegment AS geolocation_city FROM customer
        WHERE c_acctbal / 200 - 40 BETWEEN -35 AND 6 AND -80.0::DOUBLE + c_custkey % 60 BETWEEN -75 AND -34)""",
    "geolocation_zip_code_prefix", "geolocation_id"))
def silver_geo(t: Tables) -> DataFrame:
    return silver.geolocation(roles.geolocation(t))


# ---- gold --------------------------------------------------------------------------

@query(table_sql("dim_customer"))
def dim_customer(t: Tables) -> DataFrame:
    return _dim_customer(t)


@query(table_sql("dim_product"))
def dim_product(t: Tables) -> DataFrame:
    return _dim_product(t)


@query(table_sql("dim_seller"))
def dim_seller(t: Tables) -> DataFrame:
    return gold.dim_seller(silver.sellers(roles.sellers(t)))


@query(table_sql("dim_date"))
def dim_date(t: Tables) -> DataFrame:
    return gold.dim_date_for(t.orders, "o_orderdate")


@query(table_sql("dim_payment_type"))
def dim_payment_type(t: Tables) -> DataFrame:
    return _dim_payment_type(t)


@query(table_sql("fact_orders"))
def fact_orders(t: Tables) -> DataFrame:
    return _fact_orders(t)


@query(table_sql("fact_order_items"))
def fact_order_items(t: Tables) -> DataFrame:
    return gold.fact_order_items(_silver_items(t))


@query(table_sql("fact_reviews"))
def fact_reviews(t: Tables) -> DataFrame:
    return gold.fact_reviews(silver.order_reviews(roles.reviews(t)))


@query(table_sql("fact_payments"))
def fact_payments(t: Tables) -> DataFrame:
    payments = silver.order_payments(roles.payments(t))
    return gold.fact_payments(payments, gold.dim_payment_type(payments))


# ---- platinum ----------------------------------------------------------------------

MONTHLY = with_ctes("""
    SELECT CAST(year AS INT) AS year, month, CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           count(DISTINCT order_id) AS order_count
    FROM fact_orders JOIN dim_date ON date_id = purchase_date_id
    WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY 1, 2""", "fact_orders", "dim_date")


@query(MONTHLY)
def mart_monthly_revenue(t: Tables) -> DataFrame:
    return marts.monthly_revenue(_fact_orders(t), gold.dim_date_for(t.orders, "o_orderdate"), orders_unique=True)


@query(with_ctes("""
    SELECT state, count(DISTINCT order_id) AS order_count,
           CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           CAST(round(CAST(CAST(avg(delivery_days) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_delivery_days
    FROM fact_orders JOIN dim_customer USING (customer_id)
    WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY 1""", "fact_orders", "dim_customer"))
def mart_state_performance(t: Tables) -> DataFrame:
    return marts.state_performance(_fact_orders(t), _dim_customer(t), orders_unique=True)


@query(with_ctes("""
    SELECT category_name_english, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           count(*) AS items_sold
    FROM fact_order_items
    JOIN (SELECT order_id FROM fact_orders WHERE order_status NOT IN ('canceled', 'unavailable')) USING (order_id)
    JOIN dim_product USING (product_id) GROUP BY 1""", "fact_orders", "fact_order_items", "dim_product"))
def mart_category_ranking(t: Tables) -> DataFrame:
    # only the status of an order is needed: the order table without its items
    hot = hot_keys(roles.order_items(t), ["order_id"])
    return marts.category_ranking(gold.fact_order_items(_silver_items(t)), _silver_orders(t), _dim_product(t), hot)


@query(with_ctes("""
    SELECT count(*) AS total_orders, CAST(round(CAST(CAST(avg(delivery_days) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_delivery_days,
           CAST(round(CAST(CAST(sum(CASE WHEN (order_status = 'delivered' OR delivery_days IS NOT NULL) AND is_late_delivery THEN 1 ELSE 0 END)
                 / sum(CASE WHEN order_status = 'delivered' OR delivery_days IS NOT NULL THEN 1 ELSE 0 END) * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)
           AS late_delivery_rate_pct
    FROM fact_orders""", "fact_orders"))
def mart_delivery_kpi(t: Tables) -> DataFrame:
    return marts.delivery_kpi(_fact_orders(t))


@query(with_ctes("""
    , per_category AS (SELECT order_id, category_name_english, count(*) AS n
                       FROM fact_order_items JOIN dim_product USING (product_id) GROUP BY 1, 2),
    order_category AS (SELECT order_id, category_name_english FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY n DESC, category_name_english) AS rn FROM per_category)
        WHERE rn = 1)
    SELECT category_name_english, CAST(round(CAST(CAST(avg(review_score) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_review_score,
           count(DISTINCT review_id) AS review_count
    FROM fact_reviews JOIN order_category USING (order_id) GROUP BY 1""",
    "fact_reviews", "fact_order_items", "dim_product"))
def mart_review_by_category(t: Tables) -> DataFrame:
    return marts.review_by_category(
        gold.fact_reviews(silver.order_reviews(roles.reviews(t))), gold.fact_order_items(_silver_items(t)),
        _dim_product(t), reviews_unique=True)


@query(with_ctes("""
    SELECT payment_type, count(*) AS payment_count,
           CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM fact_payments GROUP BY 1""", "fact_payments"))
def mart_payment_distribution(t: Tables) -> DataFrame:
    # the mart groups by the natural type, so the surrogate is not attached here
    return marts.payment_distribution(silver.order_payments(roles.payments(t)))


@query(with_ctes("""
    , per_person AS (SELECT customer_unique_id, count(DISTINCT order_id) AS n
                     FROM fact_orders JOIN dim_customer USING (customer_id) GROUP BY 1)
    SELECT count(*) AS total_customers, CAST(sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_customers,
           CAST(round(CAST(CAST(sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END) / count(*) * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS retention_rate_pct
    FROM per_person""", "fact_orders", "dim_customer"))
def mart_customer_retention(t: Tables) -> DataFrame:
    return marts.customer_retention(_fact_orders(t), _dim_customer(t), orders_unique=True)


BUCKETS = 16


@query(SQL["fact_orders"])
def fact_orders_bucketed(t: Tables) -> DataFrame:
    """Orders and items stored in buckets of the order, then joined bucket by bucket."""
    wh = t.warehouse("buckets")
    orders = write_bucketed(wh, _silver_orders(t), "silver.orders", "order_id", BUCKETS, unique=True)
    return gold.fact_orders_of_buckets(orders, write_bucketed(wh, _silver_items(t), "silver.order_items", "order_id", BUCKETS))


@query(SQL["mart_category_ranking"])
def mart_category_ranking_bucketed(t: Tables) -> DataFrame:
    wh = t.warehouse("buckets")
    orders = write_bucketed(wh, _silver_orders(t), "gold.fact_orders", "order_id", BUCKETS, unique=True)
    items = write_bucketed(wh, gold.fact_order_items(_silver_items(t)), "gold.fact_order_items", "order_id", BUCKETS)
    return marts.category_ranking_of_buckets(items, orders, _dim_product(t))


# mart -> a whole-number column and one with two decimals, whose sums are compared
_CHECKED = {
    "mart_monthly_revenue": ("order_count", "revenue"), "mart_state_performance": ("order_count", "revenue"),
    "mart_category_ranking": ("items_sold", "revenue"), "mart_delivery_kpi": ("total_orders", "late_delivery_rate_pct"),
    "mart_review_by_category": ("review_count", "avg_review_score"), "mart_payment_distribution": ("payment_count", "total_value"),
    "mart_customer_retention": ("total_customers", "retention_rate_pct"),
}


@query("\n    UNION ALL ".join(
    f"SELECT '{mart}' AS mart, count(*) AS n_rows, CAST(sum({column}) AS BIGINT) AS total, "
    f"CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM ({SQL[mart]}) AS m" for mart, (column, amount) in _CHECKED.items()))
def layered_run(t: Tables) -> DataFrame:
    """All layers as stored tables, with their gates; one row about each mart."""
    span = t.orders.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    wh = t.warehouse("run")
    pipeline.run_all(
        wh, lambda table: roles.SOURCES[table](t), datetime(2024, 2, 1), calendar=(str(span[0]), str(span[1])))
    return reduce(DataFrame.unionByName, [
        wh.table(f"platinum.{mart}").agg(
            F.count("*").alias("n_rows"), F.sum(column).cast("bigint").alias("total"), F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("amount"),
        ).select(F.lit(mart).alias("mart"), "*")
        for mart, (column, amount) in _CHECKED.items()])


def _twice(df: DataFrame) -> DataFrame:
    """Every row twice, so that no id is unique any more."""
    return df.unionByName(df)


@query(SQL["mart_customer_retention"])
def mart_retention_of_repeated_orders(t: Tables) -> DataFrame:
    """Orders that repeat count once where the key is not known to be unique."""
    return marts.customer_retention(_twice(_fact_orders(t)), _dim_customer(t))


@query(with_ctes("""
    SELECT CAST(year AS INT) AS year, month, CAST(sum(2 * CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           count(DISTINCT order_id) AS order_count
    FROM fact_orders JOIN dim_date ON date_id = purchase_date_id
    WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY 1, 2""", "fact_orders", "dim_date"))
def mart_monthly_of_repeated_orders(t: Tables) -> DataFrame:
    return marts.monthly_revenue(_twice(_fact_orders(t)), gold.dim_date_for(t.orders, "o_orderdate"))


@query(with_ctes("""
    SELECT state, count(DISTINCT order_id) AS order_count,
           CAST(sum(2 * CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           CAST(round(CAST(CAST(avg(delivery_days) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_delivery_days
    FROM fact_orders JOIN dim_customer USING (customer_id)
    WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY 1""", "fact_orders", "dim_customer"))
def mart_state_of_repeated_orders(t: Tables) -> DataFrame:
    return marts.state_performance(_twice(_fact_orders(t)), _dim_customer(t))


@query(SQL["mart_monthly_of_repeated_orders"])
def mart_monthly_by_bitmaps(t: Tables) -> DataFrame:
    """The given order ids are whole numbers already."""
    return marts.monthly_revenue(_twice(_fact_orders(t)), gold.dim_date_for(t.orders, "o_orderdate"), order_number="order_id")


@query(SQL["mart_state_of_repeated_orders"])
def mart_state_by_bitmaps(t: Tables) -> DataFrame:
    return marts.state_performance(_twice(_fact_orders(t)), _dim_customer(t), order_number="order_id")


@query(SQL["mart_review_by_category"])
def mart_review_of_repeated_reviews(t: Tables) -> DataFrame:
    return marts.review_by_category(
        _twice(gold.fact_reviews(silver.order_reviews(roles.reviews(t)))), gold.fact_order_items(_silver_items(t)), _dim_product(t))
