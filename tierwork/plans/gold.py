"""Silver to gold: star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import MONEY, calendar_days, date_key, is_late, is_weekend
from ..operators.joins import attach_key, with_child_totals
from ..operators.windows import dedupe, ordered_surrogate
from ..schema import CALENDAR_RANGE
from ..sinks.bucketed import Bucketed, bucket_totals


def dim_customer(customers: DataFrame) -> DataFrame:
    return dedupe(customers, ["customer_id"]).select(
        "customer_id", "customer_unique_id",
        F.col("customer_city").alias("city"), F.col("customer_state").alias("state"),
        F.col("customer_zip_code_prefix").alias("zip_code"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", F.col("product_category_name").alias("category_name"),
        F.col("product_category_name_english").alias("category_name_english"),
        *[F.col(f"product_{c}").alias(c) for c in ("weight_g", "length_cm", "height_cm", "width_cm")],
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", *[
        F.col(f"seller_{c}").alias(name)
        for c, name in (("city", "city"), ("state", "state"), ("zip_code_prefix", "zip_code"))
    ])


def calendar(bounds: DataFrame) -> DataFrame:
    """Calendar rows for a one-row frame with dates ``first_day`` and ``last_day``."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_id"), "full_date",
        F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"), F.dayofmonth("full_date").alias("day"),
        F.dayofweek("full_date").alias("day_of_week"), is_weekend("full_date").alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first_day: str = CALENDAR_RANGE[0], last_day: str = CALENDAR_RANGE[1]) -> DataFrame:
    """Calendar with fixed bounds, independent of the data."""
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day"))
    return calendar(bounds)


def dim_date_for(df: DataFrame, ts: str) -> DataFrame:
    """Calendar that covers the times of a table."""
    return calendar(df.agg(F.min(ts).cast("date").alias("first_day"), F.max(ts).cast("date").alias("last_day")))


def dim_payment_type(payments: DataFrame) -> DataFrame:
    return ordered_surrogate(payments, "payment_type", "payment_type_id").withColumn("payment_type_id", F.col("payment_type_id").cast("int"))


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast(MONEY)).cast("double")


def item_totals() -> dict[str, Column]:
    return {"total_items": F.count("*"), "total_revenue": _total("price"), "freight_total": _total("freight_value")}


def fact_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order; items are aggregated before the join."""
    return _order_facts(with_child_totals(orders, items, ["order_id"], item_totals(), hot=[]))


def fact_orders_of_buckets(orders: Bucketed, items: Bucketed) -> DataFrame:
    """The same from tables bucketed by order: neither side is shuffled."""
    return _order_facts(bucket_totals(orders, items, item_totals()))


def _order_facts(joined: DataFrame) -> DataFrame:
    bought, arrived = "order_purchase_timestamp", "order_delivered_customer_date"
    return joined.select(
        "order_id", "customer_id", "order_status",
        date_key(bought).alias("purchase_date_id"), date_key(arrived).alias("delivered_date_id"),
        *[F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c)
          for c, t in (("total_items", "bigint"), ("total_revenue", "double"), ("freight_total", "double"))],
        "order_duration_days", calendar_days(bought, arrived).alias("delivery_days"),
        is_late(arrived, "order_estimated_delivery_date").alias("is_late_delivery"),
    )


def fact_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", F.lit(1).alias("quantity"))


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", "order_id", date_key("review_creation_date").alias("review_date_id"),
        "review_score", F.col("review_comment_message").isNotNull().alias("has_comment"),
    )


def fact_payments(payments: DataFrame, payment_types: DataFrame) -> DataFrame:
    return attach_key(payments, payment_types, "payment_type", "payment_type_id").select(
        "order_id", "payment_sequential", "payment_type_id", "payment_type", "payment_installments", "payment_value")
