"""Gold to platinum: business marts.

Facts are aggregated by the foreign key before they meet a dimension. The join
then carries one row per key, a hot key included, and needs no extra shuffle:
the aggregate already left its rows partitioned by that key.

Where order ids repeat, ``order_number`` names a column with a whole number for each
order: distinct orders are then counted by bitmaps. Their rows move once, to the tasks
of neighbouring numbers.

``orders_unique`` states that ``order_id`` is unique in the fact (the gold suite
checks it). Counting rows then replaces the exact distinct count, which would
shuffle every order id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import MONEY, as_amount, exact_sum, not_in, percent, reached
from ..operators.distinct import bitmap_counts, gathered, id_bitmaps
from ..operators.joins import keep_known
from ..operators.profiles import repeat_rate
from ..operators.skew import HotKey, fits_broadcast, hot_keys, sized_join, split_join
from ..operators.windows import dominant_value
from ..schema import NON_REVENUE_STATUSES
from ..sinks.bucketed import Bucketed, bucket_join


def revenue_orders(fact_orders: DataFrame) -> DataFrame:
    """Orders that count as revenue. A NULL status does not."""
    return fact_orders.filter(not_in("order_status", NON_REVENUE_STATUSES))


def _per_order_rows(fact: DataFrame, keys: list[str], unique: bool, **sums: Column) -> DataFrame:
    """Aggregate a fact by foreign key; with repeated order ids the id stays in
    the grain, so that a later distinct count is still exact."""
    grain = keys if unique else [*keys, "order_id"]
    return fact.groupBy(*grain).agg(F.count("order_id").alias("_orders"), *[c.alias(n) for n, c in sums.items()])


def _orders_in(unique: bool) -> Column:
    return F.sum("_orders") if unique else F.countDistinct("order_id")


def _to_dimension(per_key: DataFrame, fact: DataFrame, dim: DataFrame, key: str, unique: bool) -> DataFrame:
    """Inner join of an aggregated fact with its dimension. When order ids stay
    in the grain a hot key is still many rows, so it is split."""
    return split_join(per_key, dim, [key], "inner", [] if unique else hot_keys(fact, [key]))


def monthly_revenue(fact_orders: DataFrame, dim_date: DataFrame, orders_unique: bool = False, order_number: str | None = None) -> DataFrame:
    """Revenue and orders per month; dates outside the calendar are dropped."""
    if order_number and not orders_unique:
        # a day has few orders of a bucket, so the month is attached to the rows before ids become bits
        sold = revenue_orders(fact_orders).select("purchase_date_id", order_number, "total_revenue")
        dated = sized_join(sold, dim_date.select(F.col("date_id").alias("purchase_date_id"), "year", "month"), ["purchase_date_id"], "inner")
        monthly = id_bitmaps(gathered(dated.drop("purchase_date_id"), order_number), ["year", "month"], order_number, {"_revenue": exact_sum("total_revenue")})
        return bitmap_counts(monthly, ["year", "month"], "order_count", ["_revenue"]).select(
            "year", "month", as_amount("_revenue").alias("revenue"), "order_count").orderBy("year", "month")
    daily = _per_order_rows(
        revenue_orders(fact_orders), ["purchase_date_id"], orders_unique, _revenue=exact_sum("total_revenue"))
    days = dim_date.select(F.col("date_id").alias("purchase_date_id"), "year", "month")
    return (
        _to_dimension(daily, fact_orders, days, "purchase_date_id", orders_unique).groupBy("year", "month")
        .agg(as_amount(F.sum("_revenue")).alias("revenue"), _orders_in(orders_unique).alias("order_count"))
        .orderBy("year", "month")
    )


def state_performance(
    fact_orders: DataFrame, dim_customer: DataFrame, orders_unique: bool = False, order_number: str | None = None,
) -> DataFrame:
    if order_number and not orders_unique:
        # a customer has few orders, so the state is attached to the rows before ids become bits
        sold = revenue_orders(fact_orders).select("customer_id", order_number, "total_revenue", "delivery_days")
        placed = split_join(sold, dim_customer.select("customer_id", "state"), ["customer_id"], "inner", hot_keys(fact_orders, ["customer_id"]))
        parts = id_bitmaps(gathered(placed.drop("customer_id"), order_number), ["state"], order_number, {
            "_revenue": exact_sum("total_revenue"), "_days": F.sum("delivery_days"), "_delivered": F.count("delivery_days")})
        return bitmap_counts(parts, ["state"], "order_count", ["_revenue", "_days", "_delivered"]).select(
            "state", "order_count", as_amount("_revenue").alias("revenue"), F.round(F.try_divide("_days", "_delivered"), 2).alias("avg_delivery_days")
        ).orderBy(F.desc("order_count"), "state")
    per_customer = _per_order_rows(
        revenue_orders(fact_orders), ["customer_id"], orders_unique, _revenue=exact_sum("total_revenue"),
        _days=F.sum("delivery_days"), _delivered=F.count("delivery_days"),
    )
    placed = _to_dimension(
        per_customer, fact_orders, dim_customer.select("customer_id", "state"), "customer_id", orders_unique)
    return (
        placed.groupBy("state")
        .agg(
            _orders_in(orders_unique).alias("order_count"), as_amount(F.sum("_revenue")).alias("revenue"),
            F.round(F.try_divide(F.sum("_days"), F.sum("_delivered")), 2).alias("avg_delivery_days"),
        )
        .orderBy(F.desc("order_count"), "state")
    )


def category_ranking(
    fact_items: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, hot_orders: list[HotKey] | None = None,
) -> DataFrame:
    """Revenue and items sold per category, over items of revenue orders."""
    return _ranked(keep_known(fact_items, revenue_orders(fact_orders), ["order_id"], hot_orders), dim_product)


def category_ranking_of_buckets(fact_items: Bucketed, fact_orders: Bucketed, dim_product: DataFrame) -> DataFrame:
    """The same from facts bucketed by order: items meet their orders without a shuffle."""
    return _ranked(bucket_join(fact_items, fact_orders, "left_semi", [], not_in("order_status", NON_REVENUE_STATUSES)), dim_product)


def _ranked(sold: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = sold.groupBy("product_id").agg(exact_sum("price").alias("_revenue"), F.count("*").alias("_items"))
    return (
        per_product.join(dim_product.select("product_id", "category_name_english"), "product_id")
        .groupBy("category_name_english")
        .agg(as_amount(F.sum("_revenue")).alias("revenue"), F.sum("_items").alias("items_sold"))
        .orderBy(F.desc("revenue"), "category_name_english")
    )


def delivery_kpi(fact_orders: DataFrame) -> DataFrame:
    """One row; the late rate is over delivered orders only."""
    delivered = reached("order_status", "delivered", "delivery_days")
    counts = fact_orders.agg(
        F.count("*").alias("total_orders"), F.round(F.avg("delivery_days"), 2).alias("avg_delivery_days"),
        F.count_if(delivered).alias("_delivered"), F.count_if(delivered & F.col("is_late_delivery")).alias("_late"),
    )
    return counts.select("total_orders", "avg_delivery_days", percent("_late", "_delivered").alias("late_delivery_rate_pct"))


def order_category(
    fact_items: DataFrame, dim_product: DataFrame, hot_products: list[HotKey] | None = None, hot_orders: list[HotKey] | None = None,
) -> DataFrame:
    """The dominant category of each order. A dimension that measures small is
    broadcast to the items, which then move twice: by (order, category) and by
    order. Otherwise items move once more, to meet it, with hot products split. An empty
    list of ``hot_orders`` says that no order holds much of the items; they then move
    once, by order."""
    hot_order = hot_orders is None or bool(hot_orders)
    categories = dim_product.select("product_id", "category_name_english")
    if hot_products is None and fits_broadcast(categories):
        return dominant_value(fact_items.join(F.broadcast(categories), "product_id"), ["order_id"], "category_name_english", hot=hot_order)
    hot = hot_keys(fact_items, ["product_id"], other=dim_product) if hot_products is None else hot_products
    categorised = split_join(fact_items.select("order_id", "product_id"), categories, ["product_id"], "inner", hot)
    return dominant_value(categorised, ["order_id"], "category_name_english", hot=hot_order)


def review_by_category(
    fact_reviews: DataFrame, fact_items: DataFrame, dim_product: DataFrame, reviews_unique: bool = False,
    hot_products: list[HotKey] | None = None, hot_orders: list[HotKey] | None = None, hot_item_orders: list[HotKey] | None = None,
) -> DataFrame:
    """Reviews per category. An order with items of several categories counts
    for one of them only, so a review is never multiplied.

    With unique review ids the reviews collapse to one row per order before the
    join. Otherwise the id stays in the grain for the distinct count, and orders
    with very many reviews are split. ``hot_orders`` are those of the reviews,
    ``hot_item_orders`` those of the items.
    """
    score = [F.sum("review_score").alias("_score"), F.count("review_score").alias("_scored")]
    categories = order_category(fact_items, dim_product, hot_products, hot_item_orders)
    if reviews_unique:
        per_order = fact_reviews.groupBy("order_id").agg(*score, F.count("review_id").alias("_reviews"))
        joined, reviews = per_order.join(categories, "order_id"), F.sum("_reviews")
    else:
        hot = hot_keys(fact_reviews, ["order_id"]) if hot_orders is None else hot_orders
        per_review = fact_reviews.groupBy("order_id", "review_id").agg(*score)
        joined, reviews = split_join(per_review, categories, ["order_id"], "inner", hot), F.countDistinct("review_id")
    return (
        joined.groupBy("category_name_english")
        .agg(
            F.round(F.try_divide(F.sum("_score"), F.sum("_scored")), 2).alias("avg_review_score"),
            reviews.alias("review_count"),
        )
        .orderBy(F.desc("avg_review_score"), "category_name_english")
    )


def payment_distribution(fact_payments: DataFrame) -> DataFrame:
    return (
        fact_payments.groupBy("payment_type")
        .agg(F.count("*").alias("payment_count"), as_amount(F.sum(F.col("payment_value").cast(MONEY))).alias("total_value"))
        .orderBy(F.desc("payment_count"), "payment_type")
    )


def customer_retention(fact_orders: DataFrame, dim_customer: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Persons and repeat persons, over orders of every status."""
    per_customer = _per_order_rows(fact_orders, ["customer_id"], orders_unique)
    people = dim_customer.select("customer_id", "customer_unique_id")
    per_person = (
        _to_dimension(per_customer, fact_orders, people, "customer_id", orders_unique)
        .groupBy("customer_unique_id").agg(_orders_in(orders_unique).alias("order_count"))
    )
    return repeat_rate(per_person, "order_count", ("total_customers", "repeat_customers", "retention_rate_pct"))
