"""The quality suites of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import quality as q
from ..schema import ORDER_STATUSES, PAYMENT_TYPES, PURCHASE_WINDOW, SCORE_RANGE, TABLE_KEYS


Entries = list[tuple[str, DataFrame, list]]


def bronze_checks(tables: dict[str, DataFrame]) -> Entries:
    """Every table has rows and complete keys."""
    return [
        (f"bronze.{name}", df, [q.row_count_gt(0), *[q.not_null(k) for k in TABLE_KEYS[name] if k in df.columns]])
        for name, df in tables.items()
    ]


def silver_checks(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, window: tuple[str, str] = PURCHASE_WINDOW,
) -> Entries:
    return [
        ("silver.orders", orders, [
            q.not_null("order_id"), q.Unique(("order_id",)), q.in_set("order_status", ORDER_STATUSES),
            q.in_window("purchase_ts_in_range", "order_purchase_timestamp", *window),
        ]),
        ("silver.order_items", items, [q.Unique(("order_id", "order_item_id")), q.positive("price")]),
        ("silver.order_payments", payments, [q.in_set("payment_type", PAYMENT_TYPES)]),
        ("silver.order_reviews", reviews, [q.between("review_score", *SCORE_RANGE)]),
    ]


def dimension_checks(tables: dict[str, DataFrame]) -> Entries:
    return [(f"gold.{name}", tables[name], [q.not_null(key)]) for name, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"))]


def gold_checks(tables: dict[str, DataFrame], silver_orders: DataFrame) -> Entries:
    """Foreign keys, keys and the row count against silver. ``tables`` holds the
    gold tables by name."""
    t = tables
    return [
        ("gold.fact_order_items", t["fact_order_items"], [
            q.ForeignKey("order_id", t["fact_orders"], "order_id"),
            q.ForeignKey("product_id", t["dim_product"], "product_id"),
            q.ForeignKey("seller_id", t["dim_seller"], "seller_id"),
        ]),
        ("gold.fact_orders", t["fact_orders"], [
            q.ForeignKey("customer_id", t["dim_customer"], "customer_id"),
            q.not_null("order_id"), q.Unique(("order_id",)),
            q.SameCount("rowcount_matches_silver_orders", silver_orders),
        ]),
        ("gold.fact_payments", t["fact_payments"], [
            q.ForeignKey("payment_type_id", t["dim_payment_type"], "payment_type_id")]),
        *dimension_checks(t),
    ]


def bronze(tables: dict[str, DataFrame]) -> DataFrame:
    return q.check_suite("bronze", bronze_checks(tables))


def silver(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, window: tuple[str, str] = PURCHASE_WINDOW,
) -> DataFrame:
    return q.check_suite("silver", silver_checks(orders, items, payments, reviews, window))


def gold(tables: dict[str, DataFrame], silver_orders: DataFrame) -> DataFrame:
    return q.check_suite("gold", gold_checks(tables, silver_orders))
