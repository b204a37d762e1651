"""Bronze to silver: cleaned, typed, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import MONEY, calendar_days, clean_text, coerce_columns, in_box
from ..operators.joins import deduped_with_total, lookup
from ..operators.skew import hot_keys
from ..operators.windows import dedupe, latest_version
from ..schema import LATITUDE_RANGE, LONGITUDE_RANGE, NO_CATEGORY, SOURCE_COLUMNS, TABLE_KEYS


def typed(bronze: DataFrame, table: str) -> DataFrame:
    """Clean text, then cast the columns that are not yet of their type."""
    cleaned = clean_text(bronze)
    have = dict(cleaned.dtypes)
    wanted = {c: t for c, t in SOURCE_COLUMNS[table].items() if c in have and have[c] != t and t != "string"}
    return coerce_columns(cleaned, wanted) if wanted else cleaned


def orders(bronze: DataFrame) -> DataFrame:
    """Current state of each order from the version history."""
    known = typed(bronze, "orders").filter(F.col("order_id").isNotNull())
    newest_by = [c for c in ("source_updated_at", "_ingested_at") if c in known.columns]
    days = calendar_days("order_purchase_timestamp", "order_delivered_customer_date")
    return latest_version(known, ["order_id"], newest_by).withColumn("order_duration_days", days)


def order_items(bronze: DataFrame) -> DataFrame:
    return dedupe(typed(bronze, "order_items"), TABLE_KEYS["order_items"])


def order_items_together(bronze: DataFrame) -> DataFrame:
    """The same for a stored table: items of an order stay together in its files, where
    later aggregates by order combine them before they move. An order that holds much
    of the rows keeps them apart."""
    rows = typed(bronze, "order_items")
    return order_items(bronze) if hot_keys(rows, ["order_id"]) else dedupe(rows, TABLE_KEYS["order_items"], within=["order_id"])


def customers(bronze: DataFrame) -> DataFrame:
    upper = typed(bronze, "customers").withColumn("customer_state", F.upper("customer_state"))
    return dedupe(upper, TABLE_KEYS["customers"])


def products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category, 'unknown' when there is none."""
    named = lookup(
        dedupe(typed(bronze, "products"), TABLE_KEYS["products"]), clean_text(translation),
        "product_category_name", "product_category_name_english", NO_CATEGORY,
    )
    return named


def sellers(bronze: DataFrame) -> DataFrame:
    upper = typed(bronze, "sellers").withColumn("seller_state", F.upper("seller_state"))
    return dedupe(upper, TABLE_KEYS["sellers"])


def order_payments(bronze: DataFrame) -> DataFrame:
    """Payments with the total of their order. The total counts every bronze
    row, also those the deduplication drops."""
    name = "total_payment_value"
    kept = deduped_with_total(
        typed(bronze, "order_payments"), TABLE_KEYS["order_payments"], ["order_id"], F.sum(F.col("payment_value").cast(MONEY)), name)
    return kept.withColumn(name, F.col(name).cast("double"))


def order_reviews(bronze: DataFrame) -> DataFrame:
    return dedupe(typed(bronze, "order_reviews"), TABLE_KEYS["order_reviews"])


def geolocation(bronze: DataFrame) -> DataFrame:
    inside = in_box("geolocation_lat", "geolocation_lng", LATITUDE_RANGE, LONGITUDE_RANGE)
    return dedupe(typed(bronze, "geolocation").filter(inside), TABLE_KEYS["geolocation"])


# silver table -> (function, bronze inputs)
TABLES = {
    "orders": (orders, ["orders"]),
    "order_items": (order_items, ["order_items"]),
    "customers": (customers, ["customers"]),
    "products": (products, ["products", "category_translation"]),
    "sellers": (sellers, ["sellers"]),
    "order_payments": (order_payments, ["order_payments"]),
    "order_reviews": (order_reviews, ["order_reviews"]),
    "geolocation": (geolocation, ["geolocation"]),
}
# the same as they are stored
STORED = {**TABLES, "order_items": (order_items_together, ["order_items"])}
