"""Fixed values of the source data model: tables, types, keys and domains."""

from __future__ import annotations

# --- fixed values: columns and types of the nine source tables ---------------
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
        "source_updated_at": "timestamp_ntz",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "double",
        "freight_value": "double",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "int",
        "customer_city": "string",
        "customer_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "int",
        "product_description_lenght": "int",
        "product_photos_qty": "int",
        "product_weight_g": "int",
        "product_length_cm": "int",
        "product_height_cm": "int",
        "product_width_cm": "int",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "int",
        "seller_city": "string",
        "seller_state": "string",
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "order_reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz",
    },
    "geolocation": {
        "geolocation_id": "bigint",
        "geolocation_zip_code_prefix": "int",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

# --- fixed values: keys the quality suites check -----------------------------
TABLE_KEYS: dict[str, list[str]] = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "category_translation": ["product_category_name"],
}

# --- fixed values: value domains ---------------------------------------------
ORDER_STATUSES = [
    "created", "approved", "invoiced", "processing",
    "shipped", "delivered", "canceled", "unavailable",
]
NON_REVENUE_STATUSES = ["canceled", "unavailable"]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
SCORE_RANGE = (1, 5)
LATITUDE_RANGE = (-35, 6)
LONGITUDE_RANGE = (-75, -34)
PURCHASE_WINDOW = ("2016-01-01", "2019-12-31")
CALENDAR_RANGE = ("2016-01-01", "2019-12-31")
NO_CATEGORY = "unknown"
EPOCH_WATERMARK = "1970-01-01 00:00:00"

# columns that hold one value per load: partitioning by them moves no rows
CONSTANT_PER_LOAD = {"_ingested_at"}

# --- fixed values: how bronze tables load ------------------------------------
LAYERS = ["bronze", "silver", "gold", "platinum", "meta"]
INCREMENTAL = {"orders": ("source_updated_at", "order_purchase_timestamp")}
PARTITIONED_BY = {
    "orders": "months(_part_ts)",
    "order_items": "days(_ingested_at)",
    "order_payments": "days(_ingested_at)",
    "order_reviews": "days(_ingested_at)",
}
