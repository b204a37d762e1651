"""The given tables in the roles of the source tables, and the same in SQL.

Some columns get padding, blanks or repeats on purpose, so that cleaning and
deduplication have work to do on every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.changelog import change_log
from .base import Tables


def source_orders(t: Tables) -> DataFrame:
    """Orders in their final state; delivered = last shipment of a finished order."""
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("_shipped"))
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
    return t.orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        status.otherwise("canceled").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") == "F", F.col("_shipped")).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("interval 90 days")).alias("order_estimated_delivery_date"),
        F.col("o_orderdate").alias("source_updated_at"),
    )


def bronze_orders(t: Tables) -> DataFrame:
    """The version history of the orders."""
    return change_log(source_orders(t))


def order_items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("freight_value"),
    )


def customers(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(nations, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"), F.expr("c_custkey div 2").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("customer_city"),
        F.lower("n_name").alias("customer_state"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") == 50, "   ").otherwise(F.concat(F.lit(" "), "p_type")).alias("product_category_name"),
        F.col("p_size").alias("product_weight_g"), (F.col("p_size") + 1).alias("product_length_cm"),
        (F.col("p_size") + 2).alias("product_height_cm"), (F.col("p_size") + 3).alias("product_width_cm"),
    )


def translation(t: Tables) -> DataFrame:
    """English names for every part type but one; each type occurs many times."""
    return t.part.filter(F.col("p_type") != "ECONOMY").select(
        F.col("p_type").alias("product_category_name"),
        F.concat(F.lit("cat_"), F.lower("p_type")).alias("product_category_name_english"),
    )


def sellers(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return t.supplier.join(nations, "s_nationkey").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.concat("s_name", F.lit("  ")).alias("seller_city"), F.lower("n_name").alias("seller_state"),
    )


def payments(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "credit_card").when(F.col("l_returnflag") == "N", "boleto")
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("payment_sequential"),
        kind.otherwise(" voucher ").alias("payment_type"), F.col("l_quantity").cast("int").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def reviews(t: Tables) -> DataFrame:
    """Every two events share a review id, so deduplication keeps one of them."""
    message = F.when(F.col("event_type") == "error", "  ").otherwise(F.col("props"))
    return t.events.select(
        F.expr("event_id div 2").alias("review_id"), F.col("event_id").alias("order_id"),
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("review_score"),
        message.alias("review_comment_message"), F.col("ts").alias("review_creation_date"),
    )


def geolocation(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("geolocation_id"), F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 200 - 40).alias("geolocation_lat"),
        (F.lit(-80.0) + F.col("c_custkey") % 60).alias("geolocation_lng"),
        F.concat("c_mktsegment", F.lit(" ")).alias("geolocation_city"),
    )


# source table -> its rows
SOURCES = {
    "orders": bronze_orders, "order_items": order_items, "customers": customers, "products": products, "sellers": sellers,
    "order_payments": payments, "order_reviews": reviews, "geolocation": geolocation, "category_translation": translation,
}


def batched_events(t: Tables) -> DataFrame:
    """Events as an append table: one batch per day of the month."""
    return t.events.select(
        "*", F.dayofmonth("ts").alias("batch_id"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("committed_at"))


# ---- the same in SQL ------------------------------------------------------------
#
# Spark rounds the shortest decimal text of a double half up. DuckDB rounds its
# binary value, so 730.125 and 10.075 could go either way; the SQL therefore
# rounds through text: round(CAST(CAST(x AS VARCHAR) AS DECIMAL(38,18)), 2).

def first_row(source: str, keys: str, order: str) -> str:
    """One row of ``source`` per key, by a total order."""
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source}) WHERE rn = 1"
    )


def nulls_first(*columns: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def key_of(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INT)"


ITEM_ORDER = nulls_first("product_id", "seller_id", "shipping_limit_date", "price", "freight_value")

CTES: dict[str, str] = {
    "src_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderstatus = 'F' THEN shipped END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 90 DAY AS order_estimated_delivery_date,
               o_orderdate AS source_updated_at
        FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
             ON l_orderkey = o_orderkey""",
    "two_steps": """
        SELECT * FROM src_orders WHERE order_status = 'delivered'
        AND date_trunc('month', order_delivered_customer_date) > date_trunc('month', order_purchase_timestamp)""",
    "bronze_orders": """
        SELECT order_id, customer_id, 'shipped' AS order_status, order_purchase_timestamp,
               CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date, order_estimated_delivery_date,
               order_purchase_timestamp AS source_updated_at FROM two_steps
        UNION ALL SELECT * REPLACE (order_delivered_customer_date AS source_updated_at) FROM two_steps
        UNION ALL SELECT * REPLACE (order_purchase_timestamp AS source_updated_at) FROM src_orders
                  WHERE order_id NOT IN (SELECT order_id FROM two_steps)""",
    "src_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_quantity AS freight_value FROM lineitem""",
    "src_products": """
        SELECT p_partkey AS product_id, CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS product_category_name,
               p_size AS product_weight_g, p_size + 1 AS product_length_cm, p_size + 2 AS product_height_cm,
               p_size + 3 AS product_width_cm FROM part""",
    "src_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
               CAST(l_quantity AS INT) AS payment_installments, l_extendedprice AS payment_value FROM lineitem""",
    "src_reviews": """
        SELECT event_id // 2 AS review_id, event_id AS order_id, CAST(1 + event_id % 5 AS INT) AS review_score,
               CASE WHEN event_type = 'error' THEN NULL ELSE props END AS review_comment_message,
               ts AS review_creation_date FROM events""",
    "silver_orders": f"""
        SELECT * EXCLUDE (rn), CAST(date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS INT)
               AS order_duration_days
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_updated_at DESC NULLS LAST,
              {nulls_first('customer_id', 'order_status', 'order_purchase_timestamp',
                           'order_delivered_customer_date', 'order_estimated_delivery_date')}) AS rn
              FROM bronze_orders WHERE order_id IS NOT NULL) WHERE rn = 1""",
    "silver_items": first_row("src_items", "order_id, order_item_id", ITEM_ORDER),
    "silver_customers": """
        SELECT c_custkey AS customer_id, c_custkey // 2 AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, upper(n_name) AS customer_state
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "silver_products": """
        SELECT product_category_name, product_id, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
               CASE WHEN product_category_name IS NULL OR product_category_name = 'ECONOMY' THEN 'unknown'
                    ELSE 'cat_' || lower(product_category_name) END AS product_category_name_english
        FROM src_products""",
    "silver_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city,
               upper(n_name) AS seller_state FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "payment_totals": f"SELECT order_id, {money('payment_value')} AS total_payment_value FROM src_payments GROUP BY 1",
    "silver_payments": first_row(
        "(SELECT p.*, total_payment_value FROM src_payments p LEFT JOIN payment_totals USING (order_id))",
        "order_id, payment_sequential", nulls_first("payment_type", "payment_installments", "payment_value")),
    "silver_reviews": first_row(
        "src_reviews", "review_id", nulls_first("order_id", "review_score", "review_comment_message", "review_creation_date")),
    "dim_customer": """
        SELECT customer_id, customer_unique_id, customer_city AS city, customer_state AS state,
               customer_zip_code_prefix AS zip_code FROM silver_customers""",
    "dim_product": """
        SELECT product_id, product_category_name AS category_name, product_category_name_english AS category_name_english,
               product_weight_g AS weight_g, product_length_cm AS length_cm, product_height_cm AS height_cm,
               product_width_cm AS width_cm FROM silver_products""",
    "dim_seller": """
        SELECT seller_id, seller_city AS city, seller_state AS state, seller_zip_code_prefix AS zip_code
        FROM silver_sellers""",
    "dim_date": f"""
        SELECT {key_of('full_date')} AS date_id, full_date, CAST(year(full_date) AS INT) AS year,
               CAST(quarter(full_date) AS INT) AS quarter, CAST(month(full_date) AS INT) AS month,
               CAST(day(full_date) AS INT) AS day, CAST(dayofweek(full_date) + 1 AS INT) AS day_of_week,
               dayofweek(full_date) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS full_date
              FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders))""",
    "dim_payment_type": """
        SELECT CAST(row_number() OVER (ORDER BY payment_type) AS INT) AS payment_type_id, payment_type
        FROM (SELECT DISTINCT payment_type FROM silver_payments WHERE payment_type IS NOT NULL)""",
    "item_totals": f"""
        SELECT order_id, count(*) AS total_items, {money('price')} AS total_revenue,
               {money('freight_value')} AS freight_total FROM silver_items GROUP BY 1""",
    "fact_orders": f"""
        SELECT order_id, customer_id, order_status, {key_of('order_purchase_timestamp')} AS purchase_date_id,
               {key_of('order_delivered_customer_date')} AS delivered_date_id,
               coalesce(total_items, 0) AS total_items, coalesce(total_revenue, 0.0::DOUBLE) AS total_revenue,
               coalesce(freight_total, 0.0::DOUBLE) AS freight_total, order_duration_days,
               order_duration_days AS delivery_days,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late_delivery
        FROM silver_orders LEFT JOIN item_totals USING (order_id)""",
    "fact_order_items": """
        SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, 1 AS quantity FROM silver_items""",
    "fact_reviews": f"""
        SELECT review_id, order_id, {key_of('review_creation_date')} AS review_date_id, review_score,
               review_comment_message IS NOT NULL AS has_comment FROM silver_reviews""",
    "fact_payments": """
        SELECT order_id, payment_sequential, payment_type_id, payment_type, payment_installments, payment_value
        FROM silver_payments LEFT JOIN dim_payment_type USING (payment_type)""",
    "batched_events": """
        SELECT *, CAST(day(ts) AS INT) AS batch_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS committed_at FROM events""",
}

_NEEDS = {
    "two_steps": ["src_orders"], "bronze_orders": ["src_orders", "two_steps"], "silver_orders": ["bronze_orders"],
    "silver_items": ["src_items"], "silver_products": ["src_products"], "payment_totals": ["src_payments"],
    "silver_payments": ["src_payments", "payment_totals"], "silver_reviews": ["src_reviews"],
    "dim_customer": ["silver_customers"], "dim_product": ["silver_products"], "dim_seller": ["silver_sellers"],
    "dim_payment_type": ["silver_payments"], "item_totals": ["silver_items"],
    "fact_orders": ["silver_orders", "item_totals"], "fact_order_items": ["silver_items"],
    "fact_reviews": ["silver_reviews"], "fact_payments": ["silver_payments", "dim_payment_type"],
}


def with_ctes(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named expressions and all they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + sql


def table_sql(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}", name)
