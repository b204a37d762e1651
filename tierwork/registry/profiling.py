"""Profiling reports over the given data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import clean_text
from ..operators import aggregates, profiles
from ..session import scratch_path
from ..sources.files import count_tables, read_csv, read_csv_with_rejects, with_provenance
from . import roles
from .base import Tables, query
from .roles import with_ctes


@query("""
    SELECT 'orders' AS table_name, count(*) AS row_count, CAST(NULL AS BIGINT) AS distinct_keys,
           min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders
    UNION ALL SELECT 'order_items', count(*), NULL, NULL, NULL FROM lineitem
    UNION ALL SELECT 'customers', count(*), count(DISTINCT c_custkey // 2), NULL, NULL FROM customer
    UNION ALL SELECT 'products', count(*), NULL, NULL, NULL FROM part
    UNION ALL SELECT 'sellers', count(*), NULL, NULL, NULL FROM supplier
    UNION ALL SELECT 'order_payments', count(*), NULL, NULL, NULL FROM lineitem
    UNION ALL SELECT 'order_reviews', count(*), NULL, min(ts), max(ts) FROM events
    UNION ALL SELECT 'geolocation', count(*), NULL, NULL, NULL FROM customer
    UNION ALL SELECT 'category_translation', count(*), NULL, NULL, NULL FROM part WHERE p_type <> 'ECONOMY'""")
def overview(t: Tables) -> DataFrame:
    """All source tables, the persons behind the customers, and the time spans."""
    tables = {name: rows(t) for name, rows in roles.SOURCES.items() if name != "orders"}
    return profiles.overview(
        {"orders": roles.source_orders(t), **tables}, {"customers": "customer_unique_id"},
        {"orders": "order_purchase_timestamp", "order_reviews": "review_creation_date"})


@query(with_ctes("""
    , counts AS (
        SELECT 'orders' AS table_name, 'order_delivered_customer_date' AS column_name,
               count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS n_null, count(*) AS n FROM src_orders
        UNION ALL SELECT 'order_reviews', 'review_comment_message', count(*) FILTER (WHERE review_comment_message IS NULL), count(*)
        FROM src_reviews
        UNION ALL SELECT 'products', 'product_category_name', count(*) FILTER (WHERE product_category_name IS NULL), count(*) FROM src_products
        UNION ALL SELECT 'order_items', 'price', count(*) FILTER (WHERE price IS NULL), count(*) FROM src_items
        UNION ALL SELECT 'order_payments', 'payment_type', count(*) FILTER (WHERE payment_type IS NULL), count(*) FROM src_payments)
    SELECT table_name, column_name, n_null, CAST(round(CAST(CAST(n_null / n * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS pct_null FROM counts WHERE n_null > 0""",
    "src_orders", "src_reviews", "src_products", "src_items", "src_payments"))
def null_profile(t: Tables) -> DataFrame:
    """The five fact and product tables, blanks counted as missing."""
    named = {"orders": roles.source_orders, "order_items": roles.order_items, "products": roles.products,
             "order_reviews": roles.reviews, "order_payments": roles.payments}
    return reduce(DataFrame.unionByName, [profiles.null_profile(clean_text(rows(t)), name) for name, rows in named.items()])


@query(with_ctes("""
    SELECT order_status, count(*) AS cnt FROM src_orders WHERE order_delivered_customer_date IS NULL GROUP BY 1""", "src_orders"))
def null_breakdown(t: Tables) -> DataFrame:
    return profiles.null_breakdown(roles.source_orders(t), "order_delivered_customer_date", "order_status")


@query(with_ctes("""
    SELECT count(*) AS total_rows, count(*) - count(review_comment_message) AS n_null,
           CAST(round(CAST(CAST((count(*) - count(review_comment_message)) / count(*) * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS pct_null FROM src_reviews""", "src_reviews"))
def comment_null_rate(t: Tables) -> DataFrame:
    return profiles.null_rate(clean_text(roles.reviews(t)), "review_comment_message")


@query(with_ctes("SELECT count(review_score) AS scored, CAST(round(CAST(CAST(avg(review_score) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS mean_score FROM src_reviews", "src_reviews"))
def score_mean(t: Tables) -> DataFrame:
    return profiles.score_mean(roles.reviews(t), "review_score")


@query(with_ctes("SELECT review_score, count(*) AS cnt FROM src_reviews GROUP BY 1", "src_reviews"))
def score_frequency(t: Tables) -> DataFrame:
    return aggregates.frequency(roles.reviews(t), "review_score").orderBy("review_score")


@query("""
    SELECT month, coalesce(cnt, 0) AS cnt FROM (
        SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM (
            SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders))
    LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS cnt FROM orders GROUP BY 1)
    USING (month)""")
def monthly_filled(t: Tables) -> DataFrame:
    return aggregates.monthly_counts_filled(t.orders, "o_orderdate")


@query(with_ctes("""
    SELECT CAST(least(floor((least(greatest(d, 0), 60) - 0) * 60 / 60), 59) AS INT) AS bin, count(*) AS cnt FROM (
        SELECT date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS d FROM src_orders
        WHERE order_delivered_customer_date IS NOT NULL) GROUP BY 1""", "src_orders"))
def delivery_histogram(t: Tables) -> DataFrame:
    return profiles.elapsed_histogram(roles.source_orders(t), "order_purchase_timestamp", "order_delivered_customer_date")


@query(with_ctes("""
    SELECT count(d) AS finished, CAST(round(CAST(CAST(avg(d) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS mean_days FROM (
        SELECT date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS d FROM src_orders)""", "src_orders"))
def delivery_mean(t: Tables) -> DataFrame:
    return profiles.elapsed_mean(roles.source_orders(t), "order_purchase_timestamp", "order_delivered_customer_date")


@query("""
    SELECT CASE WHEN p_type = 'ECONOMY' THEN 'unknown' ELSE 'cat_' || lower(p_type) END AS category,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    WHERE o_orderstatus <> 'P' GROUP BY 1 ORDER BY revenue DESC, category LIMIT 10""")
def top_categories(t: Tables) -> DataFrame:
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"))
    names = roles.translation(t).withColumnRenamed("product_category_name_english", "category")
    valid = t.orders.filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("order_id"))
    return profiles.top_groups_by_amount(
        roles.order_items(t), valid, "order_id", products, "product_id", "product_category_name", names, "category", "price", 10)


@query("""
    SELECT n_name AS state, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 ORDER BY orders DESC, state LIMIT 12""")
def top_states(t: Tables) -> DataFrame:
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("state"))
    orders = t.orders.select(F.col("o_custkey").alias("customer_id"))
    return profiles.top_groups_by_count(orders, people, "customer_id", "state", 12)


@query(with_ctes("""
    SELECT delivered, late, CAST(round(CAST(CAST(late / delivered * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS late_rate_pct FROM (
        SELECT count(*) FILTER (WHERE order_status = 'delivered' OR order_delivered_customer_date IS NOT NULL) AS delivered,
               count(*) FILTER (WHERE order_delivered_customer_date > order_estimated_delivery_date) AS late
        FROM src_orders)""", "src_orders"))
def late_rate(t: Tables) -> DataFrame:
    return profiles.late_rate(
        roles.source_orders(t), "order_status", "delivered", "order_delivered_customer_date", "order_estimated_delivery_date")


@query("""
    SELECT count(*) AS total_cust, CAST(sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_cust,
           CAST(round(CAST(CAST(sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END) / count(*) * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS repeat_rate_pct
    FROM (SELECT c_custkey // 2 AS person, count(DISTINCT o_orderkey) AS n
          FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)""")
def repeat_rate(t: Tables) -> DataFrame:
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.expr("c_custkey div 2").alias("person"))
    per_person = profiles.orders_per_person(t.orders, people, "o_custkey", "person", "o_orderkey", "n")
    return profiles.repeat_rate(per_person, "n", ("total_cust", "repeat_cust", "repeat_rate_pct"))


def _diagnosed(columns: str, source: str) -> str:
    return (f"SELECT '{columns.replace(' ', '')}' AS key_columns, count(*) AS total_rows, count(DISTINCT ({columns})) AS distinct_keys, "
            f"count(*) - count(DISTINCT ({columns})) AS duplicates FROM {source}")


@query(with_ctes("\n    UNION ALL ".join([
    _diagnosed("event_id", "events"), _diagnosed("user_id", "events"), _diagnosed("user_id, ts", "events"),
    _diagnosed("geolocation_zip_code_prefix", "(SELECT c_nationkey AS geolocation_zip_code_prefix FROM customer)"),
    _diagnosed("review_id", "src_reviews"), _diagnosed("review_id, order_id", "src_reviews")]), "src_reviews"))
def key_diagnostics(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        profiles.key_diagnostics(t.events, [["event_id"], ["user_id"], ["user_id", "ts"]]),
        profiles.key_diagnostics(roles.geolocation(t), [["geolocation_zip_code_prefix"]]),
        profiles.key_diagnostics(roles.reviews(t), [["review_id"], ["review_id", "order_id"]])])


@query(with_ctes("""
    SELECT count(*) AS anomalies FROM src_orders WHERE order_delivered_customer_date < order_purchase_timestamp""", "src_orders"))
def delivery_anomalies(t: Tables) -> DataFrame:
    return profiles.out_of_order(roles.source_orders(t), "order_purchase_timestamp", "order_delivered_customer_date")


@query("""
    SELECT p_partkey, p_name, TIMESTAMP '2024-01-01' AS _ingested_at, 'part.parquet' AS _source_file FROM part""")
def provenance(t: Tables) -> DataFrame:
    """The file name comes from the scan itself."""
    parts = with_provenance(t.part, F.col("_metadata.file_name"), "2024-01-01")
    return parts.select("p_partkey", "p_name", F.col("_ingested_at").cast("timestamp_ntz").alias("_ingested_at"), "_source_file")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def csv_scan(t: Tables) -> DataFrame:
    """Orders written as CSV and read back, typed by name without inference."""
    path = scratch_path(t.spark, "csv")
    columns = ["o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    t.orders.select(*columns).write.option("header", True).csv(path)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"}
    return read_csv(t.spark, path, types)


# lines of orders, some of them broken on the way
_LINES = """
    WITH lines AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s,
        CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 89 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS p FROM orders)"""
_CUT = "k % 83 = 0"


def _broken_csv(t: Tables) -> tuple[DataFrame, DataFrame]:
    key = F.col("o_orderkey")
    value = F.when(key % 97 == 0, "n/a").when(key % 89 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    fields = [key.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    line = F.when(key % 83 == 0, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, value))
    path = scratch_path(t.spark, "broken")
    t.orders.select(line.alias("value")).write.text(path)
    return read_csv_with_rejects(
        t.spark, path, {"key": "bigint", "customer": "bigint", "amount": "double"}, ("amount",), ["key", "customer", "status", "amount"])


@query(_LINES + f"""
    SELECT k AS key, c AS customer, s AS status, CAST(p AS DOUBLE) AS amount FROM lines WHERE NOT {_CUT} AND p NOT IN ('', 'n/a')""")
def csv_kept_rows(t: Tables) -> DataFrame:
    return _broken_csv(t)[0]


@query(_LINES + f"""
    SELECT CASE WHEN {_CUT} THEN 'malformed line' WHEN p = '' THEN 'amount: missing' ELSE 'amount: not a double' END AS reason,
           CASE WHEN {_CUT} THEN concat_ws(',', k, c, s) ELSE concat_ws(',', k, c, s, p) END AS record
    FROM lines WHERE {_CUT} OR p IN ('', 'n/a')""")
def csv_rejected_rows(t: Tables) -> DataFrame:
    """Rows at fault, with what is wrong and the line as it stood."""
    return _broken_csv(t)[1].select("reason", "record")


@query("""
    SELECT 'given_orders' AS table_name, count(*) AS row_count FROM orders
    UNION ALL SELECT 'given_lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'given_nowhere', 0""")
def table_counts(t: Tables) -> DataFrame:
    """Row counts by name; a table that does not exist counts as 0."""
    for name in ("orders", "lineitem"):
        getattr(t, name).createOrReplaceTempView(f"given_{name}")
    return count_tables(t.spark, ["given_orders", "given_lineitem", "given_nowhere"])
