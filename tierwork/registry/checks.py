"""Data-quality checks, suites and run reports over the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import quality as q
from ..plans import gold, silver, suites
from ..plans.metrics import health_report
from ..sinks.tables import replace_tables
from . import roles, star
from .base import Tables, query
from .roles import with_ctes


def result(table: str, layer: str, name: str, value: str, source: str, threshold: str = "0", test: str = "=") -> str:
    """SQL of one result row."""
    return (
        f"SELECT '{table}' AS table_name, '{layer}' AS layer, '{name}' AS check_name, (v {test} t) AS passed, "
        f"CAST(v AS DOUBLE) AS value, CAST(t AS DOUBLE) AS threshold "
        f"FROM (SELECT {value} AS v, {threshold} AS t FROM {source})"
    )


def all_of(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


def _rows(table: str, layer: str, source: str) -> str:
    return result(table, layer, "row_count_gt_0", "count(*)", source, test=">")


def _nulls(table: str, layer: str, column: str, source: str) -> str:
    return result(table, layer, f"{column}_not_null", f"count(*) FILTER (WHERE {column} IS NULL)", source)


def _repeats(table: str, layer: str, columns: list[str], source: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {source}))"
    return result(table, layer, f"unique_{'_'.join(columns)}", f"count(*) - {distinct}", source)


def _bad(table: str, layer: str, name: str, condition: str, source: str) -> str:
    return result(table, layer, name, f"count(*) FILTER (WHERE {condition})", source)


def _orphans(table: str, layer: str, child: str, key: str, parent: str, parent_key: str) -> str:
    source = f"{child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})"
    return result(table, layer, f"fk_{key}_in_{parent_key}", "count(*)", source)


@query(with_ctes(all_of(
    _rows("orders", "raw", "src_orders"),
    _nulls("orders", "raw", "order_delivered_customer_date", "src_orders"),
    _bad("orders", "raw", "order_status_accepted_values", "order_status NOT IN ('delivered', 'shipped')", "src_orders"),
    _bad("orders", "raw", "purchase_ts_in_range",
         "order_purchase_timestamp < TIMESTAMP '1996-01-01' OR order_purchase_timestamp > TIMESTAMP '2000-12-31'", "src_orders"),
    _bad("orders", "raw", "customer_id_between_10_500", "customer_id < 10 OR customer_id > 500", "src_orders"),
    _bad("orders", "raw", "customer_id_positive", "customer_id <= 0", "src_orders"),
    _bad("orders", "raw", "customer_id_non_negative", "customer_id < 0", "src_orders"),
), "src_orders"))
def dq_row_checks(t: Tables) -> DataFrame:
    """Seven row checks of one table: one scan, one aggregate."""
    return q.check_table(roles.source_orders(t), "orders", "raw", [
        q.row_count_gt(0), q.not_null("order_delivered_customer_date"), q.in_set("order_status", ["delivered", "shipped"]),
        q.in_window("purchase_ts_in_range", "order_purchase_timestamp", "1996-01-01", "2000-12-31"),
        q.between("customer_id", 10, 500), q.positive("customer_id"), q.non_negative("customer_id"),
    ])


@query(all_of(
    _repeats("lineitem", "raw", ["l_orderkey", "l_linenumber"], "lineitem"),
    _repeats("orders", "raw", ["o_orderkey"], "orders"),
))
def dq_unique(t: Tables) -> DataFrame:
    return q.check_suite("raw", [
        ("lineitem", t.lineitem, [q.Unique(("l_orderkey", "l_linenumber"))]), ("orders", t.orders, [q.Unique(("o_orderkey",))])])


@query(all_of(
    _orphans("lineitem", "raw", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("lineitem", "raw", "lineitem", "l_suppkey", "(SELECT * FROM supplier WHERE s_acctbal > 0)", "s_suppkey"),
    _orphans("events", "raw", "events", "user_id", "customer", "c_custkey"),
))
def dq_fk(t: Tables) -> DataFrame:
    return q.check_suite("raw", [
        ("lineitem", t.lineitem, [
            q.ForeignKey("l_orderkey", t.orders, "o_orderkey"),
            q.ForeignKey("l_suppkey", t.supplier.filter(F.col("s_acctbal") > 0), "s_suppkey")]),
        ("events", t.events, [q.ForeignKey("user_id", t.customer, "c_custkey")]),
    ])


@query(all_of(
    result("orders", "raw", "rowcount_matches_lineitem_keys", "count(*)", "orders",
           "(SELECT count(DISTINCT l_orderkey) FROM lineitem)"),
    result("events", "raw", "rowcount_matches_events", "count(*)", "events", "(SELECT count(*) FROM events)"),
))
def dq_counts(t: Tables) -> DataFrame:
    return q.check_suite("raw", [
        ("orders", t.orders, [q.SameCount("rowcount_matches_lineitem_keys", t.lineitem.select("l_orderkey").distinct())]),
        ("events", t.events, [q.SameCount("rowcount_matches_events", t.events)]),
    ])


@query("""
    SELECT (SELECT count(*) FROM events WHERE event_type <> 'error') AS source_rows,
           (SELECT count(*) FROM events) AS target_rows,
           (SELECT count(*) FROM events) >= (SELECT count(*) FROM events WHERE event_type <> 'error') AS matched""")
def reconcile_counts(t: Tables) -> DataFrame:
    return q.reconcile(t.events.filter(F.col("event_type") != "error"), t.events, partial_source=True)


# source table -> its rows in SQL and its key columns
_BRONZE = {
    "orders": ("bronze_orders", ["order_id"]), "order_items": ("src_items", ["order_id", "order_item_id"]),
    "customers": ("silver_customers", ["customer_id"]), "products": ("src_products", ["product_id"]),
    "sellers": ("silver_sellers", ["seller_id"]), "order_payments": ("src_payments", ["order_id", "payment_sequential"]),
    "order_reviews": ("src_reviews", ["review_id"]),
    "geolocation": ("(SELECT c_nationkey AS geolocation_zip_code_prefix FROM customer)", ["geolocation_zip_code_prefix"]),
    "category_translation": ("(SELECT p_type AS product_category_name FROM part WHERE p_type <> 'ECONOMY')", ["product_category_name"]),
}


@query(with_ctes(all_of(*[
    part for table, (source, keys) in _BRONZE.items()
    for part in [_rows(f"bronze.{table}", "bronze", source), *[_nulls(f"bronze.{table}", "bronze", k, source) for k in keys]]
]), *[source for source, _ in _BRONZE.values() if not source.startswith("(")]))
def dq_bronze_suite(t: Tables) -> DataFrame:
    """All nine source tables: nine row counts and eleven key checks."""
    return suites.bronze({table: roles.SOURCES[table](t) for table in _BRONZE})


@query("""
    SELECT (SELECT count(*) FROM lineitem) AS source_rows, (SELECT count(*) FROM lineitem) AS target_rows, true AS matched""")
def reconcile_whole_table(t: Tables) -> DataFrame:
    """A table loaded as a whole must hold exactly the rows of its source."""
    wh = t.warehouse("reconcile")
    replace_tables(wh, {"bronze.order_items": roles.order_items(t)})
    return q.reconcile(t.lineitem, wh.table("bronze.order_items"))


_STATUSES = "('created','approved','invoiced','processing','shipped','delivered','canceled','unavailable')"


@query(with_ctes(all_of(
    _nulls("silver.orders", "silver", "order_id", "silver_orders"),
    _repeats("silver.orders", "silver", ["order_id"], "silver_orders"),
    _bad("silver.orders", "silver", "order_status_accepted_values", f"order_status NOT IN {_STATUSES}", "silver_orders"),
    _bad("silver.orders", "silver", "purchase_ts_in_range",
         "order_purchase_timestamp < TIMESTAMP '2016-01-01' OR order_purchase_timestamp > TIMESTAMP '2019-12-31'", "silver_orders"),
    _repeats("silver.order_items", "silver", ["order_id", "order_item_id"], "silver_items"),
    _bad("silver.order_items", "silver", "price_positive", "price <= 0", "silver_items"),
    _bad("silver.order_payments", "silver", "payment_type_accepted_values",
         "payment_type NOT IN ('credit_card','boleto','voucher','debit_card','not_defined')", "silver_payments"),
    _bad("silver.order_reviews", "silver", "review_score_between_1_5", "review_score < 1 OR review_score > 5", "silver_reviews"),
), "silver_orders", "silver_items", "silver_payments", "silver_reviews"))
def dq_silver_suite(t: Tables) -> DataFrame:
    """The gate runs on stored tables, so they are written first, once each."""
    wh = t.warehouse("silver-suite")
    built = {
        "orders": silver.orders(roles.bronze_orders(t)), "order_items": silver.order_items(roles.order_items(t)),
        "order_payments": silver.order_payments(roles.payments(t)), "order_reviews": silver.order_reviews(roles.reviews(t)),
    }
    replace_tables(wh, {f"silver.{name}": df for name, df in built.items()})
    return suites.silver(*[wh.table(f"silver.{name}") for name in built])


@query(with_ctes(all_of(
    _orphans("gold.fact_order_items", "gold", "fact_order_items", "order_id", "fact_orders", "order_id"),
    _orphans("gold.fact_order_items", "gold", "fact_order_items", "product_id", "dim_product", "product_id"),
    _orphans("gold.fact_order_items", "gold", "fact_order_items", "seller_id", "dim_seller", "seller_id"),
    _orphans("gold.fact_orders", "gold", "fact_orders", "customer_id", "dim_customer", "customer_id"),
    _nulls("gold.fact_orders", "gold", "order_id", "fact_orders"),
    _repeats("gold.fact_orders", "gold", ["order_id"], "fact_orders"),
    result("gold.fact_orders", "gold", "rowcount_matches_silver_orders", "count(*)", "fact_orders",
           "(SELECT count(*) FROM silver_orders)"),
    _orphans("gold.fact_payments", "gold", "fact_payments", "payment_type_id", "dim_payment_type", "payment_type_id"),
    _nulls("gold.dim_customer", "gold", "customer_id", "dim_customer"),
    _nulls("gold.dim_product", "gold", "product_id", "dim_product"),
), "fact_order_items", "fact_orders", "fact_payments", "dim_product", "dim_seller", "dim_customer", "dim_payment_type"))
def dq_gold_suite(t: Tables) -> DataFrame:
    wh = t.warehouse("gold-suite")

    def stored(built: dict[str, DataFrame]) -> list[DataFrame]:
        replace_tables(wh, built)
        return [wh.table(name) for name in built]

    orders, items, payments = stored({
        "silver.orders": silver.orders(roles.bronze_orders(t)), "silver.order_items": silver.order_items(roles.order_items(t)),
        "silver.order_payments": silver.order_payments(roles.payments(t)),
    })
    facts, types = stored({
        "gold.fact_orders": gold.fact_orders(orders, items), "gold.dim_payment_type": gold.dim_payment_type(payments)})
    return suites.gold({
        "fact_orders": facts, "fact_order_items": gold.fact_order_items(items),
        "fact_payments": gold.fact_payments(payments, types), "dim_payment_type": types,
        "dim_product": star._dim_product(t), "dim_customer": star._dim_customer(t),
        "dim_seller": gold.dim_seller(silver.sellers(roles.sellers(t))),
    }, orders)


@query("""
    SELECT layer, runs, failed_runs, avg_duration_sec, max_duration_sec, rows_out, coalesce(checks, 0) AS checks,
           coalesce(failed_checks, 0) AS failed_checks, CAST(round(CAST(CAST((checks - failed_checks) / checks * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS dq_pass_pct
    FROM (SELECT event_type AS layer, count(*) AS runs, count(*) FILTER (WHERE value > 80) AS failed_runs,
                 CAST(round(CAST(CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_duration_sec,
                 max(value) AS max_duration_sec, CAST(sum(user_id) AS BIGINT) AS rows_out FROM events GROUP BY 1)
    LEFT JOIN (SELECT event_type AS layer, count(*) AS checks, count(*) FILTER (WHERE value > 50) AS failed_checks
               FROM events WHERE event_type <> 'error' GROUP BY 1) USING (layer)""")
def run_health(t: Tables) -> DataFrame:
    """Events in the role of the job log and of the quality log."""
    log = t.events.select(
        F.col("event_type").alias("layer"), F.when(F.col("value") > 80, "failed").otherwise("success").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("duration_sec"), F.col("user_id").alias("rows_out"))
    checks = t.events.filter(F.col("event_type") != "error").select(
        F.col("event_type").alias("layer"), (F.col("value") <= 50).alias("passed"))
    report = health_report(log, checks)
    return report.withColumns({x: F.col(x).cast("double") for x in ("avg_duration_sec", "max_duration_sec")})
