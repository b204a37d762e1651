"""Projections, filters, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as c
from ..operators import aggregates, joins, sets, skew, windows
from . import roles
from .base import Tables, query
from .roles import first_row, money, nulls_first, with_ctes

# ---- cleaning and typed coercion ---------------------------------------------------


@query("""
    SELECT doc_id, nullif(trim(text, ' '), '') AS text, nullif(trim('  ' || lang || ' ', ' '), '') AS lang,
           CASE WHEN lang = 'de' THEN NULL WHEN lang = 'fr' THEN chr(9) ELSE source END AS source
    FROM documents""")
def trim_null_strings(t: Tables) -> DataFrame:
    padded = F.when(F.col("lang") == "de", "   ").when(F.col("lang") == "fr", " \t ").otherwise(F.col("source"))
    raw = t.documents.select(
        "doc_id", "text", F.concat(F.lit("  "), "lang", F.lit(" ")).alias("lang"), padded.alias("source"))
    return c.clean_text(raw)


@query("""
    SELECT event_id,
           TRY_CAST(CASE event_type WHEN 'error' THEN 'x' || event_id WHEN 'view' THEN event_id || '.0'
                    ELSE CAST(event_id AS VARCHAR) END AS BIGINT) AS as_int,
           TRY_CAST(CASE event_type WHEN 'click' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS as_number,
           TRY_CAST(CASE event_type WHEN 'signup' THEN '2020-13-01' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS as_time
    FROM events""")
def typed_coercion(t: Tables) -> DataFrame:
    kind, event_id = F.col("event_type"), F.col("event_id").cast("string")
    raw = t.events.select(
        "event_id",
        F.when(kind == "error", F.concat(F.lit("x"), event_id)).when(kind == "view", F.concat(event_id, F.lit(".0")))
        .otherwise(event_id).alias("as_int"),
        F.when(kind == "click", "n/a").otherwise(F.col("value").cast("string")).alias("as_number"),
        F.when(kind == "signup", "2020-13-01").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("as_time"),
    )
    return c.coerce_columns(raw, {"as_int": "bigint", "as_number": "double", "as_time": "timestamp_ntz"})


@query("""
    SELECT p_partkey AS product_id, p_type AS category, p_size AS weight, 1 AS quantity, 'part' AS source_name FROM part""")
def project_rename(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_size").alias("weight"),
        F.lit(1).alias("quantity"), F.lit("part").alias("source_name"))


@query(with_ctes("""
    SELECT order_id, coalesce(total_items, 0) AS total_items, coalesce(freight_total, 0.0::DOUBLE) AS freight_total
    FROM src_orders LEFT JOIN item_totals USING (order_id)""", "src_orders", "item_totals"))
def default_missing(t: Tables) -> DataFrame:
    items = windows.dedupe(roles.order_items(t), ["order_id", "order_item_id"])
    totals = {"total_items": F.count("*"), "freight_total": F.sum(F.col("freight_value").cast(c.MONEY)).cast("double")}
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"))
    return joins.with_child_totals(orders, items, ["order_id"], totals).select(
        "order_id", F.coalesce("total_items", F.lit(0).cast("bigint")).alias("total_items"),
        F.coalesce("freight_total", F.lit(0.0)).alias("freight_total"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus NOT IN ('P')")
def exclude_status(t: Tables) -> DataFrame:
    return t.orders.filter(c.not_in("o_orderstatus", ["P"])).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
    SELECT c_custkey, c_acctbal / 200 - 40 AS lat, -80.0::DOUBLE + c_custkey % 60 AS lng FROM customer
    WHERE c_acctbal / 200 - 40 BETWEEN -35 AND 6 AND -80.0::DOUBLE + c_custkey % 60 BETWEEN -75 AND -34""")
def bounding_box(t: Tables) -> DataFrame:
    points = t.customer.select(
        "c_custkey", (F.col("c_acctbal") / 200 - 40).alias("lat"), (F.lit(-80.0) + F.col("c_custkey") % 60).alias("lng"))
    return points.filter(c.in_box("lat", "lng", (-35, 6), (-75, -34)))


@query(with_ctes("""
    SELECT order_id, order_delivered_customer_date > order_estimated_delivery_date AS is_late,
           order_delivered_customer_date IS NOT NULL AS is_delivered,
           dayofweek(order_purchase_timestamp) IN (0, 6) AS is_weekend,
           (order_status = 'shipped' OR order_delivered_customer_date IS NOT NULL) AS reached,
           (order_purchase_timestamp < TIMESTAMP '1996-01-01' OR order_purchase_timestamp > TIMESTAMP '2000-12-31') AS outside
    FROM src_orders""", "src_orders"))
def derived_flags(t: Tables) -> DataFrame:
    delivered, bought = "order_delivered_customer_date", "order_purchase_timestamp"
    return roles.source_orders(t).select(
        "order_id", c.is_late(delivered, "order_estimated_delivery_date").alias("is_late"),
        F.col(delivered).isNotNull().alias("is_delivered"), c.is_weekend(bought).alias("is_weekend"),
        c.reached("order_status", "shipped", delivered).alias("reached"),
        c.outside(bought, "1996-01-01", "2000-12-31").alias("outside"))


@query("""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE date_trunc('month', o_orderdate) = DATE '1997-12-01'""")
def month_slice(t: Tables) -> DataFrame:
    return t.orders.filter(c.in_month("o_orderdate", "1997-12")).select("o_orderkey", "o_orderdate", "o_totalprice")


# ---- dates -------------------------------------------------------------------------


@query("""
    SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS full_date
    FROM (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem)""")
def date_spine(t: Tables) -> DataFrame:
    span = t.lineitem.agg(F.min("l_shipdate").cast("date").alias("a"), F.max("l_shipdate").cast("date").alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("full_date"))


@query(f"""
    SELECT event_id, {roles.key_of('ts')} AS date_id, CAST(year(ts) AS INT) AS year, CAST(quarter(ts) AS INT) AS quarter,
           CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week,
           CAST(date_trunc('month', ts) AS DATE) AS month_start,
           CAST(date_trunc('month', ts) + INTERVAL 1 MONTH AS DATE) AS next_month FROM events""")
def date_parts(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", c.date_key("ts").alias("date_id"), F.year("ts").alias("year"), F.quarter("ts").alias("quarter"),
        F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.dayofweek("ts").alias("day_of_week"),
        c.month_start("ts").alias("month_start"), c.next_month("ts").alias("next_month"))


@query("""
    SELECT event_id, CAST(date_diff('day', TIMESTAMP '2024-01-10 12:00:00', ts) AS INT) AS days FROM events""")
def calendar_days(t: Tables) -> DataFrame:
    start = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", c.calendar_days(start, "ts").alias("days"))


@query("""
    SELECT event_id, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10 12:00:00')) / 86400000000.0) AS INT) AS days
    FROM events""")
def elapsed_days(t: Tables) -> DataFrame:
    start = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", c.elapsed_days(start, "ts").alias("days"))


# ---- joins -------------------------------------------------------------------------


@query(with_ctes("""
    SELECT product_id, product_category_name,
           product_category_name_english FROM silver_products""", "silver_products"))
def lookup_left_join(t: Tables) -> DataFrame:
    products = c.clean_text(roles.products(t)).select("product_id", "product_category_name")
    return joins.lookup(products, roles.translation(t), "product_category_name", "product_category_name_english", "unknown")


@query(f"""
    SELECT o_orderkey, o_custkey, n_lines, gross FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, {money('l_extendedprice')} AS gross FROM lineitem GROUP BY 1)
         ON l_orderkey = o_orderkey""")
def preagg_left_join(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    totals = {"n_lines": F.count("*"), "gross": F.sum(F.col("l_extendedprice").cast(c.MONEY)).cast("double")}
    return joins.with_child_totals(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"], totals)


@query(f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice, total FROM lineitem
    JOIN (SELECT l_orderkey, {money('l_extendedprice')} AS total FROM lineitem GROUP BY 1) USING (l_orderkey)""")
def group_total_back(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.with_group_total(lines, ["l_orderkey"], F.sum(F.col("l_extendedprice").cast(c.MONEY)).cast("double"), "total")


@query("""
    SELECT o_orderkey, o_orderpriority, o_totalprice, priority_id FROM orders LEFT JOIN
    (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) AS INT) AS priority_id
     FROM (SELECT DISTINCT o_orderpriority FROM orders)) USING (o_orderpriority)""")
def surrogate_join(t: Tables) -> DataFrame:
    numbered = windows.ordered_surrogate(t.orders, "o_orderpriority", "priority_id")
    priorities = numbered.withColumn("priority_id", F.col("priority_id").cast("int"))
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return joins.attach_key(orders, priorities, "o_orderpriority", "priority_id")


@query("""
    SELECT o_orderkey, c_custkey, n_name, r_name FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def inner_chain(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    people = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return skew.sized_join(orders, people, ["c_custkey"], "inner", measured=t.customer.select("c_custkey", "c_name", "c_mktsegment"))


@query("""
    SELECT l_suppkey, count(*) AS orphan_rows FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1""")
def anti_orphans(t: Tables) -> DataFrame:
    return joins.orphan_counts(t.lineitem, "l_suppkey", t.supplier.filter(F.col("s_acctbal") > 0), "s_suppkey")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def semi_valid(t: Tables) -> DataFrame:
    valid = t.orders.filter(c.not_in("o_orderstatus", ["P"])).select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.keep_known(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), valid, ["l_orderkey"])


@query(with_ctes("""
    SELECT order_id, customer_id, order_purchase_timestamp,
           CASE WHEN order_delivered_customer_date IS NOT NULL THEN 'delivered' ELSE 'placed' END AS order_status,
           order_delivered_customer_date FROM src_orders""", "src_orders"))
def update_from_join(t: Tables) -> DataFrame:
    final = roles.source_orders(t)
    placed = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"), F.lit("placed").alias("order_status"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"))
    arrived = final.filter(F.col("order_delivered_customer_date").isNotNull())
    return joins.update_from(placed, arrived, ["order_id"], ["order_status", "order_delivered_customer_date"])


# ---- aggregates --------------------------------------------------------------------


@query(f"""
    SELECT l_returnflag, l_linestatus, count(*) AS n, {money('l_extendedprice')} AS price, {money('l_quantity')} AS quantity
    FROM lineitem GROUP BY 1, 2""")
def hash_agg(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), c.exact_sum("l_extendedprice").cast("double").alias("price"),
        c.exact_sum("l_quantity").cast("double").alias("quantity"))


@query("""
    SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
           count(DISTINCT l_orderkey) AS order_count, CAST(round(CAST(CAST(avg(CAST(l_linenumber AS DOUBLE)) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_line
    FROM lineitem GROUP BY 1, 2""")
def distinct_agg(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        c.money_total("l_extendedprice").alias("revenue"), F.countDistinct("l_orderkey").alias("order_count"),
        F.round(F.avg("l_linenumber"), 2).alias("avg_line")).orderBy("year", "month")


@query("""
    SELECT count(*) AS total, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS returned,
           CAST(round(CAST(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*) * 100 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS returned_pct,
           CAST(round(CAST(CAST(CAST(NULL AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS no_rows_pct FROM lineitem""")
def conditional_ratio(t: Tables) -> DataFrame:
    returned, never = F.col("l_returnflag") == "R", F.col("l_linenumber") < 0
    return t.lineitem.agg(
        F.count("*").alias("total"), F.count_if(returned).alias("returned"), F.count_if(never).alias("_never"),
    ).select("total", "returned", c.percent("returned", "total").alias("returned_pct"),
             c.percent("returned", "_never").alias("no_rows_pct"))


@query("""
    SELECT c_mktsegment, count(*) AS customers, max(n) AS most_orders, CAST(round(CAST(CAST(avg(n) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_orders
    FROM (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1)
    JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def two_level_agg(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.countDistinct("o_orderkey").alias("n"))
    return per_customer.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey").groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"), F.max("n").alias("most_orders"), F.round(F.avg("n"), 2).alias("avg_orders"))


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


_LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(first_row("lineitem", "l_orderkey, l_linenumber", nulls_first(*_LINE_COLUMNS)))
def dedupe_key(t: Tables) -> DataFrame:
    return windows.dedupe(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""")
def duplicate_surplus(t: Tables) -> DataFrame:
    return aggregates.duplicate_surplus(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    WITH rows AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1992-06-01')
    SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM rows)) AS distinct_keys,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rows)) AS duplicates FROM rows""")
def duplicate_surplus_of_wide_keys(t: Tables) -> DataFrame:
    """Whole rows as the key, some of them twice; fingerprints first, rows where these repeat."""
    twice = t.lineitem.unionByName(t.lineitem.filter(F.col("l_shipdate") < F.lit("1992-06-01")))
    return aggregates.duplicate_surplus_by_fingerprint(twice, t.lineitem.columns)


@query("SELECT event_type, count(*) AS cnt FROM events GROUP BY 1 ORDER BY 2 DESC")
def frequency(t: Tables) -> DataFrame:
    return aggregates.frequency(t.events, "event_type")


@query("SELECT count(*) AS row_count, max(o_totalprice) AS highest FROM orders")
def row_count_and_max(t: Tables) -> DataFrame:
    return t.orders.agg(F.count("*").alias("row_count"), F.max("o_totalprice").alias("highest"))


@query("""
    SELECT CAST(least(floor((least(greatest(value, 0), 300) - 0) * 60 / 300), 59) AS INT) AS bin, count(*) AS cnt
    FROM events GROUP BY 1""")
def histogram(t: Tables) -> DataFrame:
    return aggregates.histogram(t.events, "value", 0, 300, 60)


# ---- windows -----------------------------------------------------------------------


@query(first_row("events", "user_id", "ts DESC NULLS LAST, event_id NULLS FIRST"))
def latest_version(t: Tables) -> DataFrame:
    return windows.latest_version(t.events, ["user_id"], ["ts"])


@query("""
    SELECT l_orderkey, l_shipmode AS l_returnflag FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_shipmode) AS rn
        FROM (SELECT l_orderkey, l_returnflag AS l_shipmode, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE rn = 1""")
def dominant_value(t: Tables) -> DataFrame:
    return windows.dominant_value(t.lineitem, ["l_orderkey"], "l_returnflag")


@query("""
    SELECT CAST(row_number() OVER (ORDER BY l_shipdate) AS INT) AS ship_id, l_shipdate
    FROM (SELECT DISTINCT l_shipdate FROM lineitem)""")
def ordered_surrogate(t: Tables) -> DataFrame:
    numbered = windows.ordered_surrogate(t.lineitem, "l_shipdate", "ship_id")
    return numbered.withColumn("ship_id", F.col("ship_id").cast("int"))


# ---- sorts and set operations ------------------------------------------------------


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_k(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return sets.top_k(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT l_orderkey, 'P', max(l_extendedprice) FROM lineitem GROUP BY 1""")
def union_replace(t: Tables) -> DataFrame:
    fresh = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("o_totalprice"))
    current = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sets.replace_rows(current, "o_orderstatus", "P", fresh.withColumn("o_orderstatus", F.lit("P")))


@query("""
    SELECT 'orders' AS report, o_orderstatus AS value, count(*) AS cnt FROM orders GROUP BY 2
    UNION ALL SELECT 'lines', l_linestatus, count(*) FROM lineitem GROUP BY 2
    UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY 2""")
def labelled_reports(t: Tables) -> DataFrame:
    sources = {"orders": (t.orders, "o_orderstatus"), "lines": (t.lineitem, "l_linestatus"), "events": (t.events, "event_type")}
    return sets.stacked(
        {name: aggregates.frequency(df, col).withColumnRenamed(col, "value") for name, (df, col) in sources.items()}, "report")


_ITEM_COLUMNS = "product_id, seller_id, shipping_limit_date, price, freight_value"


@query(with_ctes(f"""
    , old AS (SELECT * FROM src_items WHERE shipping_limit_date < TIMESTAMP '1998-01-01'),
    incoming AS ({first_row("(SELECT * FROM src_items WHERE shipping_limit_date >= TIMESTAMP '1998-01-01')",
                            "order_id, order_item_id", roles.ITEM_ORDER)})
    SELECT * FROM old UNION ALL
    SELECT * FROM incoming i WHERE NOT EXISTS
        (SELECT 1 FROM old o WHERE o.order_id = i.order_id AND o.order_item_id = i.order_item_id)""", "src_items"))
def insert_absent(t: Tables) -> DataFrame:
    items, cut = roles.order_items(t), F.lit("1998-01-01")
    old, incoming = items.filter(F.col("shipping_limit_date") < cut), items.filter(F.col("shipping_limit_date") >= cut)
    return sets.insert_absent(old, incoming, ["order_id", "order_item_id"])


@query(with_ctes("""
    SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
           order_estimated_delivery_date, source_updated_at FROM silver_orders""", "silver_orders"))
def upsert_key(t: Tables) -> DataFrame:
    log, cut = roles.bronze_orders(t), F.lit("1998-01-01")
    before = windows.latest_version(log.filter(F.col("source_updated_at") < cut), ["order_id"], ["source_updated_at"])
    after = windows.latest_version(log.filter(F.col("source_updated_at") >= cut), ["order_id"], ["source_updated_at"])
    return sets.upsert(before, after, ["order_id"])
