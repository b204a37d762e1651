"""Incremental loads, change history and versioned reads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregates, changelog, contents, incremental, profile_states, versions
from ..schema import EPOCH_WATERMARK
from ..sinks import rewrite, tables
from ..plans.metrics import job_run
from . import roles
from .base import Tables, query
from .roles import with_ctes

HALF = "2024-01-16"


@query(f"""
    SELECT event_id, ts, user_id FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{HALF}')""")
def incremental_filter(t: Tables) -> DataFrame:
    mark = aggregates.maximum(t.events.filter(F.col("ts") < F.lit(HALF)), "ts", EPOCH_WATERMARK)
    return incremental.new_rows(t.events.select("event_id", "ts", "user_id"), "ts", mark)


@query(f"""
    SELECT event_type AS table_name, max(ts) AS watermark_value, TIMESTAMP '2024-01-16' AS updated_at
    FROM events WHERE ts < TIMESTAMP '{HALF}' AND event_type <> 'click' GROUP BY 1
    UNION ALL SELECT 'click', max(ts), TIMESTAMP '2024-02-01' FROM events WHERE event_type = 'click'""")
def watermark_advance(t: Tables) -> DataFrame:
    current = t.events.filter(F.col("ts") < F.lit(HALF)).groupBy(F.col("event_type").alias("table_name")).agg(
        F.max("ts").alias("watermark_value")).withColumn("updated_at", F.lit(HALF).cast("timestamp_ntz"))
    loaded = t.events.filter(F.col("event_type") == "click")
    return incremental.watermarks_after(current, loaded, "ts", "click", "2024-02-01")


@query(f"""
    SELECT event_id, ts, user_id, CASE WHEN ts < TIMESTAMP '{HALF}' THEN 1 ELSE 2 END AS batch_id FROM events""")
def incremental_load(t: Tables) -> DataFrame:
    """Two loads and a third one that finds nothing new."""
    wh = t.warehouse("load")
    events = t.events.select("event_id", "ts", "user_id")
    for source in (events.filter(F.col("ts") < F.lit(HALF)), events, events):
        incremental.load_increment(wh, source, "bronze.events", "ts", "ts", run_ts=datetime(2024, 2, 1))
    return wh.table("bronze.events").select("event_id", "ts", "user_id", F.col("batch_id").cast("int").alias("batch_id"))


@query(f"""
    WITH parts AS (SELECT event_id, ts, user_id, ts < TIMESTAMP '{HALF}' AND event_id % 50 <> 0 AS early FROM events)
    SELECT event_id, ts, user_id, CASE WHEN early THEN 1 ELSE 2 END AS batch_id FROM parts
    WHERE early OR ts > (SELECT max(ts) FROM parts WHERE early) - INTERVAL 5 DAY""")
def lookback_load(t: Tables) -> DataFrame:
    """A load that lacks some events, one that also finds those of them that came up to
    five days late, and one that finds nothing."""
    wh = t.warehouse("lookback")
    events = t.events.select("event_id", "ts", "user_id")
    early = (F.col("ts") < F.lit(HALF)) & (F.col("event_id") % 50 != 0)
    for source in (events.filter(early), events, events):
        incremental.load_increment(
            wh, source, "bronze.events", "ts", "ts", lookback=timedelta(days=5), keys=["event_id"], run_ts=datetime(2024, 2, 1))
    return wh.table("bronze.events").select("event_id", "ts", "user_id", F.col("batch_id").cast("int").alias("batch_id"))


@query("""
    SELECT 'rows' AS kind, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM events
    UNION ALL SELECT 'nulls', 'event_id', NULL, count(*) - count(event_id) FROM events
    UNION ALL SELECT 'nulls', 'ts', NULL, count(*) - count(ts) FROM events
    UNION ALL SELECT 'nulls', 'event_type', NULL, count(*) - count(event_type) FROM events
    UNION ALL SELECT 'nulls', 'hour', NULL, count(*) - count(ts) FROM events
    UNION ALL SELECT 'nulls', '_part_ts', NULL, count(*) - count(ts) FROM events
    UNION ALL SELECT 'nulls', 'part_ts_month', NULL, count(*) - count(ts) FROM events
    UNION ALL SELECT 'value', 'event_type', event_type, count(*) FROM events GROUP BY 3
    UNION ALL SELECT 'bin', 'hour', CAST(CAST(floor(extract(hour FROM ts) / 6) AS BIGINT) AS VARCHAR), count(*) FROM events WHERE ts IS NOT NULL GROUP BY 3""")
def merged_profile(t: Tables) -> DataFrame:
    """Events loaded in two batches; each update of the profile reads the new one."""
    wh = t.warehouse("profile")
    events = t.events.select("event_id", "ts", "event_type", F.hour("ts").alias("hour"))
    spec = profile_states.ProfileSpec(("event_type",), {"hour": (0, 24, 4)})
    for source in (events.filter(F.col("ts") < F.lit(HALF)), events):
        incremental.load_increment(wh, source, "bronze.events", "ts", "ts", run_ts=datetime(2024, 2, 1))
        profile_states.update(wh, "bronze.events", spec)
    return profile_states.profile(wh, "bronze.events")


@query(f"""
    SELECT 'bronze.events' AS table_name, CAST(batch_id AS BIGINT) AS batch_id, 'append' AS operation, row_count, watermark_value FROM (
        SELECT CASE WHEN ts < TIMESTAMP '{HALF}' THEN 1 ELSE 2 END AS batch_id, count(*) AS row_count,
               max(ts) AS watermark_value FROM events GROUP BY 1)""")
def batch_ledger(t: Tables) -> DataFrame:
    wh = t.warehouse("ledger")
    events = t.events.select("event_id", "ts")
    for source in (events.filter(F.col("ts") < F.lit(HALF)), events):
        incremental.load_increment(wh, source, "bronze.events", "ts", "ts", run_ts=datetime(2024, 2, 1))
    return wh.table(incremental.LEDGER).select("table_name", "batch_id", "operation", "row_count", "watermark_value")


@query(with_ctes("SELECT * FROM bronze_orders", "bronze_orders"))
def change_log(t: Tables) -> DataFrame:
    return changelog.change_log(roles.source_orders(t))


@query(with_ctes("""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_updated_at DESC) AS rn
    FROM bronze_orders WHERE date_trunc('month', source_updated_at) <= DATE '1998-06-01') WHERE rn = 1""", "bronze_orders"))
def state_as_of(t: Tables) -> DataFrame:
    return changelog.state_as_of(roles.bronze_orders(t), "1998-06", ["order_id"])


@query(with_ctes("""
    SELECT * FROM src_items WHERE order_id IN
        (SELECT o_orderkey FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1998-06-01')""", "src_items"))
def children_slice(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_purchase_timestamp"))
    return changelog.month_slice(orders, {"items": roles.order_items(t)}, "1998-06")[1]["items"]


# ---- versioned reads ---------------------------------------------------------------


@query(with_ctes("""
    SELECT batch_id, 'append' AS operation, max(committed_at) AS committed_at, count(*) AS added_rows
    FROM batched_events GROUP BY 1""", "batched_events"))
def batch_history(t: Tables) -> DataFrame:
    return versions.batch_history(roles.batched_events(t))


@query(with_ctes("""
    SELECT batch_id, 'append' AS operation, CAST(count(*) AS VARCHAR) AS added_rows, CAST(NULL AS VARCHAR) AS removed_rows
    FROM batched_events GROUP BY 1""", "batched_events"))
def batch_summary(t: Tables) -> DataFrame:
    history = versions.batch_history(roles.batched_events(t))
    return versions.with_summary(history, ["operation", "added_rows"]).select(
        "batch_id", *[versions.summary_value(k).alias(k) for k in ("operation", "added_rows", "removed_rows")])


def _stored_batches(t: Tables) -> DataFrame:
    """The batches of the events, written as partitions and read back."""
    wh = t.warehouse("batches")
    tables.replace_table(wh, roles.batched_events(t), "bronze.events", "batch_id")
    return wh.table("bronze.events")


@query(with_ctes("SELECT event_id, batch_id FROM batched_events WHERE batch_id <= 10", "batched_events"))
def version_as_of(t: Tables) -> DataFrame:
    return versions.as_of_version(_stored_batches(t), 10).select("event_id", "batch_id")


@query(with_ctes("""
    SELECT event_id, batch_id, committed_at FROM batched_events WHERE committed_at <= TIMESTAMP '2024-01-20 12:00:00'""",
    "batched_events"))
def timestamp_as_of(t: Tables) -> DataFrame:
    """The batches committed by then are found first; only their files are read."""
    stored = _stored_batches(t)
    ledger = versions.batch_history(roles.batched_events(t))
    last = versions.as_of_time(ledger, "2024-01-20 12:00:00").agg(F.max("batch_id")).first()[0]
    return versions.as_of_version(stored, last).select("event_id", "batch_id", "committed_at")


@query(with_ctes("""
    SELECT event_id, batch_id FROM batched_events
    WHERE batch_id = (SELECT max(batch_id) FROM batched_events WHERE batch_id <= 12)""", "batched_events"))
def replaced_version_as_of(t: Tables) -> DataFrame:
    return versions.replaced_as_of(_stored_batches(t), 12).select("event_id", "batch_id")


@query(with_ctes("SELECT event_id, batch_id FROM batched_events WHERE batch_id <= 12", "batched_events"))
def stored_version_by_id(t: Tables) -> DataFrame:
    """A table that was replaced since, read by the id of its first version."""
    wh, events = t.warehouse("versions"), roles.batched_events(t)
    first = tables.replace_table(wh, versions.as_of_version(events, 12), "bronze.events", "batch_id")
    tables.replace_table(wh, events, "bronze.events", "batch_id")
    return tables.read_version(wh, "bronze.events", first).select("event_id", "batch_id")


@query(with_ctes("""
    SELECT min(batch_id) AS first_version,
           count(*) FILTER (WHERE batch_id = (SELECT min(batch_id) FROM batched_events)) AS first_rows,
           max(batch_id) AS current_version, count(*) AS current_rows FROM batched_events""", "batched_events"))
def version_compare(t: Tables) -> DataFrame:
    return versions.compare_versions(roles.batched_events(t))


@query("SELECT 'lineitem.parquet' AS file_name, count(*) AS record_count FROM lineitem")
def file_stats(t: Tables) -> DataFrame:
    """File names and row counts; a given table is one file. Sizes are tested apart."""
    return versions.file_stats(t.lineitem).select(F.regexp_extract("file_path", r"[^/]+$", 0).alias("file_name"), "record_count")


# ---- sinks -------------------------------------------------------------------------


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, strftime(o_orderdate, '%Y') AS o_orderdate_year,
           o_orderstatus FROM orders""")
def partition_write_roundtrip(t: Tables) -> DataFrame:
    """Write twice as create-or-replace with time and identity partitions, the
    second time from the table itself, and read back."""
    wh = t.warehouse("replace")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    tables.replace_table(wh, orders, "silver.orders", "years(o_orderdate), o_orderstatus")
    again = wh.table("silver.orders").drop("o_orderdate_year")
    tables.replace_table(wh, again, "silver.orders", "years(o_orderdate), o_orderstatus")
    return wh.table("silver.orders").withColumn("o_orderdate_year", F.col("o_orderdate_year").cast("string"))


@query(with_ctes("""
    SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
           source_updated_at, CAST(year(order_purchase_timestamp) AS INT) AS purchase_year FROM silver_orders""", "silver_orders"))
def upsert_partition_table(t: Tables) -> DataFrame:
    """A partitioned table upserted twice; each time only the touched partitions
    are rewritten."""
    wh = t.warehouse("upsert")
    log = roles.bronze_orders(t).select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
        "source_updated_at", F.year("order_purchase_timestamp").alias("purchase_year"))
    for part in (F.col("source_updated_at") < F.lit("1998-01-01"), F.col("source_updated_at") >= F.lit("1998-01-01")):
        latest = changelog.latest_version(log.filter(part), ["order_id"], ["source_updated_at"])
        tables.upsert_partitions(wh, latest, "gold.fact_orders", ["order_id"], "purchase_year")
    return wh.table("gold.fact_orders")


@query("""
    SELECT 'silver.parts' AS table_name, count(*) AS rows_before, count(*) AS rows_after FROM part""")
def rewrite_guard(t: Tables) -> DataFrame:
    """Move a table to another partitioning under the row-count guard."""
    wh = t.warehouse("rewrite")
    tables.replace_table(wh, t.part, "silver.parts")
    rewrite.rewrite_table(wh, "silver.parts", wh.table("silver.parts"), f"{wh.location('silver.parts')}/moved", "p_brand")
    moved = wh.table("silver.parts").agg(F.count("*").alias("rows_after"))
    original = t.part.agg(F.count("*").alias("rows_before"))
    both = moved.withColumn("rows_before", F.lit(0).cast("bigint")).unionByName(
        original.withColumn("rows_after", F.lit(0).cast("bigint")))
    return both.agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after")).select(
        F.lit("silver.parts").alias("table_name"), "*")


# the second version: one price raised, one line lost and another doubled, an equal number of rows
_EDITED = """
    WITH edges AS (SELECT min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem),
    old AS (SELECT l_orderkey, l_linenumber, l_quantity, l_linestatus, l_returnflag FROM lineitem),
    new AS (
        SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey = low AND l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
               l_linestatus, l_returnflag FROM old, edges WHERE NOT (l_orderkey = high AND l_linenumber = 1)
        UNION ALL SELECT old.* FROM old, edges WHERE l_orderkey = low AND l_linenumber = 1)"""


def _edited(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", "l_returnflag")
    edges = old.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    first, last = [(F.col("l_orderkey") == F.lit(key)) & (F.col("l_linenumber") == 1) for key in edges]
    raised = old.filter(~last).withColumn("l_quantity", F.when(first, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return old, raised.unionByName(old.filter(first))


@query(_EDITED + """
    SELECT l_linestatus, l_returnflag, CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(a) AS BIGINT) AS rows_after FROM (
        SELECT l_linestatus, l_returnflag, 1 AS b, 0 AS a FROM old UNION ALL SELECT l_linestatus, l_returnflag, 0, 1 FROM new)
    WHERE (l_linestatus, l_returnflag) IN (
        SELECT (l_linestatus, l_returnflag) FROM (TABLE old EXCEPT ALL TABLE new)
        UNION SELECT (l_linestatus, l_returnflag) FROM (TABLE new EXCEPT ALL TABLE old)) GROUP BY 1, 2""")
def differing_partitions(t: Tables) -> DataFrame:
    """Partitions whose content differs between two frames, by fingerprints."""
    by = ["l_linestatus", "l_returnflag"]
    return contents.differing(*[contents.fingerprints(df, by) for df in _edited(t)], by)


@query(_EDITED + """
    SELECT *, CAST(-1 AS BIGINT) AS change FROM (TABLE old EXCEPT ALL TABLE new)
    UNION ALL SELECT *, CAST(1 AS BIGINT) FROM (TABLE new EXCEPT ALL TABLE old)""")
def changed_rows_of_versions(t: Tables) -> DataFrame:
    """Two stored versions, compared by the fingerprints kept with them; rows are
    read of the differing partitions alone."""
    wh, by = t.warehouse("contents"), ["l_linestatus", "l_returnflag"]
    ids = []
    for df in _edited(t):
        ids.append(tables.replace_table(wh, df, "silver.lines", ", ".join(by)))
        rewrite.record_contents(wh, "silver.lines", ids[-1], by)
    return rewrite.changed_between(wh, "silver.lines", *ids, by).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", "l_returnflag", "change")


@query("""
    SELECT layer, job_name, status, rows_in, rows_out, error_msg FROM (
        SELECT 'bronze' AS layer, 'copy_lines' AS job_name, 'success' AS status, count(*) AS rows_in, count(*) AS rows_out,
               '' AS error_msg FROM lineitem
        UNION ALL SELECT 'silver', 'unique_lines', 'failed', 0, 0, 'lines are not unique' FROM lineitem
        HAVING count(*) > count(DISTINCT (l_orderkey, l_linenumber)))""")
def job_metrics(t: Tables) -> DataFrame:
    """Two jobs over the line items: one succeeds, one fails and is re-raised."""
    wh = t.warehouse("jobs")
    with job_run(wh, "bronze", "copy_lines", run_id="r1") as run:
        tables.replace_table(wh, run.watch(run.watch(t.lineitem, "rows_in"), "rows_out"), "bronze.lines")
    try:
        with job_run(wh, "silver", "unique_lines", run_id="r1"):
            surplus = aggregates.duplicate_surplus(wh.table("bronze.lines"), ["l_orderkey", "l_linenumber"]).first()
            if surplus["duplicates"]:
                raise ValueError("lines are not unique")
    except ValueError:
        pass
    return wh.table("meta.job_log").select("layer", "job_name", "status", "rows_in", "rows_out", "error_msg")
