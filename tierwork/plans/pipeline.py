"""The layered jobs, from source tables to marts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.incremental import LEDGER, MEMBERS, load_increment, loaded_rows, publish_watermarks
from ..operators.profile_states import STATES
from ..operators.quality import check_suite, gate, row_measures
from ..operators.skew import hot_keys
from ..schema import CALENDAR_RANGE, INCREMENTAL, PARTITIONED_BY, PURCHASE_WINDOW, SOURCE_COLUMNS, TABLE_KEYS
from ..sinks.tables import (
    VERSIONS, Version, Warehouse, columns_of, log_rows, publish, publish_staged, recorded_rows, replace_tables, stage_tables,
)
from ..sinks.rewrite import CONTENTS
from ..sources.files import read_csv, total_rows, with_provenance
from ..sources.jdbc import JdbcSource, Slices, read_table
from . import gold, marts, silver, suites
from .metrics import JOB_LOG, job_run

DQ_RESULTS = "meta.dq_results"
GOLD_TABLES = [
    "dim_customer", "dim_product", "dim_seller", "dim_date", "dim_payment_type",
    "fact_orders", "fact_order_items", "fact_reviews", "fact_payments",
]

Reader = Callable[[str], DataFrame]


def csv_reader(spark: SparkSession, folder: str, files: dict[str, str] | None = None, **options) -> Reader:
    """Read source tables from CSV files, by default ``<table>.csv``."""
    names = files or {}
    return lambda table: read_csv(spark, f"{folder}/{names.get(table, table + '.csv')}", SOURCE_COLUMNS[table], **options)


def jdbc_reader(spark: SparkSession, source: JdbcSource, slices: dict[str, Slices] | None = None) -> Reader:
    """Read source tables from a database, sliced where ``slices`` names a table."""
    cuts = slices or {}
    return lambda table: read_table(spark, source, table, cuts.get(table))


def attach(wh: Warehouse) -> list[str]:
    """Register the tables of an existing warehouse in a catalog that does not
    know them, such as that of a new session without a metastore: the last
    version of each replaced table, the committed batches of each incremental
    one, and the logs. Returns the names. One row per table reaches the driver.
    """
    def log(name: str) -> DataFrame | None:
        try:
            rows = wh.spark.read.parquet(f"{wh.location(name)}/rows")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        publish(wh, name, f"{wh.location(name)}/rows")
        return rows

    versions, ledger = log(VERSIONS), log(LEDGER)
    for name in (DQ_RESULTS, JOB_LOG, MEMBERS, CONTENTS, STATES):
        log(name)
    found = []
    if versions is not None:
        latest = versions.groupBy("table_name").agg(*[
            F.max_by(c, "committed_at").alias(c) for c in ("location", "columns") if c in versions.columns])
        for row in latest.collect():
            publish(wh, row["table_name"], row["location"], columns=columns_of(row))
            found.append(row["table_name"])
    if ledger is not None:
        for row in ledger.groupBy("table_name").agg(F.max("batch_id").alias("batch")).collect():
            publish(wh, row["table_name"], wh.location(row["table_name"]), f"batch_id <= {row['batch']}")
            found.append(row["table_name"])
        publish_watermarks(wh)
    return sorted(found)


def _rows(wh: Warehouse, names: list[str]) -> int:
    """Rows of tables as the logs record them, without reading the tables."""
    if wh.table_format != "parquet":
        return total_rows(wh.spark, [wh.catalog_name(n) for n in names])
    return recorded_rows(wh, names) + loaded_rows(wh, names)


def _written(versions: dict[str, Version]) -> int:
    return sum(v.row_count for v in versions.values())


Suite = Callable[[dict[str, DataFrame]], suites.Entries]


def audited_replace(
    wh: Warehouse, layer: str, steps: list[Callable[[dict[str, DataFrame]], dict[str, DataFrame]]], suite: Suite,
    partitioned_by: dict[str, str] | None = None,
) -> dict[str, Version]:
    """Write new versions of a layer's tables, run its suite over them, and publish
    them together only when every check passes; otherwise readers stay on the
    versions they have, and :class:`QualityError` is raised.

    Each step makes tables from those written before it. The row-local checks are
    aggregated in the stage that writes, so the audit reads the new files only for
    uniqueness, foreign keys and counts, and only the columns of those. ``suite`` is
    called with the frames once before they are written, for the list of their row
    checks, and once with what was written."""
    staged, frames = {}, {}
    for step in steps:
        built = step(frames)
        listed = {table: checks for table, _, checks in suite({**frames, **built})}
        staged |= stage_tables(wh, built, partitioned_by, {t: row_measures(listed.get(t, [])) for t in built})
        frames |= {t: staged[t].rows(wh.spark) for t in built}
    results = check_suite(layer, suite(frames), {t: s.measured for t, s in staged.items()})
    gate(wh.spark, results, save=lambda rows: log_rows(wh, rows, DQ_RESULTS))
    return publish_staged(wh, staged)


def ingest_bronze(
    wh: Warehouse, read: Reader, tables=tuple(SOURCE_COLUMNS), run_ts: datetime | None = None, lookback: timedelta | None = None,
    audit: bool = False,
) -> None:
    """Load every source table: incrementally where a watermark is defined, as a
    whole otherwise. The job's row counts are the rows it took in, of an
    incremental table the new ones, and the rows it wrote. ``lookback`` also finds
    late rows of incremental tables, told apart by their keys. With ``audit`` the
    replaced tables are published only when the bronze suite passes; an increment
    is committed with its ledger row before that."""
    with job_run(wh, "bronze", "bronze_ingest") as run:
        sources = {t: read(t) for t in tables}
        loads = [
            load_increment(
                wh, with_provenance(sources.pop(table), table, run_ts), f"bronze.{table}", *INCREMENTAL[table], lookback=lookback,
                keys=TABLE_KEYS[table], run_ts=run_ts)
            for table in [t for t in tables if t in INCREMENTAL]]
        new = sum(load.row_count for load in loads)
        # rows are counted below the constants of the load: above, each row would format the day again
        whole = {f"bronze.{t}": with_provenance(run.watch(df, "rows_in"), t, run_ts) for t, df in sources.items()}
        specs = {f"bronze.{t}": spec for t, spec in PARTITIONED_BY.items()}
        if audit:
            versions = audited_replace(wh, "bronze", [lambda _: whole], lambda made: suites.bronze_checks({
                t: made[f"bronze.{t}"] if f"bronze.{t}" in made else wh.table(f"bronze.{t}") for t in tables}), specs)
        else:
            versions = replace_tables(wh, whole, specs)
        run.rows_in, run.rows_out = new, new + _written(versions)


def _silver_suite(window: tuple[str, str]) -> Suite:
    return lambda t: suites.silver_checks(*[t[f"silver.{name}"] for name in ("orders", "order_items", "order_payments", "order_reviews")], window)


def build_silver(wh: Warehouse, audit: tuple[str, str] | None = None) -> None:
    """``audit`` is the window of valid purchase times: with it the tables are
    published only when the silver suite passes."""
    with job_run(wh, "silver", "silver_transform") as run:
        run.rows_in = _rows(wh, [f"bronze.{t}" for t in SOURCE_COLUMNS])
        built = {
            f"silver.{table}": build(*[wh.table(f"bronze.{t}") for t in inputs])
            for table, (build, inputs) in silver.STORED.items()
        }
        run.rows_out = _written(
            replace_tables(wh, built) if audit is None else audited_replace(wh, "silver", [lambda _: built], _silver_suite(audit)))


def build_gold(wh: Warehouse, calendar: tuple[str, str] = CALENDAR_RANGE, audit: bool = False) -> None:
    """Dimensions first: the payment fact takes its surrogate key from one. With
    ``audit`` dimensions and facts are published together, when the suite passes."""
    s = {t: wh.table(f"silver.{t}") for t in silver.TABLES}

    def dimensions(_: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {
            "gold.dim_customer": gold.dim_customer(s["customers"]), "gold.dim_product": gold.dim_product(s["products"]),
            "gold.dim_seller": gold.dim_seller(s["sellers"]), "gold.dim_date": gold.dim_date(wh.spark, *calendar),
            "gold.dim_payment_type": gold.dim_payment_type(s["order_payments"]),
        }

    def facts(made: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {
            "gold.fact_orders": gold.fact_orders(s["orders"], s["order_items"]),
            "gold.fact_order_items": gold.fact_order_items(s["order_items"]),
            "gold.fact_reviews": gold.fact_reviews(s["order_reviews"]),
            "gold.fact_payments": gold.fact_payments(s["order_payments"], made["gold.dim_payment_type"]),
        }

    def suite(made: dict[str, DataFrame]) -> suites.Entries:
        if len(made) < len(GOLD_TABLES):    # the dimensions, which have row checks of their own
            return suites.dimension_checks({name.split(".")[1]: df for name, df in made.items()})
        return suites.gold_checks({name.split(".")[1]: df for name, df in made.items()}, s["orders"])

    with job_run(wh, "gold", "gold_build") as run:
        run.rows_in = _rows(wh, [f"silver.{t}" for t in silver.TABLES])
        if audit:
            run.rows_out = _written(audited_replace(wh, "gold", [dimensions, facts], suite))
        else:
            first = replace_tables(wh, dimensions({}))
            second = replace_tables(wh, facts({name: wh.table(name) for name in first}))
            run.rows_out = _written(first) + _written(second)


def build_platinum(wh: Warehouse) -> None:
    """The marts. Order and review ids are unique here: silver made them so and
    the gold suite checks it."""
    g = {t: wh.table(f"gold.{t}") for t in GOLD_TABLES}
    orders, items, customers, products = g["fact_orders"], g["fact_order_items"], g["dim_customer"], g["dim_product"]
    with job_run(wh, "platinum", "platinum_build_marts") as run:
        run.rows_in = _rows(wh, [f"gold.{t}" for t in GOLD_TABLES])
        hot = hot_keys(items, ["order_id"], other=orders)
        built = {
            "monthly_revenue": marts.monthly_revenue(orders, g["dim_date"], orders_unique=True),
            "state_performance": marts.state_performance(orders, customers, orders_unique=True),
            "category_ranking": marts.category_ranking(items, orders, products, hot),
            "delivery_kpi": marts.delivery_kpi(orders),
            "review_by_category": marts.review_by_category(g["fact_reviews"], items, products, reviews_unique=True, hot_item_orders=hot),
            "payment_distribution": marts.payment_distribution(g["fact_payments"]),
            "customer_retention": marts.customer_retention(orders, customers, orders_unique=True),
        }
        run.rows_out = _written(replace_tables(wh, {f"platinum.mart_{name}": df for name, df in built.items()}))


def validate(wh: Warehouse, layer: str, window: tuple[str, str] = PURCHASE_WINDOW) -> list:
    """Run a layer's suite as a gate; the results go to the quality log first.
    ``window`` bounds the purchase times of the silver suite."""
    def named(tables, source=layer):
        return {t: wh.table(f"{source}.{t}") for t in tables}

    if layer == "bronze":
        results = suites.bronze(named(SOURCE_COLUMNS))
    elif layer == "silver":
        t = named(silver.TABLES)
        results = suites.silver(t["orders"], t["order_items"], t["order_payments"], t["order_reviews"], window)
    elif layer == "gold":
        results = suites.gold(named(GOLD_TABLES), wh.table("silver.orders"))
    else:
        raise ValueError(f"no quality suite for layer {layer!r}")
    return gate(wh.spark, results, save=lambda rows: log_rows(wh, rows, DQ_RESULTS))


def run_all(
    wh: Warehouse, read: Reader, run_ts: datetime | None = None, calendar: tuple[str, str] = CALENDAR_RANGE,
    lookback: timedelta | None = None,
) -> None:
    """One full run with the gates between the layers: a layer is published when
    its suite has passed over what was written. ``calendar`` gives the first and last
    day of the date dimension and of valid purchase times. A table format replaces
    tables in one step, so there the suite runs after it."""
    wh.bootstrap()
    audit = wh.table_format == "parquet"
    ingest_bronze(wh, read, run_ts=run_ts, lookback=lookback, audit=audit)
    if not audit:
        validate(wh, "bronze")
    build_silver(wh, calendar if audit else None)
    if not audit:
        validate(wh, "silver", calendar)
    build_gold(wh, calendar, audit)
    if not audit:
        validate(wh, "gold")
    build_platinum(wh)
