"""Change propagation: a batch of new source rows, from bronze to the marts.

A full run rebuilds every table. Here a batch touches what it changes:

1. The keys in the batch name the touched orders, and with them the slots
   (partitions) of the tables to read. A slot is a function of the key: ranges where
   ids grow with time, hashes elsewhere (``Layout``).
2. The current silver rows of these keys and the batch give the new silver rows. The
   survivor of a key is the least or latest row by a total order, so survivors of a
   part and of the rest give the survivor of the whole.
3. Fact rows of the touched orders are made anew, and each mart gets the signed
   partial sums of the old and the new rows (``operators.delta``).
4. All of this is written to a folder of the batch before any table changes. Then
   the touched slots are rewritten and the sums folded into the states, from which
   the marts are made. A run that dies in between is taken up from the folder; a
   slot can be written twice, and a state knows the batch it holds.

Dimension rows that change (a customer moves to another state, a product to another
category) touch the orders that refer to them; only then facts are searched without
a slot. Reviews have the slot of their own id, since the order of a surviving review
can change; those of touched orders are searched by order.

Rows whose key names no slot (a NULL order_id, review_id, customer_id or product_id)
are left out; a full run keeps such items, payments and reviews in their tables, and
the bronze suite reports them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import MONEY, as_amount, percent, reached
from ..operators.delta import ROWS, difference, folded, partial_sums
from ..schema import CALENDAR_RANGE
from ..sinks.tables import Warehouse, append_rows, replace_tables, upsert_partitions
from ..sources.files import inline_rows
from . import gold, marts, silver

LOG = "meta.propagation"
LOG_SCHEMA = "batch_id bigint, step string, at timestamp"
SUM = "decimal(38,2)"
PERSONS = "platinum.state_persons"
AT_ONCE = 4     # writes that run at the same time


@dataclass(frozen=True)
class Layout:
    """How keys are dealt into slots. ``of`` maps a key column to a whole number; the
    default hashes into ``slots``."""

    slots: int = 256
    of: Callable[[Column], Column] | None = None

    def slot(self, key: str) -> Column:
        hashed = F.pmod(F.xxhash64(key), F.lit(self.slots))
        return (self.of(F.col(key)) if self.of else hashed).cast("bigint")


# table -> (key, column that names the slot)
KEYS = {
    "orders": (["order_id"], "order_id"), "order_items": (["order_id", "order_item_id"], "order_id"),
    "order_payments": (["order_id", "payment_sequential"], "order_id"), "order_reviews": (["review_id"], "review_id"),
    "customers": (["customer_id"], "customer_id"), "products": (["product_id"], "product_id"),
}
DIMENSIONS = ("customers", "products")
FACTS = {
    "fact_orders": (["order_id"], "order_id"), "fact_order_items": KEYS["order_items"],
    "fact_reviews": KEYS["order_reviews"], "fact_payments": KEYS["order_payments"],
}


# facts that are columns of silver rows: made where they are read, not stored with a batch
COLUMNS_OF = {
    "fact_order_items": ("order_items", gold.fact_order_items), "fact_reviews": ("order_reviews", gold.fact_reviews),
    "fact_payments": ("order_payments", lambda paid: paid.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")),
}


@dataclass(frozen=True)
class Star:
    """Facts and dimensions, all of them or those of some orders."""

    orders: DataFrame
    items: DataFrame
    reviews: DataFrame
    payments: DataFrame
    customers: DataFrame
    products: DataFrame
    dates: DataFrame


# mart -> the columns of its groups
GROUPS = {
    "monthly_revenue": ["year", "month"], "state_performance": ["state"], "category_ranking": ["category_name_english"],
    "delivery_kpi": ["whole"], "review_by_category": ["category_name_english"], "payment_distribution": ["payment_type"],
    "customer_retention": ["whole"],
}


def _amount(column: str) -> Column:
    return F.col(column).cast(MONEY)


def _again(df: DataFrame, groups: list[str], sums: list[str]) -> DataFrame:
    """Partial rows, joined with a dimension, summed by its columns."""
    return df.groupBy(*groups).agg(F.sum(ROWS).alias(ROWS), *[F.sum(c).alias(c) for c in sums])


def _typed(df: DataFrame, groups: list[str]) -> DataFrame:
    """Sums in the types of a state."""
    return df.select(*groups, *[
        F.coalesce(F.col(c), F.lit(0)).cast(SUM if c in ("revenue", "value") else "bigint").alias(c) for c in df.columns if c not in groups])


def partial_marts(s: Star) -> dict[str, DataFrame]:
    """The partial sums of each mart over a star; facts meet a dimension after they
    are summed by its key."""
    whole = F.lit(0).alias("whole")
    sold = marts.revenue_orders(s.orders)
    days = s.dates.select(F.col("date_id").alias("purchase_date_id"), "year", "month")
    daily = partial_sums(sold, ["purchase_date_id"], {"revenue": _amount("total_revenue")})
    placed = partial_sums(sold, ["customer_id"], {
        "revenue": _amount("total_revenue"), "days": F.col("delivery_days"), "delivered": F.col("delivery_days").isNotNull().cast("int")})
    per_product = partial_sums(s.items.join(sold.select("order_id"), "order_id", "left_semi"), ["product_id"], {"revenue": _amount("price")})
    done = reached("order_status", "delivered", "delivery_days")
    counted = s.orders.select(whole, "delivery_days", done.alias("_done"), (done & F.col("is_late_delivery")).alias("_late"))
    per_order = partial_sums(s.reviews, ["order_id"], {
        "score": F.col("review_score"), "scored": F.col("review_score").isNotNull().cast("int"), "reviews": F.col("review_id").isNotNull().cast("int")})
    # of reviewed orders alone; once dealt by order, they need no other shuffle
    categories = marts.order_category(s.items.join(per_order.select("order_id"), "order_id", "left_semi"), s.products, [])
    out = {
        "monthly_revenue": _again(daily.join(days, "purchase_date_id"), ["year", "month"], ["revenue"]),
        "state_performance": _again(placed.join(s.customers.select("customer_id", "state"), "customer_id"), ["state"], ["revenue", "days", "delivered"]),
        "category_ranking": _again(per_product.join(s.products.select("product_id", "category_name_english"), "product_id"), ["category_name_english"], ["revenue"]),
        "delivery_kpi": partial_sums(counted, ["whole"], {
            "days": F.col("delivery_days"), "timed": F.col("delivery_days").isNotNull().cast("int"), "delivered": F.col("_done").cast("int"),
            "late": F.col("_late").cast("int")}),
        "review_by_category": _again(per_order.join(categories, "order_id"), ["category_name_english"], ["score", "scored", "reviews"]),
        "payment_distribution": partial_sums(s.payments, ["payment_type"], {"value": _amount("payment_value")}),
    }
    return {mart: _typed(df, GROUPS[mart]) for mart, df in out.items()}


def person_orders(s: Star) -> DataFrame:
    """Orders of each person: person (a text that NULL has as well), n_rows."""
    per_customer = partial_sums(s.orders, ["customer_id"], {})
    name = F.coalesce(F.concat(F.lit("="), F.col("customer_unique_id").cast("string")), F.lit("none")).alias("person")
    return _typed(_again(per_customer.join(s.customers.select("customer_id", name), "customer_id"), ["person"], []), ["person"])


def retention_sums(persons: DataFrame) -> DataFrame:
    """Persons with orders, and with several, from n_rows of each."""
    held = persons.filter(F.col(ROWS) > 0).select(F.lit(0).alias("whole"), (F.col(ROWS) >= 2).cast("int").alias("_again"))
    return _typed(partial_sums(held, ["whole"], {"repeated": F.col("_again")}), ["whole"])


def mart_of(name: str, state: DataFrame) -> DataFrame:
    """A mart from its state, with the columns and the order of ``plans.marts``."""
    mean = lambda total, n: F.round(F.try_divide(F.col(total), F.col(n)), 2)
    n = F.col(ROWS)
    if name == "monthly_revenue":
        return state.select("year", "month", as_amount("revenue").alias("revenue"), n.alias("order_count")).orderBy("year", "month")
    if name == "state_performance":
        return state.select("state", n.alias("order_count"), as_amount("revenue").alias("revenue"), mean("days", "delivered").alias("avg_delivery_days")).orderBy(
            F.desc("order_count"), "state")
    if name == "category_ranking":
        return state.select("category_name_english", as_amount("revenue").alias("revenue"), n.alias("items_sold")).orderBy(F.desc("revenue"), "category_name_english")
    if name == "delivery_kpi":
        return state.select(n.alias("total_orders"), mean("days", "timed").alias("avg_delivery_days"), percent("late", "delivered").alias("late_delivery_rate_pct"))
    if name == "review_by_category":
        return state.select("category_name_english", mean("score", "scored").alias("avg_review_score"), F.col("reviews").alias("review_count")).orderBy(
            F.desc("avg_review_score"), "category_name_english")
    if name == "payment_distribution":
        return state.select("payment_type", n.alias("payment_count"), as_amount("value").alias("total_value")).orderBy(F.desc("payment_count"), "payment_type")
    if name == "customer_retention":
        return state.select(n.alias("total_customers"), F.col("repeated").alias("repeat_customers"), percent("repeated", ROWS).alias("retention_rate_pct"))
    raise ValueError(f"no mart {name!r}")


# ---- a batch -----------------------------------------------------------------------

def _folder(wh: Warehouse, batch: int) -> str:
    return f"{wh.location('meta.propagation')}/batch={batch}"


def _steps(wh: Warehouse) -> dict[str, int]:
    """The last batch that reached each step. Two control rows reach the driver."""
    if not wh.exists(LOG):
        return {}
    return {r["step"]: r["batch"] for r in wh.table(LOG).groupBy("step").agg(F.max("batch_id").alias("batch")).collect()}


def _logged(wh: Warehouse, batch: int, step: str) -> None:
    append_rows(wh, inline_rows(wh.spark, [(batch, step, datetime.now(timezone.utc))], LOG_SCHEMA), LOG)


class _Batch:
    """The work on one batch: what it reads, and where it writes before it applies."""

    def __init__(self, wh: Warehouse, number: int, changes: dict[str, DataFrame], layout: Layout, translation: DataFrame, dates: DataFrame):
        self.wh, self.changes, self.layout, self.translation, self.dates = wh, changes, layout, translation, dates
        self.folder = _folder(wh, number)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.wh.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def keep_all(self, folder: str, built: dict[str, DataFrame]) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return dict(zip(built, pool.map(lambda name: self.keep(f"{folder}/{name}", built[name]), built)))

    def current(self, name: str, ids: DataFrame, key: str, slot_of: str | None) -> DataFrame | None:
        """Rows of a table whose ``key`` is among ``ids``. Where the key names the slot,
        only slots that occur in ``ids`` are read: their numbers, at most one for each
        partition of the table, reach the driver."""
        if not self.wh.exists(name):
            return None
        rows = self.wh.table(name)
        if slot_of == key:
            slots = [r[0] for r in ids.select(self.layout.slot(key).alias("slot")).distinct().collect()]
            rows = rows.filter(F.col("slot").isin(slots))
        return rows.join(ids, key, "left_semi").drop("slot")

    def both(self, table: str, ids: DataFrame, key: str, incoming: DataFrame) -> DataFrame:
        old = self.current(f"silver.{table}", ids, key, KEYS[table][1])
        return incoming if old is None else old.unionByName(incoming, allowMissingColumns=True)

    def new_silver(self, table: str) -> DataFrame:
        """New rows of the keys in the batch (of items and payments: of its orders)."""
        incoming = silver.typed(self.changes[table], table)
        key = KEYS[table][1]
        incoming = incoming.filter(F.col(key).isNotNull())
        ids = incoming.select(key).distinct()
        if table == "orders":
            return silver.orders(self.both(table, ids, key, incoming).drop("order_duration_days"))
        if table == "products":
            return self.both_named(incoming, ids)
        if table == "order_payments":
            old = self.current("silver.order_payments", ids, key, key)
            total = F.sum(F.col("payment_value").cast(MONEY))
            now = incoming.groupBy(key).agg(total.alias("_new"))
            rows = incoming if old is None else old.drop("total_payment_value").unionByName(incoming, allowMissingColumns=True)
            kept = silver.dedupe(rows, KEYS[table][0]).join(now, key)
            if old is not None:
                before = old.groupBy(key).agg(F.max("total_payment_value").cast(SUM).alias("_old"))
                kept = kept.join(before, key, "left").withColumn("_new", F.coalesce(F.col("_new") + F.col("_old"), "_new", "_old")).drop("_old")
            return kept.withColumn("total_payment_value", F.col("_new").cast("double")).drop("_new")
        return silver.TABLES[table][0](self.both(table, ids, key, incoming))

    def both_named(self, incoming: DataFrame, ids: DataFrame) -> DataFrame:
        """Products: the English name follows the surviving row's category."""
        old = self.current("silver.products", ids, "product_id", "product_id")
        rows = incoming if old is None else old.drop("product_category_name_english").unionByName(incoming, allowMissingColumns=True)
        return silver.products(rows, self.translation)


def _star(orders, items, reviews, payments, customers, products, dates) -> Star:
    return Star(orders, items, reviews, payments, gold.dim_customer(customers), gold.dim_product(products), dates)


def _replaced(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    if old is None:
        return new
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def _stage(b: _Batch) -> None:
    """Write what the batch changes: new silver rows, new fact rows, signed sums."""
    wh = b.wh
    new = b.keep_all("silver", {t: b.new_silver(t) for t in KEYS if t in b.changes})

    def ids(*frames: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, [f.select("order_id") for f in frames]).filter("order_id is not null").distinct()

    # every table takes part, if only with its columns
    empty = {t: wh.table(f"silver.{t}").drop("slot").limit(0) if t not in new else new[t].limit(0) for t in KEYS if t in new or wh.exists(f"silver.{t}")}
    missing = set(KEYS) - set(empty)
    if missing:
        raise ValueError(f"the first batch has to hold every table, not {sorted(set(KEYS) - missing)} alone")
    fresh = {t: new.get(t, empty[t]) for t in KEYS}
    touched = [fresh["orders"], fresh["order_items"], fresh["order_reviews"]]
    old_reviews = b.current("silver.order_reviews", fresh["order_reviews"].select("review_id"), "review_id", "review_id")
    if old_reviews is not None:
        touched.append(old_reviews)
    for table, key, fact in (("customers", "customer_id", "gold.fact_orders"), ("products", "product_id", "gold.fact_order_items")):
        if table in new and wh.exists(fact):
            touched.append(wh.table(fact).join(new[table].select(key), key, "left_semi"))
    orders = b.keep("touched", ids(*touched))
    paid = fresh["order_payments"].select("order_id").distinct()

    def old(name: str, of: DataFrame, key: str, slot_of: str | None, like: DataFrame) -> DataFrame:
        rows = b.current(name, of, key, slot_of)
        return like if rows is None else rows

    # the silver rows of the touched orders, before and after
    before = {
        "orders": old("silver.orders", orders, "order_id", "order_id", empty["orders"]),
        "order_items": old("silver.order_items", orders, "order_id", "order_id", empty["order_items"]),
        "order_payments": old("silver.order_payments", paid, "order_id", "order_id", empty["order_payments"]),
        "order_reviews": old("silver.order_reviews", orders, "order_id", "review_id", empty["order_reviews"]),
    }
    # a table that is not there yet has nothing to give way
    held = [t for t in before if wh.exists(f"silver.{t}")]
    before |= b.keep_all("before", {t: before[t] for t in held})
    after = fresh | b.keep_all("after", {t: _replaced(before[t], fresh[t], KEYS[t][0]) for t in held})
    dims = {t: wh.table(f"silver.{t}").drop("slot") if wh.exists(f"silver.{t}") else empty[t] for t in DIMENSIONS}
    new_dims = {t: _replaced(dims[t], fresh[t], KEYS[t][0]) for t in DIMENSIONS}
    facts = {"fact_orders": b.keep("gold/fact_orders", gold.fact_orders(after["orders"], after["order_items"]))}
    facts |= {fact: columns(after[table]) for fact, (table, columns) in COLUMNS_OF.items()}
    was = _star(
        b.keep("before/facts", old("gold.fact_orders", orders, "order_id", "order_id", facts["fact_orders"].limit(0))), gold.fact_order_items(before["order_items"]),
        gold.fact_reviews(before["order_reviews"]), before["order_payments"], dims["customers"], dims["products"], b.dates)
    now = _star(facts["fact_orders"], facts["fact_order_items"], facts["fact_reviews"], facts["fact_payments"], new_dims["customers"], new_dims["products"], b.dates)
    sums_before, sums_after = partial_marts(was), partial_marts(now)
    b.keep_all("delta", {mart: difference(sums_before[mart], sums_after[mart], GROUPS[mart]) for mart in sums_after})
    # persons: what their orders change, and what they had
    moved = b.keep("persons", difference(person_orders(was), person_orders(now), ["person"]))
    slots = F.pmod(F.xxhash64("person"), F.lit(b.layout.slots))
    had = moved.select("person").limit(0).withColumn(ROWS, F.lit(0).cast("bigint"))
    if wh.exists(PERSONS):
        numbers = [r[0] for r in moved.select(slots.alias("slot")).distinct().collect()]
        had = wh.table(PERSONS).filter(F.col("slot").isin(numbers)).join(moved.select("person"), "person", "left_semi").select("person", ROWS)
    have = had.unionByName(moved).groupBy("person").agg(F.sum(ROWS).alias(ROWS))
    have = b.keep("persons_after", have.withColumn("slot", slots.cast("bigint")))
    b.keep("delta/customer_retention", difference(retention_sums(had), retention_sums(have), ["whole"]))


def _apply(wh: Warehouse, batch: int, layout: Layout) -> dict[str, list]:
    """Rewrite the touched slots and fold the sums; returns the slots by table."""
    spark, folder = wh.spark, _folder(wh, batch)
    rewritten = {}

    def staged(name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    for layer, tables in (("silver", KEYS), ("gold", FACTS)):
        for table, (keys, slot_of) in tables.items():
            if table in COLUMNS_OF:
                source, columns = COLUMNS_OF[table]
                rows = staged(f"after/{source}")
                rows = columns(staged(f"silver/{source}") if rows is None else rows)
            else:
                rows = staged(f"{layer}/{table}")
            if rows is not None:
                rewritten[f"{layer}.{table}"] = (rows.withColumn("slot", layout.slot(slot_of)), keys)
    rewritten[PERSONS] = (staged("persons_after"), ["person"])
    with ThreadPoolExecutor(AT_ONCE) as pool:
        slots = pool.map(lambda name: upsert_partitions(wh, rewritten[name][0], name, rewritten[name][1], "slot"), rewritten)
        written = dict(zip(rewritten, slots))
    states = {}
    for mart, groups in GROUPS.items():
        name, delta = f"platinum.state_{mart}", staged(f"delta/{mart}")
        held = wh.table(name) if wh.exists(name) else None
        if held is None or (held.agg(F.max("batch")).first()[0] or 0) < batch:
            state = delta.limit(0) if held is None else held.drop("batch").filter(F.col(ROWS) != 0)
            # a row of no group keeps the batch where the state is empty
            marker = delta.limit(0).unionByName(spark.range(1).select(F.lit(0).cast("bigint").alias(ROWS)), allowMissingColumns=True)
            states[name] = folded(state, delta, groups).unionByName(marker).withColumn("batch", F.lit(batch))
    replace_tables(wh, states)
    replace_tables(wh, {f"platinum.mart_{mart}": mart_of(mart, wh.table(f"platinum.state_{mart}").filter(F.col(ROWS) != 0)) for mart in GROUPS})
    return written


def propagate(
    wh: Warehouse, batch: int, changes: dict[str, DataFrame], translation: DataFrame, layout: Layout = Layout(),
    calendar: tuple[str, str] = CALENDAR_RANGE,
) -> dict[str, list]:
    """Bring batch number ``batch`` (1, 2, ...) of new bronze rows, by source table, to
    silver, gold and the marts, and return the slots that were rewritten. A batch that
    was applied before is passed over; one that was staged is taken up there. The
    first batch holds every table. A warehouse is either propagated or rebuilt."""
    unknown = set(changes) - set(KEYS)
    if unknown:
        raise ValueError(f"no propagation for {sorted(unknown)}")
    steps = _steps(wh)
    applied = steps.get("applied", 0)
    if batch <= applied:
        return {}
    if batch != applied + 1:
        raise ValueError(f"batch {applied + 1} comes next, not {batch}")
    if steps.get("staged", 0) < batch:
        _stage(_Batch(wh, batch, changes, layout, translation, gold.dim_date(wh.spark, *calendar)))
        _logged(wh, batch, "staged")
    written = _apply(wh, batch, layout)
    _logged(wh, batch, "applied")
    return written
