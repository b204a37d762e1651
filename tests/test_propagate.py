"""Batches brought to the marts, against a full rebuild from all rows."""

import random
import uuid
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierwork.operators.delta import difference, folded, partial_sums
from tierwork.plans import gold, marts, propagate, silver
from tierwork.plans.propagate import FACTS, GROUPS, KEYS, LOG, Layout
from tierwork.schema import SOURCE_COLUMNS
from tierwork.sources.files import inline_rows, listed_rows
from tierwork.sinks.tables import Warehouse, upsert_partitions

LAYOUT = Layout(slots=4, of=lambda key: F.floor(F.substring(key, 2, 9).cast("int") / 20))
SCHEMAS = {t: ", ".join(f"{c} {k}" for c, k in SOURCE_COLUMNS[t].items()) for t in (*KEYS, "category_translation")}


@pytest.fixture
def wh(spark, tmp_path):
    made = Warehouse(spark, f"{tmp_path}/wh", namespace=f"g{uuid.uuid4().hex[:10]}_")
    made.bootstrap()
    return made


def order(rnd, number, version=0):
    bought = datetime(2017, 1, 1) + timedelta(days=number)
    status = rnd.choice(["delivered", "shipped", "canceled", "unavailable", None])
    arrived = bought + timedelta(days=rnd.randrange(1, 40)) if status == "delivered" else None
    return (f"o{number}", f"c{rnd.randrange(14)}", status, bought, None, None, arrived, bought + timedelta(days=15), bought + timedelta(days=version))


def item(rnd, number, line):
    return (f"o{number}", line, f"p{rnd.randrange(12)}", f"s{rnd.randrange(3)}", None, rnd.randrange(1, 9999) / 100, 1.1)


def payment(rnd, number, line):
    return (f"o{number}", line, rnd.choice(["credit_card", "boleto", None]), 1, rnd.choice([None, rnd.randrange(1, 9999) / 100]))


def review(rnd, number):
    return (f"r{number}", f"o{rnd.randrange(80)}", rnd.choice([1, 2, 5, None]), None, rnd.choice([None, "good"]), datetime(2017, 5, 1), None)


def batches(rnd):
    """Three batches: most rows; then changes of old orders, late items, second
    payments, moved customers; then changes of dimensions and reviews alone."""
    first = {
        "orders": [order(rnd, n) for n in range(60)], "order_items": [item(rnd, n, k) for n in range(60) for k in range(rnd.randrange(4))],
        "order_payments": [payment(rnd, n, 1) for n in range(60)], "order_reviews": [review(rnd, n) for n in range(40)],
        "customers": [(f"c{n}", f"u{n // 2}", n, "town", rnd.choice(["sp", "rj"])) for n in range(10)] + [("c10", None, 1, "x", None)],
        "products": [(f"p{n}", rnd.choice(["toys", "tools", None, "  "]), *[n] * 7) for n in range(10)],
    }
    second = {
        "orders": [order(rnd, n, 3) for n in (1, 2, 3, 61, 62)] + [order(rnd, 61, 4)] * 2 + [(None, *order(rnd, 1)[1:])],
        "order_items": [item(rnd, n, 9) for n in (1, 5, 59, 61, 70)] + [item(rnd, 2, 1), item(rnd, 2, 1)],
        "order_payments": [payment(rnd, n, k) for n in (3, 61) for k in (1, 2)], "order_reviews": [review(rnd, n) for n in (5, 6, 41, 42)],
        "customers": [("c3", "u1", 3, "town", "ba"), ("c12", "u6", 12, "town", "sp")], "products": [("p11", "toys", *[1] * 7)],
    }
    third = {"products": [("p1", "a first name", *[0] * 7)], "order_reviews": [review(rnd, 5), review(rnd, 50)]}
    return [first, second, third]


def frames(spark, batch):
    return {t: spark.createDataFrame(rows, SCHEMAS[t]) for t, rows in batch.items()}


def rebuilt(spark, given, translation):
    """Facts and marts from all rows at once."""
    rows = {t: spark.createDataFrame([r for b in given for r in b.get(t, [])], SCHEMAS[t]) for t in KEYS}
    s = {t: silver.TABLES[t][0](*([rows[t], translation] if t == "products" else [rows[t]])) for t in KEYS}
    orders, items = gold.fact_orders(s["orders"], s["order_items"]), gold.fact_order_items(s["order_items"])
    reviews, customers, products = gold.fact_reviews(s["order_reviews"]), gold.dim_customer(s["customers"]), gold.dim_product(s["products"])
    dates = gold.dim_date(spark)
    payments = s["order_payments"]
    return {
        "fact_orders": orders, "fact_order_items": items, "fact_reviews": reviews,
        "fact_payments": payments.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    }, {
        "monthly_revenue": marts.monthly_revenue(orders, dates), "state_performance": marts.state_performance(orders, customers),
        "category_ranking": marts.category_ranking(items, orders, products), "delivery_kpi": marts.delivery_kpi(orders),
        "review_by_category": marts.review_by_category(reviews, items, products), "payment_distribution": marts.payment_distribution(payments),
        "customer_retention": marts.customer_retention(orders, customers),
    }, s


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_batches_equal_a_rebuild_and_write_touched_slots_only(spark, wh):
    given = batches(random.Random(8))
    translation = spark.createDataFrame([("toys", "Toys"), ("tools", "Tools"), ("a first name", "First")], SCHEMAS["category_translation"])
    for number in range(1, 4):
        written = propagate.propagate(wh, number, frames(spark, given[number - 1]), translation, LAYOUT)
        if number == 1:
            continue
        facts, wanted, tables = rebuilt(spark, given[:number], translation)
        for layer, frames_of in (("gold", facts), ("silver", tables)) if number == 3 else ():
            for name, df in frames_of.items():
                assert rows_of(wh.table(f"{layer}.{name}").select(df.columns)) == rows_of(df), (number, name)
        for mart, df in wanted.items():
            found = wh.table(f"platinum.mart_{mart}")
            assert found.columns == df.columns and rows_of(found) == rows_of(df), (number, mart)
        if number == 3:     # no order changed: only slots of the orders that hold the product, and no payments
            assert "gold.fact_payments" not in written or written["gold.fact_payments"] == []
            assert written["silver.products"] == [0] and "silver.orders" not in written
        if number == 2:
            assert set(written["silver.orders"]) == {0, 3} and set(written["silver.order_payments"]) == {0, 3}
    # a batch that was applied is passed over, another order is refused
    assert propagate.propagate(wh, 3, frames(spark, given[2]), translation, LAYOUT) == {}
    with pytest.raises(ValueError, match="comes next"):
        propagate.propagate(wh, 5, {}, translation, LAYOUT)


def test_rows_are_stored_once_with_a_batch(spark, wh):
    """Facts that are columns of silver rows, and rows that replace nothing, are not written again."""
    translation = spark.createDataFrame([("toys", "Toys")], SCHEMAS["category_translation"])
    propagate.propagate(wh, 1, frames(spark, batches(random.Random(10))[0]), translation, LAYOUT)
    stored = {"/".join(str(f.relative_to(propagate._folder(wh, 1))).split("/")[:-1]) for f in Path(propagate._folder(wh, 1)).rglob("*.parquet")}
    assert "silver/order_items" in stored and "gold/fact_orders" in stored
    assert not {name for name in stored if name.startswith(("after", "gold/fact_order_items", "gold/fact_payments", "gold/fact_reviews"))}
    assert wh.table("gold.fact_order_items").count() == wh.table("silver.order_items").count() > 0


@pytest.fixture
def altered(spark, monkeypatch):
    """The statements that change a table's partitions."""
    said, sql = [], type(spark).sql

    def noted(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE"):
            said.append(text)
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", noted)
    return said


def test_new_slots_are_added_at_once(spark, wh, altered):
    """Statements on the catalog follow the slots that are there already, not the new ones."""
    numbered = lambda first, last, v: spark.range(first, last).selectExpr("id as k", "id % 60 as slot", f"{v} as v")     # noqa: E731
    assert upsert_partitions(wh, numbered(0, 240, 1), "silver.many", ["k"], "slot") == list(range(60))
    assert len(altered) == 1
    altered.clear()
    # slots 0 to 2 are there, a NULL and a new one are not
    second = numbered(0, 3, 2).unionByName(spark.sql("SELECT 900L AS k, CAST(NULL AS BIGINT) AS slot, 2 AS v UNION ALL SELECT 901L, 70L, 2"))
    assert upsert_partitions(wh, second, "silver.many", ["k"], "slot") == [None, 0, 1, 2, 70]
    assert len(altered) == 4
    found = {r["k"]: (r["slot"], r["v"]) for r in wh.table("silver.many").collect()}
    assert found == {k: (k % 60, 2 if k < 3 else 1) for k in range(240)} | {900: (None, 2), 901: (70, 2)}


def test_slots_without_rows_are_moved(spark, wh, altered):
    """A slot that a failed run added, or one without rows, is known to the catalog alone."""
    rows = spark.sql("SELECT 1L AS k, 'a b' AS slot UNION ALL SELECT 2L, 'c'")
    upsert_partitions(wh, rows, "silver.few", ["k"], "slot")
    table = wh.catalog_name("silver.few")
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (slot='it''s') LOCATION '{wh.location('silver.few')}/nothing'")
    upsert_partitions(wh, spark.sql("SELECT 3L AS k, 'it''s' AS slot UNION ALL SELECT 4L, 'd' UNION ALL SELECT 2L, 'c'"), "silver.few", ["k"], "slot")
    assert rows_of(wh.table("silver.few")) == [(1, "a b"), (2, "c"), (3, "it's"), (4, "d")]


def test_listed_rows_equal_inline_rows(spark):
    schema = "a int, b string, c date, d timestamp_ntz, e double, f decimal(10,2), g boolean"
    rows = [(1, "it's \\ \"é\" ", datetime(2020, 1, 2).date(), datetime(2020, 1, 2, 3, 4, 5, 678), 0.1, Decimal("12.50"), True), (None,) * 7]
    found, wanted = listed_rows(spark, rows, schema), inline_rows(spark, rows, schema)
    assert found.dtypes == wanted.dtypes and found.collect() == wanted.collect() and len(found.collect()) == 2
    assert listed_rows(spark, [], schema).collect() == []


def test_a_run_that_dies_is_taken_up(spark, wh, monkeypatch):
    given = batches(random.Random(9))
    translation = spark.createDataFrame([("toys", "Toys")], SCHEMAS["category_translation"])
    propagate.propagate(wh, 1, frames(spark, given[0]), translation, LAYOUT)
    calls = []

    def dies(*args, **kwargs):
        calls.append(args)
        if len(calls) == 4:
            raise RuntimeError("lost")
        return upsert(*args, **kwargs)

    upsert = propagate.upsert_partitions
    monkeypatch.setattr(propagate, "upsert_partitions", dies)
    with pytest.raises(RuntimeError, match="lost"):
        propagate.propagate(wh, 2, frames(spark, given[1]), translation, LAYOUT)
    monkeypatch.setattr(propagate, "upsert_partitions", upsert)
    propagate.propagate(wh, 2, frames(spark, given[1]), translation, LAYOUT)
    _, wanted, _ = rebuilt(spark, given[:2], translation)
    for mart, df in wanted.items():
        assert rows_of(wh.table(f"platinum.mart_{mart}")) == rows_of(df), mart
    assert [r["step"] for r in wh.table(LOG).filter("batch_id = 2").orderBy("at").collect()] == ["staged", "applied"]


def test_first_batch_needs_every_table(spark, wh):
    with pytest.raises(ValueError, match="every table"):
        propagate.propagate(wh, 1, frames(spark, {"orders": [order(random.Random(1), 1)]}), spark.createDataFrame([], SCHEMAS["category_translation"]))
    with pytest.raises(ValueError, match="no propagation"):
        propagate.propagate(wh, 1, {"sellers": None}, None)
    assert set(GROUPS) and set(FACTS)


def test_signed_sums(spark):
    schema = "g string, x decimal(38,2)"
    frame = lambda rows: partial_sums(spark.createDataFrame(rows, schema), ["g"], {"x": F.col("x")}).withColumn("x", F.col("x").cast("decimal(38,2)"))     # noqa: E731
    from decimal import Decimal as D
    before = frame([("a", D(1)), ("a", D(2)), ("b", D(5)), (None, D(7)), ("same", D(4))])
    after = frame([("a", D(2)), ("c", None), (None, D(7)), (None, D(-7)), ("same", D(4))])
    delta = difference(before, after, ["g"])
    assert sorted((r["g"] or "", r["n_rows"], r["x"]) for r in delta.collect()) == [("", 1, D(-7)), ("a", -1, D(-1)), ("b", -1, D(-5)), ("c", 1, D(0))]
    state = folded(before.withColumn("x", F.coalesce("x", F.lit(0).cast("decimal(38,2)"))), delta, ["g"])
    assert sorted((r["g"] or "", r["n_rows"], r["x"]) for r in state.collect()) == [("", 2, D(0)), ("a", 1, D(2)), ("c", 1, D(0)), ("same", 1, D(4))]
