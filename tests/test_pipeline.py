"""The whole run from CSV files, checked against plain Python."""

import csv
import os
import random
import uuid
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierwork.operators.quality import QualityError
from tierwork.plans import gold, marts, pipeline, silver
from tierwork.schema import SOURCE_COLUMNS
from tierwork.sinks.tables import Warehouse

RUN = datetime(2024, 1, 1)
CATEGORIES = ["toys", "tools", "nameless", "  ", ""]
ENGLISH = {"toys": "Toys", "tools": "Tools"}


def stamp(t):
    return "" if t is None else t.strftime("%Y-%m-%d %H:%M:%S")


def source_rows(seed=5):
    """Nine small tables, with repeats, blanks and values that do not parse."""
    rnd = random.Random(seed)
    t = defaultdict(list)
    for i in range(12):
        t["customers"].append([f"c{i}", f"u{i // 2}", 1000 + i, " Town ", rnd.choice(["sp", "rj"])])
        t["products"].append([f"p{i}", CATEGORIES[i % 5], "5", "x", 1, 10 * i, 1, 2, 3])
        t["geolocation"].append([i, 1000 + i % 4, -10 - i * 4, -60 + i, "town", "sp"])
    t["customers"].append(t["customers"][0])
    t["sellers"] += [[f"s{i}", 2000 + i, "Port", " ba "] for i in range(3)]
    t["category_translation"] += [[k, v] for k, v in ENGLISH.items()]
    for i in range(60):
        bought = datetime(2017, 1, 1) + timedelta(hours=rnd.randrange(17000))
        status = rnd.choice(["delivered", "delivered", "shipped", "canceled", "unavailable"])
        arrived = bought + timedelta(hours=rnd.randrange(10, 900)) if status == "delivered" else None
        promised = bought + timedelta(days=15)
        t["orders"].append([f"o{i}", f"c{rnd.randrange(12)}", status, stamp(bought), "", "", stamp(arrived), stamp(promised), stamp(arrived or bought)])
        for n in range(rnd.randrange(4)):
            t["order_items"].append([f"o{i}", n + 1, f"p{rnd.randrange(12)}", f"s{rnd.randrange(3)}", stamp(bought), f"{rnd.randrange(1, 9999) / 100:.2f}", "1.10"])
        t["order_payments"].append([f"o{i}", 1, rnd.choice(["credit_card", "boleto"]), "2", f"{rnd.randrange(100, 9999) / 100:.2f}"])
        t["order_reviews"].append([f"r{i}", f"o{i}", 1 + i % 5, "", rnd.choice(["good", "  ", ""]), stamp(bought), "not a date"])
    t["order_items"].append(t["order_items"][0])
    return t


def write_csv(folder, tables):
    os.makedirs(folder, exist_ok=True)
    for name, columns in SOURCE_COLUMNS.items():
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            writer = csv.writer(f)
            writer.writerow(columns)
            writer.writerows(tables[name])


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    tables = source_rows()
    write_csv(f"{folder}/csv", tables)
    wh = Warehouse(spark, f"{folder}/wh", namespace=f"p{uuid.uuid4().hex[:10]}_")
    pipeline.run_all(wh, pipeline.csv_reader(wh.spark, f"{folder}/csv"), run_ts=RUN)
    return wh, tables, folder


def expected_marts(tables):
    items = {(r[0], r[1]): r for r in tables["order_items"]}
    revenue, count = defaultdict(float), Counter()
    for (order, _), r in items.items():
        revenue[order] += float(r[5])
        count[order] += 1
    state = {r[0]: r[4].upper() for r in tables["customers"]}
    person = {r[0]: r[1] for r in tables["customers"]}
    category = {r[0]: ENGLISH.get(r[1].strip(), "unknown") for r in tables["products"]}
    valid = [o for o in tables["orders"] if o[2] not in ("canceled", "unavailable")]
    monthly = defaultdict(lambda: [0.0, 0])
    states = defaultdict(lambda: [0, 0.0])
    for o in valid:
        key = (int(o[3][:4]), int(o[3][5:7]))
        monthly[key][0] += revenue[o[0]]
        monthly[key][1] += 1
        states[state[o[1]]][0] += 1
        states[state[o[1]]][1] += revenue[o[0]]
    ranking = defaultdict(lambda: [0.0, 0])
    for r in items.values():
        if r[0] in {o[0] for o in valid}:
            ranking[category[r[2]]][0] += float(r[5])
            ranking[category[r[2]]][1] += 1
    delivered = [o for o in tables["orders"] if o[2] == "delivered"]
    per_person = Counter(person[o[1]] for o in tables["orders"])
    dominant = {}
    for order in count:
        seen = Counter(category[r[2]] for (o, _), r in items.items() if o == order)
        dominant[order] = min(seen, key=lambda c: (-seen[c], c))
    reviews = Counter(dominant[r[1]] for r in tables["order_reviews"] if r[1] in dominant)
    return {
        "monthly": {k: (round(v[0], 2), v[1]) for k, v in monthly.items()},
        "states": {k: (v[0], round(v[1], 2)) for k, v in states.items()},
        "ranking": {k: (round(v[0], 2), v[1]) for k, v in ranking.items()},
        "late": round(sum(o[6] > o[7] for o in delivered) / len(delivered) * 100, 2),
        "retention": (len(per_person), sum(n >= 2 for n in per_person.values())),
        "reviews": dict(reviews),
    }


def test_marts_match_plain_python(run):
    wh, tables, _ = run
    want = expected_marts(tables)
    mart = lambda name: wh.table(f"platinum.mart_{name}").collect()
    assert {(r.year, r.month): (r.revenue, r.order_count) for r in mart("monthly_revenue")} == want["monthly"]
    assert {r.state: (r.order_count, r.revenue) for r in mart("state_performance")} == want["states"]
    assert {r.category_name_english: (r.revenue, r.items_sold) for r in mart("category_ranking")} == want["ranking"]
    assert [(r.total_orders, r.late_delivery_rate_pct) for r in mart("delivery_kpi")] == [(60, want["late"])]
    assert [(r.total_customers, r.repeat_customers) for r in mart("customer_retention")] == [want["retention"]]
    assert {r.category_name_english: r.review_count for r in mart("review_by_category")} == want["reviews"]
    assert sum(r.payment_count for r in mart("payment_distribution")) == 60


def test_revenue_reconciles_between_marts(run):
    wh, _, _ = run
    total = lambda name: round(wh.table(f"platinum.{name}").agg(F.sum("revenue")).first()[0], 2)
    assert total("mart_monthly_revenue") == total("mart_state_performance") == total("mart_category_ranking")


def test_silver_types_and_cleaning(run):
    wh, _, _ = run
    assert wh.table("silver.customers").select("customer_state").distinct().count() == 2
    assert wh.table("silver.customers").filter("customer_city <> 'Town'").isEmpty()
    assert dict(wh.table("silver.order_items").dtypes)["price"] == "double"
    assert wh.table("silver.order_reviews").filter("review_answer_timestamp IS NOT NULL").isEmpty()
    assert wh.table("silver.geolocation").filter("geolocation_lat < -35").isEmpty()
    assert wh.table("silver.products").filter("product_description_lenght IS NOT NULL").isEmpty()
    assert wh.table("gold.dim_date").count() == 1461


def test_surrogates_and_grain(run):
    wh, _, _ = run
    assert sorted(tuple(r) for r in wh.table("gold.dim_payment_type").collect()) == [(1, "boleto"), (2, "credit_card")]
    assert wh.table("gold.fact_payments").filter("payment_type_id IS NULL").isEmpty()
    assert wh.table("gold.fact_orders").count() == 60
    assert wh.table("gold.fact_orders").filter("total_items = 0").select("total_revenue").distinct().collect() == [(0.0,)]


def test_gates_and_logs(run):
    wh, _, _ = run
    dq = wh.table("meta.dq_results")
    assert {r.layer: r["count"] for r in dq.groupBy("layer").count().collect()} == {"bronze": 20, "silver": 8, "gold": 10}
    assert dq.filter("NOT passed").isEmpty()
    jobs = {r.job_name: r for r in wh.table("meta.job_log").collect()}
    assert set(jobs) == {"bronze_ingest", "silver_transform", "gold_build", "platinum_build_marts"}
    assert all(r.status == "success" for r in jobs.values())
    for job, layer in (("bronze_ingest", "bronze"), ("silver_transform", "silver"), ("gold_build", "gold"), ("platinum_build_marts", "platinum")):
        names = [r.tableName for r in wh.spark.sql(f"SHOW VIEWS IN {wh.namespace}{layer}").filter("NOT isTemporary").selectExpr("viewName AS tableName").collect()]
        assert jobs[job].rows_out == sum(wh.table(f"{layer}.{n}").count() for n in names), job
    assert jobs["silver_transform"].rows_in == jobs["bronze_ingest"].rows_out


def test_job_rows_of_a_second_load(spark, tmp_path):
    """An incremental table counts its new rows in and out, not its history."""
    import uuid as ids

    from tierwork.plans import pipeline as jobs
    from tierwork.sinks.tables import Warehouse as House

    wh = House(spark, f"{tmp_path}/wh", namespace=f"r{ids.uuid4().hex[:10]}_")
    wh.bootstrap()
    def load(*days):
        rows = spark.createDataFrame([(f"o{d}", None, None) for d in days], "order_id string, a string, b string")
        at = F.make_timestamp_ntz(F.lit(2017), F.lit(1), F.substring("order_id", 2, 2).cast("int"), F.lit(0), F.lit(0), F.lit(0))
        orders = rows.select("order_id", at.alias("order_purchase_timestamp"), at.alias("source_updated_at"))
        sellers = spark.range(3).select(F.col("id").cast("string").alias("seller_id"))
        jobs.ingest_bronze(wh, lambda table: orders if table == "orders" else sellers, tables=("orders", "sellers"))

    load(1, 2, 3)
    load(1, 2, 3, 4)
    log = [(r.rows_in, r.rows_out) for r in wh.table("meta.job_log").orderBy("run_timestamp").collect()]
    assert log == [(6, 6), (4, 4)] and wh.table("bronze.orders").count() == 4


def test_command_line_options():
    from tierwork.__main__ import arguments

    args = arguments().parse_args([
        "run", "--warehouse", "/wh", "--jdbc", "{}", "--slices", '{"orders": ["id", 8]}', "--lookback", "1.5", "--calendar", "2017-01-01", "2018-01-01"])
    assert args.slices == {"orders": ["id", 8]} and args.lookback == 1.5 and args.calendar == ["2017-01-01", "2018-01-01"]


def test_a_new_catalog_finds_the_tables(run):
    wh, _, _ = run
    other = Warehouse(wh.spark, wh.root, namespace=f"a{uuid.uuid4().hex[:10]}_")
    other.bootstrap()
    found = pipeline.attach(other)
    assert len(found) == 9 + 8 + 9 + 7
    for name in ("bronze.orders", "silver.orders", "gold.fact_orders", "platinum.mart_monthly_revenue", "meta.ingest_watermark"):
        assert other.table(name).exceptAll(wh.table(name)).isEmpty() and other.table(name).count() == wh.table(name).count()
    empty = Warehouse(wh.spark, f"{wh.root}-none", namespace=f"e{uuid.uuid4().hex[:10]}_")
    empty.bootstrap()
    assert pipeline.attach(empty) == []


def test_incremental_rerun(run):
    """A delivered order arrives as a new version; nothing else changes."""
    wh, tables, folder = run
    before = wh.table("bronze.orders").count()
    order = next(o for o in tables["orders"] if o[2] == "shipped")
    late = "2019-06-01 00:00:00"
    updated = [[*o[:2], "delivered", *o[3:6], late, o[7], late] if o is order else o for o in tables["orders"]]
    write_csv(f"{folder}/csv2", {**tables, "orders": updated})
    for _ in range(2):
        pipeline.run_all(wh, pipeline.csv_reader(wh.spark, f"{folder}/csv2"), run_ts=RUN + timedelta(days=1))
    assert wh.table("bronze.orders").count() == before + 1
    facts = wh.table("gold.fact_orders")
    assert facts.count() == 60
    assert facts.filter(F.col("order_id") == order[0]).first()["order_status"] == "delivered"


def test_a_broken_source_stops_at_its_gate(spark, tmp_path):
    tables = source_rows()
    tables["sellers"] = []
    tables["customers"][3][0] = ""
    write_csv(f"{tmp_path}/csv", tables)
    wh = Warehouse(spark, f"{tmp_path}/wh", namespace=f"p{uuid.uuid4().hex[:10]}_")
    with pytest.raises(QualityError, match="customers.customer_id_not_null.*sellers.row_count_gt_0"):
        pipeline.run_all(wh, pipeline.csv_reader(wh.spark, f"{tmp_path}/csv"), run_ts=RUN)
    assert not wh.exists("silver.orders")
    assert not wh.exists("bronze.sellers")      # what failed was never published


def test_a_failing_suite_leaves_readers_on_the_old_version(run, tmp_path):
    """A later run whose sources break a silver check, and one that breaks a gold one."""
    _, tables, _ = run
    folder = str(tmp_path)
    wh = Warehouse(run[0].spark, f"{folder}/wh", namespace=f"p{uuid.uuid4().hex[:10]}_")
    write_csv(f"{folder}/good", tables)
    pipeline.run_all(wh, pipeline.csv_reader(wh.spark, f"{folder}/good"), run_ts=RUN)
    before = {t: sorted(map(str, wh.table(t).collect())) for t in ("silver.order_payments", "silver.products", "gold.fact_orders")}

    odd = [["o0", 1, "shells", "2", "3.00"], *tables["order_payments"][1:]]
    write_csv(f"{folder}/odd", {**tables, "order_payments": odd, "products": tables["products"][:-1]})
    with pytest.raises(QualityError, match="1 check.*silver.order_payments.payment_type_accepted_values"):
        pipeline.run_all(wh, pipeline.csv_reader(wh.spark, f"{folder}/odd"), run_ts=RUN)
    assert {t: sorted(map(str, wh.table(t).collect())) for t in before} == before
    failed = wh.table("meta.dq_results").filter("NOT passed").collect()
    assert [(r.table_name, r.value) for r in failed] == [("silver.order_payments", 1.0)]
    assert wh.table("meta.job_log").filter("status = 'failed'").first()["job_name"] == "silver_transform"

    write_csv(f"{folder}/lost", {**tables, "products": tables["products"][:2]})
    with pytest.raises(QualityError, match="fk_product_id"):
        pipeline.run_all(wh, pipeline.csv_reader(wh.spark, f"{folder}/lost"), run_ts=RUN)
    assert wh.table("silver.products").count() == 2                    # silver has no check against it
    assert sorted(map(str, wh.table("gold.fact_orders").collect())) == before["gold.fact_orders"]
    assert wh.table("gold.dim_product").count() == 12                  # no dimension without its facts


def test_row_checks_taken_while_writing_agree_with_a_scan(run):
    wh, _, _ = run
    logged = {(r.table_name, r.check_name): (r.passed, r.value, r.threshold) for r in wh.table("meta.dq_results").orderBy("run_timestamp").collect()}
    for layer in ("bronze", "silver", "gold"):
        for r in pipeline.validate(wh, layer):
            assert logged[r.table_name, r.check_name] == (r.passed, r.value, r.threshold)


# ---- marts on facts that break the usual assumptions -------------------------------


def test_repeated_order_ids_are_counted_once(spark):
    facts = spark.createDataFrame(
        [("o1", "c1", "shipped", 20170101, 1.0, None), ("o1", "c1", "shipped", 20170102, 2.0, 4), ("o2", "c2", None, 20170101, 9.0, 1)],
        "order_id string, customer_id string, order_status string, purchase_date_id int, total_revenue double, delivery_days int")
    people = spark.createDataFrame([("c1", "u1", "SP"), ("c2", "u1", "SP")], "customer_id string, customer_unique_id string, state string")
    assert [tuple(r) for r in marts.monthly_revenue(facts, gold.dim_date(spark)).collect()] == [(2017, 1, 3.0, 1)]
    assert [tuple(r) for r in marts.state_performance(facts, people).collect()] == [("SP", 1, 3.0, 4.0)]
    assert marts.customer_retention(facts, people).first() == (1, 1, 100.0)


def test_kpi_without_deliveries(spark):
    facts = spark.createDataFrame([("shipped", None, None)], "order_status string, delivery_days int, is_late_delivery boolean")
    assert marts.delivery_kpi(facts).first() == (1, None, None)
    assert marts.delivery_kpi(facts.limit(0)).first() == (0, None, None)


def test_reviews_are_not_multiplied(spark):
    reviews = spark.createDataFrame([("r1", "o1", 4), ("r1", "o2", 2), ("r2", "o1", None)], "review_id string, order_id string, review_score int")
    items = spark.createDataFrame([("o1", "p1"), ("o1", "p2"), ("o1", "p3"), ("o2", "p2")], "order_id string, product_id string")
    products = spark.createDataFrame([("p1", "A"), ("p2", "B"), ("p3", "A")], "product_id string, category_name_english string")
    got = {r.category_name_english: (r.avg_review_score, r.review_count) for r in marts.review_by_category(reviews, items, products).collect()}
    assert got == {"A": (4.0, 2), "B": (2.0, 1)}


def test_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 1461
    assert days.filter("date_id = 20160229").first() == (20160229, datetime(2016, 2, 29).date(), 2016, 1, 2, 29, 2, False)
    assert days.filter("is_weekend").select("day_of_week").distinct().count() == 2


def test_payment_total_counts_dropped_duplicates(spark):
    df = spark.createDataFrame([("o", 1, "a", "1", "2.50"), ("o", 1, "a", "1", "2.50"), (None, 1, "a", "1", "1")],
                               "order_id string, payment_sequential int, payment_type string, payment_installments string, payment_value string")
    got = silver.order_payments(df).collect()
    assert sorted((r.order_id or "", r.total_payment_value) for r in got) == [("", None), ("o", 5.0)]
