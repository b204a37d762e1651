"""Change log, versioned reads, incremental loads, sinks and job metrics."""

import os
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierwork.operators import changelog, contents, incremental, membership, profile_states, versions, windows
from tierwork.plans import metrics, pipeline
from tierwork.sinks import rewrite, tables
from tierwork.streaming.incremental import follow_folder


def d(month, day=1, hour=0):
    return datetime(2020, month, day, hour)


ORDERS = [
    (1, "delivered", d(1), d(1, 20)),   # same month
    (2, "delivered", d(1), d(2, 3)),    # later month
    (3, "delivered", d(3), d(2, 3)),    # delivered before the purchase
    (4, "shipped", d(1), None),
    (5, "canceled", d(1), d(4)),        # a later date, but not delivered
    (6, "delivered", d(2), None),       # delivered without a date
]
SCHEMA = "order_id int, order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, SCHEMA)


@pytest.fixture
def wh(spark, tmp_path):
    made = tables.Warehouse(spark, str(tmp_path / "wh"), namespace=f"t{uuid.uuid4().hex[:10]}_")
    made.bootstrap()
    return made


# ---- change log --------------------------------------------------------------------


def test_only_later_month_deliveries_have_two_versions(orders):
    log = changelog.change_log(orders)
    assert log.columns == [*orders.columns, "source_updated_at"]
    seen = sorted((r.order_id, r.order_status, r.order_delivered_customer_date, r.source_updated_at) for r in log.collect()
                  if r.order_id == 2)
    assert seen == [(2, "delivered", d(2, 3), d(2, 3)), (2, "shipped", None, d(1))]
    assert {r.order_id: r["count"] for r in log.groupBy("order_id").count().collect()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1}
    assert log.filter("order_id <> 2 AND source_updated_at <> order_purchase_timestamp").isEmpty()


def test_latest_state_of_the_log_is_the_final_state(orders):
    latest = windows.latest_version(changelog.change_log(orders), ["order_id"], ["source_updated_at"])
    assert latest.select(*orders.columns).exceptAll(orders).isEmpty() and latest.count() == len(ORDERS)


def test_state_as_of_a_month(orders):
    log = changelog.change_log(orders)
    january = {r.order_id: r.order_status for r in changelog.state_as_of(log, "2020-01", ["order_id"]).collect()}
    assert january == {1: "delivered", 2: "shipped", 4: "shipped", 5: "canceled"}
    assert {r.order_id: r.order_status for r in changelog.state_as_of(log, "2020-02", ["order_id"]).collect()}[2] == "delivered"


def test_month_slice_keeps_children_of_its_orders(spark, orders):
    items = spark.createDataFrame([(1, 1), (1, 2), (3, 1), (None, 1)], "order_id int, n int")
    parents, children = changelog.month_slice(orders, {"items": items}, "2020-01")
    assert sorted(r.order_id for r in parents.collect()) == [1, 2, 4, 5]
    assert sorted((r.order_id, r.n) for r in children["items"].collect()) == [(1, 1), (1, 2)]


# ---- versioned reads ---------------------------------------------------------------


def test_versions(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (4, 4)], "batch_id int, v int").withColumn(
        "committed_at", F.make_timestamp_ntz(F.lit(2020), F.lit(1), F.col("batch_id"), F.lit(0), F.lit(0), F.lit(0)))
    assert versions.as_of_version(df, 2).count() == 2
    assert versions.as_of_time(df, "2020-01-03").count() == 3
    assert [r.v for r in versions.replaced_as_of(df, 3).collect()] == [3]
    assert [r.v for r in versions.replaced_as_of(df, 2).orderBy("v").collect()] == [1, 2]
    assert versions.compare_versions(df).first() == (1, 2, 4, 4)
    assert [(r.batch_id, r.added_rows) for r in versions.batch_history(df).orderBy("batch_id").collect()] == [(1, 2), (3, 1), (4, 1)]


def test_file_stats(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/t")
    got = versions.file_stats(spark.read.parquet(f"{tmp_path}/t")).collect()
    assert sum(r.record_count for r in got) == 10 and all(os.path.getsize(r.file_path.removeprefix("file:")) == r.file_size_in_bytes for r in got)


# ---- incremental load --------------------------------------------------------------

FEED = "id int, changed timestamp_ntz, bought timestamp_ntz"


def feed(spark, *entries):
    return spark.createDataFrame([(i, t, t and t.replace(day=1)) for i, t in entries], FEED)


def load(wh, df, **more):
    return incremental.load_increment(wh, df, "bronze.feed", "changed", "bought", **more)


def test_loads_only_what_is_strictly_newer(spark, wh):
    first = load(wh, feed(spark, (1, d(1, 5)), (2, d(1, 6)), (3, None)))
    assert (first.batch_id, first.row_count, first.watermark) == (1, 2, d(1, 6))
    source = feed(spark, (1, d(1, 5)), (2, d(1, 6)), (4, d(1, 6)), (5, d(1, 2)), (6, d(2, 1, 5)))
    second = load(wh, source)
    assert (second.batch_id, second.row_count, second.watermark) == (2, 1, d(2, 1, 5))
    third = load(wh, source)
    assert (third.batch_id, third.row_count, third.watermark) == (None, 0, d(2, 1, 5))
    got = wh.table("bronze.feed")
    assert sorted((r.id, r.batch_id) for r in got.collect()) == [(1, 1), (2, 1), (6, 2)]
    assert {r.part_ts_month for r in got.collect()} == {"2020-01", "2020-02"}
    assert wh.table(incremental.WATERMARKS).first()["watermark_value"] == d(2, 1, 5)
    assert [(r.batch_id, r.row_count) for r in wh.table(incremental.LEDGER).orderBy("batch_id").collect()] == [(1, 2), (2, 1)]


def test_first_empty_load_creates_the_table(spark, wh):
    nothing = load(wh, feed(spark, (1, None)))
    assert nothing.row_count == 0 and wh.table("bronze.feed").count() == 0
    assert load(wh, feed(spark, (1, d(1)))).batch_id == 1
    assert wh.table("bronze.feed").count() == 1


def test_lookback_finds_late_and_tied_rows_once(spark, wh):
    load(wh, feed(spark, (1, d(1, 5)), (2, d(1, 10))))
    late = feed(spark, (1, d(1, 5)), (2, d(1, 10)), (3, d(1, 10)), (4, d(1, 9)), (5, d(1, 1)))
    options = {"lookback": timedelta(days=2), "keys": ["id"]}
    assert load(wh, late, **options).row_count == 2
    assert load(wh, late, **options).row_count == 0
    assert sorted(r.id for r in wh.table("bronze.feed").collect()) == [1, 2, 3, 4]


def test_bits_of_a_filter_are_gathered_before_they_are_set(spark):
    """Every task holds bits of every bitmap; a bitmap is made where they meet."""
    df = spark.range(30_000).select("id").repartition(8)
    made = membership.sketch(df, ["id"], 30_000)
    assert "RebalancePartitions" in made._jdf.queryExecution().optimizedPlan().toString()
    assert made.count() == (1 << made.first()["size_log2"]) >> membership.BITMAP_LOG2
    assert made.agg(F.sum(F.bitmap_count("bits"))).first()[0] == df.select(
        F.explode(membership._hashes(["id"])).alias("h")).select(F.col("h").bitwiseAND(F.lit((1 << 19) - 1))).distinct().count()


def test_filters_pass_what_they_hold(spark):
    df = spark.range(5000).select(F.col("id"), F.col("id").cast("string").alias("s"))
    sketches = membership.sketch(df, ["id", "s"], 5000).withColumn("batch_id", F.lit(7).cast("bigint"))
    sizes = {7: sketches.first()["size_log2"]}
    ask = lambda rows: membership.may_hold(rows, sketches, ["id", "s"], sizes)
    assert sizes == {7: 17} and all(ask(df.filter(F.col("id") == k)) == [7] for k in (0, 17, 4999))
    assert ask(df.limit(0)) == [] and membership.may_hold(df, sketches, ["id", "s"], {}) == []
    # absent keys: each of 40 tested apart, as one batch of 40 rows each time
    strange = [spark.range(k, k + 1).select("id", F.lit("x").alias("s")) for k in range(6)]
    assert sum(ask(rows) == [7] for rows in strange) <= 1


def test_a_lookback_reads_only_batches_that_may_hold_a_row(spark, wh, monkeypatch):
    options = {"lookback": timedelta(days=20), "keys": ["id"]}
    for month in (1, 2, 3):
        load(wh, feed(spark, *[(month * 100 + k, d(month, 1 + k)) for k in range(20)]), **options)
    load(wh, feed(spark, *[(400 + k, d(3, 15, k)) for k in range(1, 5)]), **options)
    rows = feed(spark, (305, d(3, 6)), (305, d(3, 7)), (999, d(3, 8)), (999, d(3, 8)), (500, d(4, 1)))
    start, keys = d(3, 1), ["id", "changed"]
    assert incremental.holding_batches(wh, "bronze.feed", rows, keys, start) == [3]          # not 4, though its time fits
    assert incremental.holding_batches(wh, "bronze.feed", feed(spark, (999, d(3, 8))), keys, start) == []
    assert incremental.holding_batches(wh, "bronze.feed", feed(spark, (402, d(3, 15, 2))), keys, d(1, 1)) == [4]
    wider = rows.withColumn("id", F.col("id").cast("bigint"))
    assert incremental.holding_batches(wh, "bronze.feed", wider, keys, start) == [3, 4]      # other types: by time alone
    unseen = lambda: incremental.unseen_rows(wh, "bronze.feed", rows, keys, "changed", start, d(3, 20))
    files = [f for f in unseen().inputFiles() if "batch_id" in f]
    plan = unseen()._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan and "PartitionFilters: [" in plan and "(batch_id#" in plan and "= 3)" in plan, (files, plan)
    got = sorted((r.id, r.changed) for r in unseen().collect())
    monkeypatch.setattr(incremental, "holding_batches", lambda *_: [1, 2, 3, 4])
    assert got == sorted((r.id, r.changed) for r in unseen().collect()) == [(305, d(3, 7)), (500, d(4, 1)), (999, d(3, 8))]
    monkeypatch.undo()
    assert load(wh, rows, **options).row_count == 3 and load(wh, rows, **options).row_count == 0


def test_a_load_that_died_is_replaced(spark, wh, monkeypatch):
    load(wh, feed(spark, (1, d(1, 5))))
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(wh, feed(spark, (2, d(3, 6)), (3, d(2, 6))))
    assert wh.table("bronze.feed").count() == 1
    assert load(wh, feed(spark, (2, d(3, 6)))).batch_id == 2
    assert sorted(r.id for r in wh.table("bronze.feed").collect()) == [1, 2]


def test_source_without_the_watermark_column(spark, wh):
    got = incremental.load_increment(wh, feed(spark, (1, d(1, 5))).drop("changed"), "bronze.feed", "changed", "bought")
    assert got.watermark == d(1, 1)


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    feed(spark, (1, d(1, 5))).write.parquet(f"{tmp_path}/f")
    rows = incremental.new_rows(spark.read.parquet(f"{tmp_path}/f"), "changed", d(1, 4))
    assert "GreaterThan(changed" in rows._jdf.queryExecution().executedPlan().toString()


def test_advance_watermark(spark):
    now = spark.createDataFrame([("a", d(1), d(1)), ("b", d(2), d(2))], "table_name string, watermark_value timestamp_ntz, updated_at timestamp_ntz")
    got = incremental.advance_watermark(now, "a", "2020-03-01", "2020-03-02")
    assert sorted(tuple(r) for r in got.collect()) == [("a", d(3), d(3, 2)), ("b", d(2), d(2))]


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_streaming_load_follows_a_folder(spark, wh, tmp_path, files_per_batch):
    """Files out of watermark order, in batches of any size, each row once."""
    drop = f"{tmp_path}/drop"
    for n, day in enumerate((7, 5, 6)):
        feed(spark, (n, d(1, day))).coalesce(1).write.mode("append").parquet(drop)
    arguments = (wh, drop, FEED, "bronze.feed", "changed", "bought", "parquet", files_per_batch)
    follow_folder(*arguments)
    feed(spark, (3, d(2, 6))).coalesce(1).write.mode("append").parquet(drop)
    follow_folder(*arguments)
    follow_folder(*arguments)
    assert sorted(r.id for r in wh.table("bronze.feed").collect()) == [0, 1, 2, 3]


def test_a_stream_adds_to_a_table_that_was_loaded_before(spark, wh, tmp_path):
    drop = str(tmp_path / "drop")
    incremental.load_increment(wh, feed(spark, *[(n, d(1, 1 + n)) for n in range(10)]), "bronze.feed", "changed", "bought")
    arguments = (wh, drop, FEED, "bronze.feed", "changed", "bought", "parquet")
    for first in (10, 20):
        feed(spark, *[(n, d(1, 1 + n % 10)) for n in range(first, first + 10)]).coalesce(1).write.mode("append").parquet(drop)
        follow_folder(*arguments)
        assert wh.table("bronze.feed").count() == first + 10
    assert sorted(r.id for r in wh.table("bronze.feed").collect()) == list(range(30))
    # a repeated micro-batch is passed over
    last = wh.table(incremental.LEDGER).filter("batch_id = 3").first()["operation"].split()
    again = incremental.load_micro_batch(wh, feed(spark, (99, d(1))), "bronze.feed", "changed", "bought", last[1], int(last[2]))
    assert again.row_count == 0 and wh.table("bronze.feed").count() == 30


def test_a_stream_without_its_progress_is_refused(spark, wh):
    rows = feed(spark, (1, d(1, 5)))
    incremental.load_micro_batch(wh, rows, "bronze.feed", "changed", "bought", "first", 0)
    with pytest.raises(RuntimeError, match="another stream"):
        incremental.load_micro_batch(wh, rows, "bronze.feed", "changed", "bought", "second", 0)
    assert wh.table("bronze.feed").count() == 1


def test_a_repeated_batch_is_not_loaded_twice(spark, wh):
    for rows in (feed(spark, (1, d(1, 5))), feed(spark, (1, d(1, 5)), (2, d(1, 6)))):
        incremental.load_batch(wh, rows, "bronze.feed", "changed", "bought", 1)
    assert [r.id for r in wh.table("bronze.feed").collect()] == [1]


def test_looking_back_needs_keys(spark, wh):
    with pytest.raises(ValueError):
        incremental.load_increment(wh, feed(spark, (1, d(1, 5))), "bronze.feed", "changed", "bought", lookback=timedelta(days=1))


# ---- sinks -------------------------------------------------------------------------


def test_partition_terms():
    assert tables.partition_terms("months(_part_ts), state ,hours( ts )") == [("months", "_part_ts"), (None, "state"), ("hours", "ts")]
    assert tables.partition_column("months", "_part_ts") == "part_ts_month"


def test_derived_partitions(spark):
    df, names = tables.with_partitions(spark.createDataFrame([(d(1, 5, 7), "x")], "ts timestamp_ntz, s string"), "years(ts),days(ts),hours(ts),s")
    assert names == ["ts_year", "ts_day", "ts_hour", "s"]
    assert df.select(*names).first() == ("2020", "2020-01-05", "2020-01-05-07", "x")


def test_replace_keeps_versions(spark, wh):
    first = tables.replace_table(wh, spark.range(3), "silver.t")
    second = tables.replace_table(wh, wh.table("silver.t").filter("id > 0"), "silver.t")
    assert wh.table("silver.t").count() == 2
    assert [r.version for r in tables.table_history(wh, "silver.t").collect()] == [first, second]
    assert tables.read_version(wh, "silver.t", first).count() == 3
    assert tables.read_version(wh, "silver.t", moment=datetime(2100, 1, 1)).count() == 2
    with pytest.raises(LookupError):
        tables.read_version(wh, "silver.t", moment=datetime(2000, 1, 1))


def test_partition_filter_prunes(spark, wh):
    df = spark.createDataFrame([(1, d(1)), (2, d(2))], "k int, ts timestamp_ntz")
    tables.replace_table(wh, df, "silver.t", "months(ts)")
    plan = wh.table("silver.t").filter("ts_month = '2020-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_month" in plan


def test_batch_rerun_replaces_its_own_rows(spark, wh):
    for n in (5, 3):
        folder = tables.append_batch(wh, spark.range(n).withColumn("p", F.col("id") % 5), "bronze.t", 1, "p")
    assert spark.read.parquet(folder).count() == 3


def test_upsert_touches_only_its_partitions(spark, wh):
    tables.upsert_partitions(wh, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, s string, p string"), "gold.t", ["k"], "p")
    before = {r.p: r.f for r in wh.table("gold.t").select("p", F.col("_metadata.file_path").alias("f")).collect()}
    touched = tables.upsert_partitions(wh, spark.createDataFrame([(2, "B", "y"), (3, "c", "z")], "k int, s string, p string"), "gold.t", ["k"], "p")
    after = {r.p: r.f for r in wh.table("gold.t").select("p", F.col("_metadata.file_path").alias("f")).collect()}
    assert touched == ["y", "z"] and before["x"] == after["x"] and before["y"] != after["y"]
    assert sorted((r.k, r.s, r.p) for r in wh.table("gold.t").collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]


def test_upsert_merges_in_parts(spark, wh, monkeypatch):
    monkeypatch.setattr(tables, "PART_ROWS", 3)
    schema = "k int, s string, p string"
    tables.upsert_partitions(wh, spark.createDataFrame([(k, "old", "x") for k in range(20)] + [(None, "old", "x")] * 2, schema), "gold.t", ["k"], "p")
    tables.upsert_partitions(wh, spark.createDataFrame([(k, "new", "x") for k in range(0, 24, 2)] + [(None, "new", "x")], schema), "gold.t", ["k"], "p")
    want = [(k, "new" if k % 2 == 0 else "old") for k in (*range(20), 20, 22)] + [(None, "old")] * 2 + [(None, "new")]
    assert sorted(((r.k, r.s) for r in wh.table("gold.t").collect()), key=str) == sorted(want, key=str)


STRANGE = ["007", "7", "01", "a:b", "x/y", "k=v", "50%", "sp ace", "plain", "2020-01-01", None]


def test_upsert_keeps_strange_partition_values(spark, wh):
    schema = "k int, s string, p string"
    tables.upsert_partitions(wh, spark.createDataFrame([(k, "old", p) for k, p in enumerate(STRANGE)], schema), "gold.t", ["k"], "p")
    again = [(k, "new", p) for k, p in enumerate(STRANGE) if k % 2 == 0]
    tables.upsert_partitions(wh, spark.createDataFrame([*again, (99, "new", None)], schema), "gold.t", ["k"], "p")
    want = {(k, "new" if k % 2 == 0 else "old", p) for k, p in enumerate(STRANGE)} | {(99, "new", None)}
    assert {tuple(r) for r in wh.table("gold.t").collect()} == want
    with pytest.raises(ValueError):
        tables.upsert_partitions(wh, spark.createDataFrame([(1, "x", "")], schema), "gold.t", ["k"], "p")


def test_replace_keeps_partition_values_and_types(spark, wh):
    rows = [(k, d(1, 5), p) for k, p in enumerate(STRANGE)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, zip string")
    first = tables.replace_table(wh, df, "silver.t", "days(ts), zip")
    want = sorted(((k, t, p, "2020-01-05") for k, t, p in rows), key=str)
    for found in (wh.table("silver.t"), tables.read_version(wh, "silver.t", first)):
        assert dict(found.dtypes)["zip"] == "string" and dict(found.dtypes)["ts_day"] == "string"
        assert sorted((tuple(r) for r in found.select("k", "ts", "zip", "ts_day").collect()), key=str) == want
    tables.replace_table(wh, wh.table("silver.t").drop("ts_day"), "silver.t", "days(ts), zip")
    pipeline.attach(wh)
    assert sorted((tuple(r) for r in wh.table("silver.t").select("k", "ts", "zip", "ts_day").collect()), key=str) == want


def test_log_append_never_raises(spark, wh):
    assert tables.log_rows(wh, spark.range(1), "meta.log") and tables.log_rows(wh, spark.range(1), "meta.log")
    assert wh.table("meta.log").count() == 2
    messages = []
    assert not tables.log_rows(wh, spark.range(1), "nowhere.log", report=messages.append) and messages


def test_rewrite_guard(spark, wh, monkeypatch):
    tables.replace_table(wh, spark.range(10), "silver.t")
    target = f"{wh.root}/moved/t"
    assert rewrite.rewrite_table(wh, "silver.t", wh.table("silver.t"), target) == (10, 10)
    assert [r.operation for r in tables.table_history(wh, "silver.t").collect()] == ["replace", "rewrite"]
    pipeline.attach(wh)
    assert all(target in path for path in wh.table("silver.t").inputFiles())

    real = rewrite.write_files
    monkeypatch.setattr(rewrite, "write_files", lambda df, *rest: real(df.limit(4), *rest))
    with pytest.raises(rewrite.RewriteError):
        rewrite.rewrite_table(wh, "silver.t", wh.table("silver.t"), f"{wh.root}/lossy/t")
    assert wh.table("silver.t").count() == 10


def test_rewrite_guard_finds_a_changed_value(spark, wh, monkeypatch):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 2.0), (2, "b", 2.0)], "k int, s string, x double")
    tables.replace_table(wh, rows, "silver.t")
    real = rewrite.write_files
    swapped = F.when(F.col("k") == 1, "b").otherwise("a")
    monkeypatch.setattr(rewrite, "write_files", lambda df, *rest: real(df.withColumn("s", swapped), *rest))
    with pytest.raises(rewrite.RewriteError, match="not those of the original"):
        rewrite.rewrite_table(wh, "silver.t", wh.table("silver.t"), f"{wh.root}/swapped/t")
    monkeypatch.setattr(rewrite, "write_files", real)
    assert rewrite.rewrite_table(wh, "silver.t", wh.table("silver.t"), f"{wh.root}/split/t", "s") == (3, 3)
    assert wh.table("silver.t").exceptAll(rows).isEmpty()


# ---- profiles by batch -------------------------------------------------------------


def test_merged_profiles_equal_a_full_scan(spark, wh):
    spec = profile_states.ProfileSpec(("kind",), {"id": (0, 10, 5)})

    def rows(*entries):
        return feed(spark, *entries).withColumn("kind", F.when(F.col("id") % 3 > 0, F.col("id") % 3))

    def counts(df):
        return {tuple(r) for r in df.collect()}

    load(wh, rows(*[(k, d(1, 1 + k)) for k in range(9)]))
    assert profile_states.update(wh, "bronze.feed", spec) == 1
    load(wh, rows((50, d(2, 1)), (-3, d(2, 2)), (None, d(2, 3))))
    load(wh, rows((4, d(3, 1))))
    fresh = profile_states.new_batches(wh, "bronze.feed")
    assert sorted(fresh) == [2, 3]
    plan = profile_states.pending(wh, "bronze.feed", fresh)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_id#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert profile_states.update(wh, "bronze.feed", spec) == 2 and profile_states.update(wh, "bronze.feed", spec) == 0
    whole = profile_states.merged(profile_states.states_of(wh.table("bronze.feed").withColumn("batch_id", F.lit(1)), spec))
    got = counts(profile_states.profile(wh, "bronze.feed"))
    assert got == counts(whole) and ("rows", None, None, 13) in got and ("nulls", "id", None, 1) in got
    assert ("value", "kind", None, 5) in got and ("bin", "id", "0", 3) in got
    wh.table(profile_states.STATES).limit(3).write.mode("append").parquet(f"{wh.location(profile_states.STATES)}/rows")
    wh.spark.catalog.refreshTable(wh.catalog_name(profile_states.STATES))
    assert counts(profile_states.profile(wh, "bronze.feed")) == got


# ---- content fingerprints ----------------------------------------------------------


def test_fingerprints_follow_the_multiset(spark):
    kinds = "a int, b int, s string, d array<int>"
    rows = [(1, None, "x", [1]), (None, 1, "x", []), (1, None, "x", [1]), (2, 2, "", None)]
    same = contents.whole(spark.createDataFrame(rows, kinds).repartition(3))
    assert contents.whole(spark.createDataFrame(rows[::-1], kinds).select("s", "d", "b", "a")) == same
    for other in (rows[:3], [*rows[:2], rows[3], rows[3]], [(None, 1, "x", [1]), *rows[1:]], [(1, None, "x", [1]), (None, 1, "x", None), *rows[2:]]):
        assert contents.whole(spark.createDataFrame(other, kinds)) != same
    assert contents.whole(spark.createDataFrame([], kinds)) == (0, 0, 0, 0)


def test_versions_are_compared_partition_by_partition(spark, wh):
    kinds, by = "v int, p string, q int", ["p", "q"]
    one = [(v, p, q) for v in range(20) for p in ("a", "007", None) for q in (1, 2)]
    two = [(v + (v == 3 and p is None and q == 2), p, q) for v, p, q in one if (v, p, q) != (5, "007", 1)] + [(5, "new", 1)]
    ids = [tables.replace_table(wh, spark.createDataFrame(rows, kinds), "silver.t", "p, q") for rows in (one, two)]
    with pytest.raises(LookupError):
        rewrite.record_contents(wh, "silver.t", ids[0], by)
        rewrite.compare_versions(wh, "silver.t", *ids)
    rewrite.record_contents(wh, "silver.t", ids[1], by)
    slots = rewrite.compare_versions(wh, "silver.t", *ids)
    assert {(r.slot, r.rows_before, r.rows_after) for r in slots.collect()} == {
        ('{"p":null,"q":2}', 20, 20), ('{"p":"007","q":1}', 20, 19), ('{"p":"new","q":1}', 0, 1)}
    assert all("version_contents" in f for f in slots.inputFiles())       # no data file
    changes = rewrite.changed_between(wh, "silver.t", *ids, by)
    assert {tuple(r) for r in changes.select("v", "p", "q", "change").collect()} == {
        (3, None, 2, -1), (4, None, 2, 1), (5, "007", 1, -1), (5, "new", 1, 1)}
    assert rewrite.changed_between(wh, "silver.t", ids[0], ids[0], by).isEmpty()


# ---- job metrics -------------------------------------------------------------------


def test_job_rows(spark, wh):
    with metrics.job_run(wh, "silver", "ok", run_id="r") as run:
        run.watch(spark.range(7), "rows_out").write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        with metrics.job_run(wh, "silver", "bad", run_id="r"):
            raise ValueError("x" * 5000)
    got = {r.job_name: r for r in wh.table(metrics.JOB_LOG).collect()}
    assert (got["ok"].status, got["ok"].rows_out, got["ok"].error_msg) == ("success", 7, "")
    assert got["bad"].status == "failed" and len(got["bad"].error_msg) == 1000


def test_a_broken_log_does_not_hide_the_error(wh):
    with pytest.raises(ValueError, match="the real one"):
        with metrics.job_run(wh, "silver", "bad", log="nowhere.log"):
            raise ValueError("the real one")


def test_health_report(spark):
    log = spark.createDataFrame([("a", "failed", 1.0, 0), ("a", "success", 2.0, 5), ("b", "success", 1.0, 1)],
                                "layer string, status string, duration_sec double, rows_out int")
    checks = spark.createDataFrame([("a", True), ("a", False)], "layer string, passed boolean")
    got = {r.layer: r for r in metrics.health_report(log, checks).collect()}
    assert (got["a"].runs, got["a"].failed_runs, got["a"].avg_duration_sec, got["a"].dq_pass_pct) == (2, 1, 1.5, 50.0)
    assert (got["b"].checks, got["b"].dq_pass_pct) == (0, None)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_inline_rows_keep_times_and_nulls(spark, zone):
    from datetime import timezone

    from tierwork.sources.files import inline_rows

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("a", 1, d(1, 2, 3), datetime(2020, 1, 1, tzinfo=timezone.utc), 1.5), (None, None, None, None, None)]
        df = inline_rows(spark, rows, "s string, n bigint, plain timestamp_ntz, zoned timestamp, x double")
        assert df.dtypes == [("s", "string"), ("n", "bigint"), ("plain", "timestamp_ntz"), ("zoned", "timestamp"), ("x", "double")]
        got = df.select("s", "n", "plain", F.unix_seconds("zoned").alias("zoned"), "x").collect()
        assert [tuple(r) for r in got] == [("a", 1, d(1, 2, 3), 1577836800, 1.5), (None,) * 5]
        assert inline_rows(spark, [], "s string").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
