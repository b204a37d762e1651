"""Checks, suites and the gate."""

from datetime import datetime

import pytest

from tierwork.operators import quality as q


def outcome(df):
    return {r.check_name: (r.passed, r.value, r.threshold) for r in df.collect()}


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, 1, 5.0, "a"), (1, 1, 0.0, "b"), (None, 2, None, None), (None, 2, -1.0, "z")], "k int, n int, price double, kind string")


def test_row_checks_and_their_null_rules(items):
    got = outcome(q.check_table(items, "t", "l", [
        q.row_count_gt(3), q.row_count_gt(4), q.not_null("k"), q.between("price", 0, 4), q.in_set("kind", {"a", "b"}),
        q.positive("price"), q.non_negative("price"),
    ]))
    assert got == {
        "row_count_gt_3": (True, 4.0, 3.0), "row_count_gt_4": (False, 4.0, 4.0), "k_not_null": (False, 2.0, 0.0),
        "price_between_0_4": (False, 2.0, 0.0), "kind_accepted_values": (False, 1.0, 0.0),
        "price_positive": (False, 2.0, 0.0), "price_non_negative": (False, 1.0, 0.0),
    }


def test_unique_treats_nulls_as_equal(items):
    assert outcome(q.check_table(items, "t", "l", [q.Unique(("k", "n"))])) == {"unique_k_n": (False, 2.0, 0.0)}


def test_foreign_key_counts_null_children(spark, items):
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert outcome(q.check_table(items, "t", "l", [q.ForeignKey("k", parent, "id")])) == {"fk_k_in_id": (False, 2.0, 0.0)}


def test_same_count(items):
    got = q.check_table(items, "t", "l", [q.SameCount("same", items), q.SameCount("other", items.limit(1))])
    assert outcome(got) == {"same": (True, 4.0, 4.0), "other": (False, 4.0, 1.0)}


def test_window_ends_at_midnight(spark):
    times = [datetime(2019, 12, 31), datetime(2019, 12, 31, 0, 0, 1), None]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    assert outcome(q.check_table(df, "t", "l", [q.in_window("w", "ts", "2016-01-01", "2019-12-31")])) == {"w": (False, 1.0, 0.0)}


def test_checks_of_an_empty_table(items):
    got = outcome(q.check_table(items.limit(0), "t", "l", [q.row_count_gt(0), q.not_null("k"), q.Unique(("k",))]))
    assert got == {"row_count_gt_0": (False, 0.0, 0.0), "k_not_null": (True, 0.0, 0.0), "unique_k": (True, 0.0, 0.0)}


def test_row_checks_take_one_scan(spark, tmp_path, items):
    items.write.parquet(f"{tmp_path}/t")
    df = q.check_table(spark.read.parquet(f"{tmp_path}/t"), "t", "l", [q.row_count_gt(0), q.not_null("k"), q.positive("price")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "kind" not in plan.split("ReadSchema")[1]


def test_gate_saves_then_raises(spark, items):
    saved = []
    results = q.check_suite("l", [("t", items, [q.row_count_gt(0), q.not_null("k")])])
    with pytest.raises(q.QualityError, match="t.k_not_null"):
        q.gate(spark, results, run_ts=datetime(2024, 1, 1), save=saved.append, report=lambda _: None)
    assert saved[0].count() == 2 and saved[0].columns[-1] == "run_timestamp"


def test_gate_passes(spark, items):
    results = q.check_suite("l", [("t", items, [q.row_count_gt(0)])])
    assert len(q.gate(spark, results, report=lambda _: None)) == 1


@pytest.mark.parametrize("extra, partial, matched", [(0, False, True), (1, False, False), (1, True, True), (-1, True, False)])
def test_reconcile(spark, extra, partial, matched):
    got = q.reconcile(spark.range(5), spark.range(5 + extra), partial_source=partial).first()
    assert (got.source_rows, got.target_rows, got.matched) == (5, 5 + extra, matched)
