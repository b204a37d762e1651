"""Joins, windows, set operations and aggregates on literal rows."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tierwork.operators import aggregates, joins, profiles, sets, skew, windows
from tierwork.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- joins -------------------------------------------------------------------------


def test_lookup_misses_get_the_default_and_repeats_do_not_multiply(spark):
    products = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, cat string")
    names = spark.createDataFrame([("a", "A"), ("a", "A2"), (None, "N")], "cat string, name string")
    got = joins.lookup(products, names, "cat", "name", "unknown").select("id", "name")
    assert rows(got) == [(1, "A"), (2, "unknown"), (3, "unknown")]


def test_group_total_of_a_null_key_is_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k string, v int")
    got = joins.with_group_total(df, ["k"], F.sum("v"), "total")
    assert rows(got) == sorted([("a", 1, 3), ("a", 2, 3), (None, 5, None)], key=repr)


def test_orphans_count_null_children_and_ignore_repeated_parents(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.orphan_counts(child, "k", parent, "k")) == [(2, 1), (None, 2)]


def test_orphans_with_one_lineage(spark):
    df = spark.createDataFrame([(1, 2), (2, 9)], "id int, boss int")
    assert rows(joins.orphan_counts(df, "boss", df, "id")) == [(9, 1)]


def test_update_writes_null_and_keeps_unmatched(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, s string, n int")
    updates = spark.createDataFrame([(1, "x"), (2, None), (9, "z")], "k int, s string")
    assert rows(joins.update_from(target, updates, ["k"], ["s"])) == [(1, "x", 1), (2, None, 2), (3, "c", 3)]


# ---- hot keys ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 7, another sixth has no key."""
    key = F.when(F.col("id") % 6 < 2, F.lit(7)).when(F.col("id") % 6 == 2, F.lit(None)).otherwise(F.col("id") % 900)
    return spark.range(60_000, numPartitions=16).select(key.cast("bigint").alias("k"), F.col("id").alias("row"))


def test_sketch_finds_the_hot_keys(spark, skewed):
    found = {h.key_hash: h.parts for h in skew.hot_keys(skewed, ["k"], min_rows=1000)}
    hashes = [r[0] for r in spark.createDataFrame([(7,), (None,)], "k bigint").select(F.xxhash64("k")).collect()]
    assert set(found) == set(hashes) and all(parts > 5 for parts in found.values())


def test_no_hot_keys_in_a_small_table(skewed):
    assert skew.hot_keys(skewed, ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(spark, skewed, how):
    right = spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    right = right.unionByName(spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "k bigint, v bigint"))
    hot = skew.hot_keys(skewed, ["k"], min_rows=1000)
    split, plain = skew.split_join(skewed, right, ["k"], how, hot), skewed.join(right, ["k"], how)
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_split_join_spreads_the_hot_key(spark, skewed):
    right = spark.range(900).select(F.col("id").alias("k"))
    hot = skew.hot_keys(skewed, ["k"], min_rows=1000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(df):
            per_task = df.filter("k = 7").groupBy(F.spark_partition_id()).count()
            return max(r["count"] for r in per_task.collect())

        assert largest(skewed.join(right, ["k"], "inner")) == 20_000
        assert largest(skew.split_join(skewed, right, ["k"], "inner", hot)) < 12_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


MIXED_KEYS = [
    ("int", "bigint", 1, 2), ("bigint", "int", 1, 2), ("decimal(10,2)", "decimal(12,4)", "1.5", "2.5"), ("date", "timestamp_ntz", "2020-01-01", "2020-01-02"),
    ("double", "double", -0.0, 3.0), ("int", "double", 0, 5),
]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("left_type,right_type,hot_value,other", MIXED_KEYS)
def test_split_join_compares_keys_of_different_types(spark, how, left_type, right_type, hot_value, other):
    value = F.when(F.col("id") % 10 < 6, F.lit(hot_value).cast(left_type)).when(F.col("id") % 10 < 9, F.lit(other).cast(left_type))
    left = spark.range(2000).repartition(6).select(value.alias("k"), "id")
    zero = F.lit(0.0).cast(right_type) if isinstance(hot_value, float) else F.lit(hot_value).cast(right_type)
    right = spark.range(1).select(zero.alias("k"), F.lit("r").alias("r"))
    hot = skew.hot_keys(left, ["k"], min_rows=100, other=right)
    assert hot
    for known in (hot, skew.hot_keys(left, ["k"], min_rows=100)):
        split, plain = skew.split_join(left, right, ["k"], how, known), left.join(right, ["k"], how)
        assert split.columns == plain.columns
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_hot_keys_of_updates_and_parents_are_split(spark):
    df = spark.range(9000).repartition(6).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id", F.lit(0).alias("v"))
    updates = spark.createDataFrame([(1, 5), (7, 6)], "k int, v int")
    plain = df.join(updates.withColumnRenamed("v", "n"), "k", "left").select("k", "id", F.coalesce("n", "v").alias("v"))
    split = joins.update_from(df, updates, ["k"], ["v"], min_hot_rows=500)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))
    hot = skew.hot_keys(df, ["k"], min_rows=500)
    totals = {"n": F.sum("v")}
    child = updates.unionByName(updates)
    assert sorted(map(str, joins.with_child_totals(df, child, ["k"], totals, hot).collect())) == sorted(
        map(str, joins.with_child_totals(df, child, ["k"], totals, []).collect()))


def test_split_join_refuses_joins_that_keep_the_right_side(skewed):
    with pytest.raises(ValueError):
        skew.split_join(skewed, skewed, ["k"], "full", [])


def test_broadcast_is_measured(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    assert skew.fits_broadcast(df)
    assert not skew.fits_broadcast(df, max_rows=49)
    assert not skew.fits_broadcast(df, max_bytes=40_000)
    assert not skew.fits_broadcast(df.select(F.array("s").alias("a")))


def test_lookup_beyond_broadcast_gives_the_same(spark, skewed, monkeypatch):
    right = spark.range(900).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    small = skew.sized_join(skewed, right, ["k"])
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_: False)
    large = skew.sized_join(skewed, right, ["k"], min_rows=1000)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


# ---- windows -----------------------------------------------------------------------


def test_latest_version_ties_and_nulls(spark):
    a, b = datetime(2020, 1, 1), datetime(2020, 1, 2)
    df = spark.createDataFrame(
        [(1, a, a, "old"), (1, b, a, "tie, earlier load"), (1, b, b, "tie, later load"), (2, None, b, "null"), (2, a, a, "known"),
         (3, None, None, "only")], "k int, updated timestamp_ntz, loaded timestamp_ntz, s string")
    got = windows.latest_version(df, ["k"], ["updated", "loaded"]).select("k", "s")
    assert rows(got) == [(1, "tie, later load"), (2, "known"), (3, "only")]


def test_dedupe_is_independent_of_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    assert rows(windows.dedupe(df.repartition(7), ["k"])) == rows(windows.dedupe(df.repartition(3), ["k"])) == [(i, i) for i in range(10)]


def test_dominant_value_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "a"), (2, "b"), (2, "b"), (3, None)], "k int, v string")
    assert rows(windows.dominant_value(df, ["k"], "v")) == [(1, "a"), (2, "b"), (3, None)]


def test_surrogate_is_dense_and_ordered_over_many_slices(spark):
    df = spark.range(5000).select(F.concat(F.lit("v"), F.lpad((F.col("id") * 7919 % 1000).cast("string"), 4, "0")).alias("v"))
    df = df.unionByName(spark.createDataFrame([(None,)], "v string")).repartition(9)
    got = windows.ordered_surrogate(df, "v", "id")
    assert sorted(map(tuple, got.collect())) == [(i + 1, f"v{i:04d}") for i in range(1000)]


def test_surrogate_of_nothing(spark):
    assert windows.ordered_surrogate(spark.createDataFrame([], "v string"), "v", "id").collect() == []


# ---- set operations ----------------------------------------------------------------


def test_insert_absent_takes_one_row_per_new_key(spark):
    old = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, n int, s string")
    new = spark.createDataFrame([(1, 2, "x"), (1, 3, "z"), (1, 3, "y"), (2, 1, "w")], "k int, n int, s string")
    assert rows(sets.insert_absent(old, new, ["k", "n"])) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "y"), (2, 1, "w")]


def test_upsert_updates_inserts_and_never_deletes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    new = spark.createDataFrame([("B", 2), ("C", 3)], "s string, k int")
    assert rows(sets.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    old=st.dictionaries(st.integers(0, 8), st.integers(0, 9), max_size=8),
    new=st.dictionaries(st.integers(0, 8), st.integers(0, 9), max_size=8),
)
def test_upsert_is_a_dictionary_update(spark, old, new):
    a, b = (spark.createDataFrame(list(d.items()), "k int, v int") for d in (old, new))
    once = sets.upsert(a, b, ["k"])
    assert dict(rows(once)) == {**old, **new}
    assert rows(sets.upsert(once, b, ["k"])) == rows(once)
    assert dict(rows(sets.insert_absent(a, b, ["k"]))) == {**new, **old}


def test_replace_rows(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "t string, v int")
    assert rows(sets.replace_rows(old, "t", "a", spark.createDataFrame([(9, "a")], "v int, t string"))) == [("a", 9), ("b", 2)]


# ---- aggregates --------------------------------------------------------------------


def test_duplicate_surplus_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert aggregates.duplicate_surplus(df, ["k"]).first() == (4, 2, 2)
    assert aggregates.duplicate_surplus(df, ["k"], nulls_equal=False).first() == (4, 1, 3)
    assert aggregates.duplicate_surplus(df.limit(0), ["k"]).first() == (0, 0, 0)


def test_maximum_of_nothing_is_the_default(spark):
    assert aggregates.maximum(spark.createDataFrame([], "v int"), "v", -1) == -1


def test_empty_months_are_filled(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 31),), (datetime(2020, 3, 1),), (None,)], "a timestamp_ntz")
    assert [r["cnt"] for r in aggregates.monthly_counts_filled(df, "a").orderBy("month").collect()] == [1, 0, 1]


def test_null_profile_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "b", 1)], "a int, b string, c int")
    assert [tuple(r) for r in profiles.null_profile(df, "t").collect()] == [("t", "c", 2, 66.67), ("t", "b", 1, 33.33)]


def test_rates_over_nothing(spark):
    empty = spark.createDataFrame([], "n int")
    assert profiles.repeat_rate(empty, "n", ("a", "b", "c")).first() == (0, None, None)


def test_late_rate_counts_delivered_only(spark):
    d1, d2 = datetime(2020, 1, 1), datetime(2020, 1, 2)
    df = spark.createDataFrame(
        [("delivered", d2, d1), ("delivered", d1, d2), ("shipped", None, d1), ("delivered", None, d1)],
        "s string, a timestamp_ntz, p timestamp_ntz")
    assert profiles.late_rate(df, "s", "delivered", "a", "p").first() == (3, 1, 33.33)


# ---- rows at fault in CSV files ----------------------------------------------------


def test_rejects_are_found_with_file_and_reason(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,price,at,note\n1,2.50,2020-01-01,"x, y"\n2,2.5o,never,z\n,3.0,,\n4\n5,1,2020-01-01,u,v\n')
    (tmp_path / "b.csv").write_text("id,price,at,note\n6,,2020-01-02,\n7,12,2020-01-02,\"it \"\"is\"\"\"\n")
    types = {"id": "int", "price": "double", "at": "timestamp_ntz"}
    good, rejects = files.read_csv_with_rejects(spark, str(tmp_path), types, ("id",))
    assert sorted((r.id, r.price, r.note) for r in good.collect()) == [(1, 2.5, "x, y"), (6, None, None), (7, 12.0, 'it "is"')]
    assert good.count() == 3 and rejects.count() == 4        # whatever columns are asked for
    assert {(r._source_file, r.reason, r.record) for r in rejects.collect()} == {
        ("a.csv", "price: not a double; at: not a timestamp_ntz", "2,2.5o,never,z"), ("a.csv", "id: missing", ",3.0,,"),
        ("a.csv", "malformed line", "4"), ("a.csv", "malformed line", "5,1,2020-01-01,u,v")}
    assert dict(good.dtypes) == {**types, "note": "string"}
    empty, none = files.read_csv_with_rejects(spark, str(tmp_path / "b.csv"), types, ("id",), header=True)
    assert empty.count() == 2 and none.isEmpty()


# ---- uniqueness in two phases ------------------------------------------------------


def test_uniqueness_by_fingerprint_is_exact(spark):
    kinds = "a string, b int"
    cases = [
        [], [("x", 1)], [("x", 1), ("x", 2), ("y", 1)], [("x", 1)] * 4 + [("x", 2), (None, 1), (None, 1), (None, None), ("", None)],
        [(f"k{i % 40}", i % 3) for i in range(300)] + [(None, i % 2) for i in range(9)],
    ]
    collisions = [None, F.lit(1).cast("bigint"), F.pmod(F.xxhash64("a"), F.lit(7))]
    for case in cases:
        df = spark.createDataFrame(case, kinds)
        for equal in (True, False):
            want = aggregates.duplicate_surplus(df, ["a", "b"], equal).first()
            for fp in collisions:
                got = aggregates.duplicate_surplus_by_fingerprint(df, ["a", "b"], equal, fp)
                assert got.first() == want and got.dtypes == [("total_rows", "bigint"), ("distinct_keys", "bigint"), ("duplicates", "bigint")]
            assert aggregates.duplicate_surplus_by_fingerprint(df, ["a", "b"], equal, max_repeated=0).first() == want


def test_fingerprints_travel_without_their_keys(spark, tmp_path):
    spark.range(50).select(F.repeat(F.col("id").cast("string"), 50).alias("wide")).write.parquet(f"{tmp_path}/t")
    counts = aggregates.fingerprint_counts(spark.read.parquet(f"{tmp_path}/t"), ["wide"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchange) == 1 and "_fp" in exchange[0] and "wide" not in exchange[0]


@pytest.mark.parametrize("min_hot_rows", [1, 100_000])
def test_deduped_total_is_the_same_with_and_without_hot_groups(spark, min_hot_rows):
    df = spark.createDataFrame(
        [(g, k, v) for g in ("a", "b") for k in (1, 2) for v in (3, 1)] + [("a", 3, None), ("c", 1, None), (None, 1, 5), (None, 1, 4), ("b", None, 2)],
        "g string, k int, v int")
    got = joins.deduped_with_total(df, ["g", "k"], ["g"], F.sum("v"), "total", min_hot_rows)
    assert rows(got) == sorted(
        [("a", 1, 1, 8), ("a", 2, 1, 8), ("a", 3, None, 8), ("b", 1, 1, 10), ("b", 2, 1, 10), ("b", None, 2, 10), ("c", 1, None, None), (None, 1, 4, None)], key=repr)


def test_dedupe_within_a_part_of_the_key(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, None), (None, 2, "x"), (None, 2, "y")], "g int, k int, v string")
    assert rows(windows.dedupe(df, ["g", "k"], within=["g"])) == rows(windows.dedupe(df, ["g", "k"])) == sorted(
        [(1, 1, "a"), (1, 2, None), (None, 2, "x")], key=repr)
