"""Column functions on literal edge values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierwork.functions import columns as c


def one(spark, schema, values, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr).collect()]


def test_blank_rule_keeps_a_tab(spark):
    assert one(spark, "s string", [" x ", "", "  ", "\t", None], c.blank_to_null("s")) == ["x", None, None, "\t", None]


def test_clean_text_leaves_other_types(spark):
    df = spark.createDataFrame([(" a ", 1)], "s string, n int")
    assert c.clean_text(df).collect() == [("a", 1)]


@pytest.mark.parametrize("kind, values, expected", [
    ("int", ["12", "x", "12.0", "12.5", " 7 ", None, "99999999999"], [12, None, 12, None, 7, None, None]),
    ("double", ["1.5", "x", None], [1.5, None, None]),
    ("timestamp_ntz", ["2020-01-02 03:04:05", "2020-13-01", None], [datetime(2020, 1, 2, 3, 4, 5), None, None]),
])
def test_coercion_turns_bad_values_into_null(spark, kind, values, expected):
    assert one(spark, "s string", values, c.coerced("s", kind)) == expected


def test_coerce_columns_ignores_absent_names(spark):
    df = c.coerce_columns(spark.createDataFrame([("1", "a")], "n string, s string"), {"n": "int", "missing": "int"})
    assert df.dtypes == [("n", "int"), ("s", "string")] and df.collect() == [(1, "a")]


@pytest.mark.parametrize("start, end, calendar, elapsed", [
    (datetime(2020, 1, 1, 23), datetime(2020, 1, 2, 1), 1, 0),
    (datetime(2020, 1, 1, 1), datetime(2020, 1, 2, 1), 1, 1),
    (datetime(2020, 1, 2, 1), datetime(2020, 1, 1, 23), -1, -1),
    (datetime(2020, 1, 1, 0, 0, 1), datetime(2020, 1, 1), 0, -1),
    (datetime(2020, 3, 28), datetime(2020, 3, 30), 2, 2),
])
@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris"])
def test_day_differences(spark, start, end, calendar, elapsed, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(c.calendar_days("a", "b"), c.elapsed_days("a", "b")).first() == (calendar, elapsed)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_key_and_months(spark):
    df = spark.createDataFrame([(datetime(2020, 12, 31, 23),), (None,)], "a timestamp_ntz")
    got = df.select(c.date_key("a"), c.month_start("a"), c.next_month("a")).collect()
    assert got == [(20201231, date(2020, 12, 1), date(2021, 1, 1)), (None, None, None)]


def test_month_bounds_cross_the_year():
    assert c.month_bounds("2019-12") == ("2019-12-01", "2020-01-01")
    assert c.month_bounds("2019-02") == ("2019-02-01", "2019-03-01")


def test_in_month_is_half_open(spark):
    moments = [datetime(2020, 1, 31, 23, 59, 59, 999999), datetime(2020, 2, 1), datetime(2020, 2, 29, 23), datetime(2020, 3, 1)]
    assert one(spark, "a timestamp_ntz", moments, c.in_month("a", "2020-02")) == [False, True, True, False]


def test_predicates_and_null(spark):
    assert one(spark, "s string", ["a", "b", None], c.not_in("s", ["b"])) == [True, False, None]
    assert one(spark, "n int", [0, 1, 5, 6, None], c.outside("n", 1, 5)) == [True, False, False, True, None]
    marks = [datetime(2020, 1, 1), datetime(2020, 1, 1, 0, 0, 0, 1), None]
    assert one(spark, "a timestamp_ntz", marks, c.newer_than("a", datetime(2020, 1, 1))) == [False, True, None]
    days = [date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7), date(2024, 1, 8)]
    assert one(spark, "d date", days, c.is_weekend("d")) == [False, True, True, False]


def test_reached_is_three_valued(spark):
    df = spark.createDataFrame([("delivered", None), (None, 3), (None, None), ("shipped", None)], "s string, d int")
    assert [r[0] for r in df.select(c.reached("s", "delivered", "d")).collect()] == [True, True, None, False]


def test_in_box_includes_its_edges(spark):
    df = spark.createDataFrame([(-35.0, -75.0), (6.0, -34.0), (6.1, -40.0), (None, -40.0)], "a double, b double")
    assert [r[0] for r in df.select(c.in_box("a", "b", (-35, 6), (-75, -34))).collect()] == [True, True, False, None]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(c.percent("a", "b")).collect()] == [33.33, None, None]


def test_money_sums_are_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "v double")
    assert df.agg(c.money_total("v")).first()[0] == 1.0


def test_bins_clip_and_keep_null(spark):
    values = [-5.0, 0.0, 59.9, 60.0, 1000.0, None]
    assert one(spark, "v double", values, c.bin_number("v", 0, 60, 60)) == [0, 0, 59, 59, 59, None]
