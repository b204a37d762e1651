"""Profiling aggregates of raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import as_amount, elapsed_days, exact_sum, percent, reached
from . import aggregates
from .joins import keep_known, lookup
from .skew import hot_keys, split_join


def overview(tables: dict[str, DataFrame], keys: dict[str, str], times: dict[str, str]) -> DataFrame:
    """Rows per table; distinct values of a key column and time span where named."""
    def one(name: str, df: DataFrame) -> DataFrame:
        ts = F.col(times[name]).cast("timestamp_ntz") if name in times else F.lit(None).cast("timestamp_ntz")
        distinct = F.countDistinct(keys[name]) if name in keys else F.lit(None).cast("bigint")
        return df.agg(
            F.count("*").alias("row_count"), distinct.alias("distinct_keys"),
            F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """NULL count and percentage of every column that has NULLs, in one scan."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_null")) for i, c in enumerate(df.columns)
    ])
    return (
        counts.select("_rows", F.inline(entries))
        .filter(F.col("n_null") > 0)
        .select(F.lit(table).alias("table_name"), "column_name", "n_null", percent("n_null", "_rows").alias("pct_null"))
        .orderBy(F.desc("n_null"), "column_name")
    )


def null_breakdown(df: DataFrame, nullable: str, by: str) -> DataFrame:
    """Rows whose ``nullable`` is NULL, per value of ``by``."""
    return aggregates.frequency(df.filter(F.col(nullable).isNull()), by)


def null_rate(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"), F.count_if(F.col(column).isNull()).alias("n_null")).withColumn(
        "pct_null", percent("n_null", "total_rows"))


def score_mean(df: DataFrame, score: str) -> DataFrame:
    return df.agg(F.count(score).alias("scored"), F.round(F.avg(score), 2).alias("mean_score"))


def elapsed_histogram(df: DataFrame, start: str, end: str, low: int = 0, high: int = 60, bins: int = 60) -> DataFrame:
    """Delivery time in whole 24-hour days, clipped and binned."""
    return aggregates.histogram(df, elapsed_days(start, end), low, high, bins)


def elapsed_mean(df: DataFrame, start: str, end: str) -> DataFrame:
    days = elapsed_days(start, end)
    return df.agg(F.count(days).alias("finished"), F.round(F.avg(days), 2).alias("mean_days"))


def top_groups_by_amount(
    items: DataFrame, valid: DataFrame, parent_key: str, products: DataFrame, product_key: str,
    category: str, names: DataFrame, name: str, amount: str, k: int, default: str = "unknown",
) -> DataFrame:
    """Categories with the greatest amount over the items of valid parents.
    Amounts are summed per product before the two lookups."""
    per_product = keep_known(items, valid, [parent_key]).groupBy(product_key).agg(exact_sum(amount).alias("_amount"))
    with_category = per_product.join(products.select(product_key, category), product_key, "left")
    per_category = with_category.groupBy(category).agg(F.sum("_amount").alias("_amount"))
    named = lookup(per_category, names, category, name, default)
    return (
        named.groupBy(name).agg(as_amount(F.sum("_amount")).alias("revenue"))
        .orderBy(F.desc("revenue"), name).limit(k)
    )


def top_groups_by_count(fact: DataFrame, dim: DataFrame, key: str, group: str, k: int, name: str = "orders") -> DataFrame:
    """Groups of a dimension attribute with the most fact rows. Facts are counted
    per key before the join."""
    per_key = fact.groupBy(key).agg(F.count("*").alias("_n"))
    return (
        per_key.join(dim.select(key, group), key).groupBy(group).agg(F.sum("_n").alias(name))
        .orderBy(F.desc(name), group).limit(k)
    )


def late_rate(df: DataFrame, status: str, wanted: str, actual: str, promised: str) -> DataFrame:
    """Share of late rows among the delivered ones."""
    delivered = reached(status, wanted, actual)
    late = delivered & (F.col(actual) > F.col(promised))
    return df.agg(F.count_if(delivered).alias("delivered"), F.count_if(late).alias("late")).withColumn(
        "late_rate_pct", percent("late", "delivered"))


def repeat_rate(per_person: DataFrame, count: str, names: tuple[str, str, str]) -> DataFrame:
    """Second aggregation level: persons, persons with two or more, percent. The
    repeat count over no persons is NULL."""
    total, repeat, rate = names
    return per_person.agg(
        F.count("*").alias(total), F.sum(F.when(F.col(count) >= 2, 1).otherwise(0)).alias(repeat)
    ).withColumn(rate, percent(repeat, total))


def orders_per_person(orders: DataFrame, customers: DataFrame, key: str, person: str, order: str, name: str) -> DataFrame:
    """Distinct orders per person, where a person may own several customer keys."""
    per_key = orders.groupBy(key, order).agg(F.count("*").alias("_n"))
    owned = split_join(per_key, customers.select(key, person), [key], "inner", hot_keys(orders, [key]))
    return owned.groupBy(person).agg(F.countDistinct(order).alias(name))


def key_diagnostics(df: DataFrame, keys: list[list[str]]) -> DataFrame:
    """Rows against distinct keys for several candidate keys."""
    def one(columns: list[str]) -> DataFrame:
        return aggregates.duplicate_surplus(df, columns).select(F.lit(",".join(columns)).alias("key_columns"), "*")

    return reduce(DataFrame.unionByName, [one(k) for k in keys])


def out_of_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows whose later event precedes the earlier one."""
    return df.agg(F.count_if(F.col(later) < F.col(earlier)).alias("anomalies"))
