"""Joins of the layered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import skew
from .windows import dedupe, full_row_order


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default) -> DataFrame:
    """Left join to a lookup table; a miss gets ``default``. The lookup is made
    unique by key first, so the join cannot multiply rows."""
    unique = dedupe(table.select(key, value).filter(F.col(key).isNotNull()), [key])
    joined = skew.sized_join(df, unique, [key], "left")
    rest = [c for c in df.columns if c != key]
    return joined.select(key, *rest, F.coalesce(F.col(value), F.lit(default)).alias(value))


def with_child_totals(
    parent: DataFrame, child: DataFrame, keys: list[str], totals: dict[str, Column], hot: list[skew.HotKey] | None = None,
) -> DataFrame:
    """Left join a parent with its pre-aggregated child. The aggregation combines
    on the map side and its partitioning is reused by the join, unless keys that
    the parent repeats have to be split. They are measured on the parent unless
    given; an empty list says that it is unique by key."""
    summary = child.groupBy(*keys).agg(*[expr.alias(name) for name, expr in totals.items()])
    hot = skew.hot_keys(parent, keys, other=summary) if hot is None else hot
    return skew.split_join(parent, summary, keys, "left", hot)


def with_group_total(
    df: DataFrame, keys: list[str], total: Column, name: str,
    over: DataFrame | None = None, min_hot_rows: int = skew.MIN_HOT_ROWS,
) -> DataFrame:
    """Bring a group total back to every row of the group. Written as aggregate
    plus join, not as a window: a window would hold a whole group in one task.
    A row with a NULL key gets NULL. ``over`` names the rows to total when they
    are not the rows to keep."""
    source = df if over is None else over
    totals = source.groupBy(*keys).agg(total.alias(name))
    joined = skew.split_join(df, totals, keys, "left", skew.hot_keys(source, keys, min_hot_rows, df))
    return joined.select(*df.columns, name)


def deduped_with_total(
    df: DataFrame, keys: list[str], group: list[str], total: Column, name: str, min_hot_rows: int = skew.MIN_HOT_ROWS,
) -> DataFrame:
    """One row per key as :func:`dedupe` keeps it, with the total of its ``group`` (some
    of the keys; ``total`` is a bare aggregate) over all rows, also those that are
    dropped. A row with a NULL in ``group`` gets NULL.

    Without hot groups the rows move once, by ``group``, and windows add both: no group
    is then large. With one, totals are aggregated and joined, as :func:`with_group_total`
    does; they depend on the group alone, so fewer rows are joined after the
    deduplication."""
    if skew.hot_keys(df, group, min_hot_rows):
        return with_group_total(dedupe(df, keys), group, total, name, over=df, min_hot_rows=min_hot_rows)
    complete = F.lit(True)
    for key in group:
        complete = complete & F.col(key).isNotNull()
    ranked = df.repartition(*group).withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*full_row_order(df, keys))))
    totalled = ranked.withColumn(name, F.when(complete, total.over(Window.partitionBy(*group))))
    return totalled.filter(F.col("_rank") == 1).drop("_rank")


def attach_key(fact: DataFrame, dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Left join that attaches the surrogate key of a dimension."""
    return skew.sized_join(fact, dim.select(natural, surrogate), [natural], "left")


def keep_known(df: DataFrame, valid: DataFrame, keys: list[str], hot: list[skew.HotKey] | None = None) -> DataFrame:
    """Keep rows whose key occurs in ``valid`` (semi join), hot keys split. They
    are measured on ``df`` unless given; an empty list skips the measurement."""
    hot = skew.hot_keys(df, keys, other=valid) if hot is None else hot
    return skew.split_join(df, valid.select(*keys), keys, "left_semi", hot)


def orphan_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts. NULL is an orphan.

    Rows are counted per key before the anti join, so a hot key crosses the
    network as one partial count per task. The parent key is renamed because
    both sides may share a lineage.
    """
    counted = child.groupBy(F.col(child_key).alias("_child")).agg(F.count("*").alias("orphan_rows"))
    known = parent.select(F.col(parent_key).alias("_parent"))
    missing = counted.join(known, F.col("_child") == F.col("_parent"), "left_anti")
    return missing.select(F.col("_child").alias(child_key), "orphan_rows")


def update_from(
    target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str], min_hot_rows: int = skew.MIN_HOT_ROWS,
) -> DataFrame:
    """UPDATE ... FROM: overwrite ``columns`` where the key matches, also with
    NULL; other rows stay as they are. ``updates`` must be unique by key."""
    fresh = updates.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = skew.split_join(target, fresh, keys, "left", skew.hot_keys(target, keys, min_hot_rows, fresh))
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns
    ])
