"""Declarative data-quality checks, compiled to a few aggregates per table.

A suite lists frames with their checks. All row-local checks of one frame become
a single aggregate (one scan); each uniqueness, foreign-key or count check is one
further keyed aggregate. The result is one DataFrame with a row per check.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import outside
from ..sources.files import inline_rows
from .aggregates import duplicate_surplus
from .joins import orphan_counts
from .skew import fits_broadcast

RESULT_SCHEMA = (
    "table_name string, layer string, check_name string, passed boolean, "
    "value double, threshold double, run_timestamp timestamp"
)


LOG = logging.getLogger(__name__)


class QualityError(Exception):
    """At least one check of a suite failed."""


@dataclass(frozen=True)
class RowCheck:
    """A check answered by one aggregate over the table's own rows."""

    name: str
    value: Column
    threshold: float = 0.0
    greater: bool = False  # pass when value > threshold, else when equal


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique_{'_'.join(self.columns)}"


@dataclass(frozen=True)
class ForeignKey:
    child_key: str
    parent: DataFrame
    parent_key: str

    @property
    def name(self) -> str:
        return f"fk_{self.child_key}_in_{self.parent_key}"


@dataclass(frozen=True)
class SameCount:
    name: str
    other: DataFrame


def violations(bad: Column) -> Column:
    """Rows for which ``bad`` is true; NULL is no violation."""
    return F.count_if(bad)


def row_count_gt(n: int = 0) -> RowCheck:
    return RowCheck(f"row_count_gt_{n}", F.count("*"), n, greater=True)


def not_null(column: str) -> RowCheck:
    return RowCheck(f"{column}_not_null", violations(F.col(column).isNull()))


def between(column: str, low, high) -> RowCheck:
    return RowCheck(f"{column}_between_{low}_{high}", violations(outside(column, low, high)))


def in_set(column: str, allowed) -> RowCheck:
    return RowCheck(f"{column}_accepted_values", violations(~F.col(column).isin(*allowed)))


def positive(column: str) -> RowCheck:
    return RowCheck(f"{column}_positive", violations(F.col(column) <= 0))


def non_negative(column: str) -> RowCheck:
    return RowCheck(f"{column}_non_negative", violations(F.col(column) < 0))


def in_window(name: str, column: str, low: str, high: str) -> RowCheck:
    """Time window with day bounds: the upper one is that day's midnight."""
    return RowCheck(name, violations(outside(column, low, high)))


def _verdict(df: DataFrame, table: str, layer: str, name, greater=False) -> DataFrame:
    value, threshold = F.col("value").cast("double"), F.col("threshold").cast("double")
    greater = F.lit(greater) if isinstance(greater, bool) else greater
    return df.select(
        F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), name.alias("check_name"),
        F.when(greater, value > threshold).otherwise(value == threshold).alias("passed"),
        value.alias("value"), threshold.alias("threshold"),
    )


def _row_local(df: DataFrame, table: str, layer: str, checks: list[RowCheck]) -> DataFrame:
    measured = df.agg(*[c.value.alias(f"v{i}") for i, c in enumerate(checks)])
    entries = F.array(*[
        F.struct(
            F.lit(c.name).alias("name"), F.col(f"v{i}").cast("double").alias("value"),
            F.lit(float(c.threshold)).alias("threshold"), F.lit(c.greater).alias("greater"),
        )
        for i, c in enumerate(checks)
    ])
    rows = measured.select(F.inline(entries))
    return _verdict(rows, table, layer, F.col("name"), F.col("greater"))


def _count_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both row counts in one row, without a cross join."""
    sides = left.agg(F.count("*").alias("value")).withColumn("threshold", F.lit(0).cast("bigint")).unionByName(
        right.agg(F.count("*").alias("threshold")).withColumn("value", F.lit(0).cast("bigint"))
    )
    return sides.agg(F.sum("value").alias("value"), F.sum("threshold").alias("threshold"))


def row_measures(checks: list) -> dict[str, Column]:
    """The aggregates of the row-local checks, to be taken while a table is written."""
    return {c.name: c.value for c in checks if isinstance(c, RowCheck)}


def _settled(spark: SparkSession, table: str, layer: str, checks: list[RowCheck], measured: dict) -> DataFrame:
    """Verdicts from values that were taken while the table was written."""
    rows = []
    for c in checks:
        value = float(measured[c.name] or 0)
        rows.append((table, layer, c.name, value > c.threshold if c.greater else value == c.threshold, value, float(c.threshold)))
    return inline_rows(spark, rows, RESULT_SCHEMA.rsplit(",", 1)[0])


def check_table(df: DataFrame, table: str, layer: str, checks: list, measured: dict | None = None) -> DataFrame:
    """Results of the checks of one table (without ``run_timestamp``). Foreign keys
    whose parents measure small are counted in the scan of the row-local checks,
    with the parents' keys broadcast; others by :func:`orphan_counts`. Row-local
    checks that ``measured`` names take their value from there and scan nothing."""
    known_values = [c for c in checks if isinstance(c, RowCheck) and c.name in (measured or {})]
    settled = [_settled(df.sparkSession, table, layer, known_values, measured)] if known_values else []
    checks = [c for c in checks if c not in known_values]
    small = [c for c in checks if isinstance(c, ForeignKey) and fits_broadcast(c.parent.select(c.parent_key))]
    checks = [c for c in checks if c not in small]
    local = [c for c in checks if isinstance(c, RowCheck)]
    for i, check in enumerate(small):
        known = check.parent.select(F.col(check.parent_key).alias(f"_key{i}")).distinct().withColumn(f"_known{i}", F.lit(True))
        df = df.join(F.broadcast(known), F.col(check.child_key) == F.col(f"_key{i}"), "left")
        local.append(RowCheck(check.name, violations(F.col(f"_known{i}").isNull())))
    parts = settled + ([_row_local(df, table, layer, local)] if local else [])
    for check in checks:
        if isinstance(check, Unique):
            found = duplicate_surplus(df, list(check.columns)).select(
                F.col("duplicates").alias("value"), F.lit(0).alias("threshold"))
        elif isinstance(check, ForeignKey):
            missing = orphan_counts(df, check.child_key, check.parent, check.parent_key)
            found = missing.agg(F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("value")).withColumn("threshold", F.lit(0))
        elif isinstance(check, SameCount):
            found = _count_pair(df, check.other)
        else:
            continue
        parts.append(_verdict(found, table, layer, F.lit(check.name)))
    return reduce(DataFrame.unionByName, parts)


def check_suite(layer: str, frames: list[tuple[str, DataFrame, list]], measured: dict[str, dict] | None = None) -> DataFrame:
    """Results of a whole suite: ``(table, frame, checks)`` entries. ``measured``
    holds by table what was measured while it was written."""
    taken = measured or {}
    return reduce(DataFrame.unionByName, [check_table(df, table, layer, checks, taken.get(table)) for table, df, checks in frames])


def reconcile(source: DataFrame, target: DataFrame, partial_source: bool = False) -> DataFrame:
    """Source against target row count: equal, or for an incremental table whose
    source holds only part of the history, target at least source."""
    pair = _count_pair(source, target).select(F.col("value").alias("source_rows"), F.col("threshold").alias("target_rows"))
    rule = F.col("target_rows") >= F.col("source_rows") if partial_source else F.col("target_rows") == F.col("source_rows")
    return pair.withColumn("matched", rule)


def gate(spark: SparkSession, results: DataFrame, run_ts: datetime | None = None, save=None, report=LOG.info) -> list:
    """Run a suite once, report it, save it best effort, then raise
    :class:`QualityError` when a check failed. Only the result rows, one per
    check, reach the driver."""
    run_ts = run_ts or datetime.now(timezone.utc)
    rows = results.collect()
    for r in rows:
        report(f"[{'PASS' if r.passed else 'FAIL'}] {r.table_name}.{r.check_name} value={r.value} threshold={r.threshold}")
    if save is not None:
        save(inline_rows(spark, [(*r, run_ts) for r in rows], RESULT_SCHEMA))
    failed = [f"{r.table_name}.{r.check_name}" for r in rows if not r.passed]
    if failed:
        raise QualityError(f"{len(failed)} check(s) failed: {', '.join(failed)}")
    return rows
