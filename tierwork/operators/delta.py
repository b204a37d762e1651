"""Signed partial sums: what a changed set of rows does to an aggregate.

An aggregate whose measures are sums is kept as a state, one row per group. The rows
that a batch replaces are summed with a minus sign, their successors with a plus
sign, and the sums are added to the state; a group without rows is dropped. The cost
follows the changed rows, and the result is that of a full aggregation as long as
sums are exact (whole numbers and decimals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROWS = "n_rows"     # rows that a group stands for; a group of none is dropped


def partial_sums(df: DataFrame, groups: list[str], measures: dict[str, Column]) -> DataFrame:
    """groups, n_rows and one sum per measure."""
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias(ROWS), *[F.sum(m).alias(name) for name, m in measures.items()])


def sums_of(state: DataFrame, groups: list[str]) -> list[str]:
    return [c for c in state.columns if c not in groups]


def summed(parts: DataFrame, groups: list[str]) -> DataFrame:
    """Partial rows of the same group as one; a NULL sum counts as nothing."""
    return parts.groupBy(*groups).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast(parts.schema[c].dataType).alias(c) for c in sums_of(parts, groups)])


def difference(before: DataFrame, after: DataFrame, groups: list[str]) -> DataFrame:
    """What has to be added to a state when ``before`` gives way to ``after``, both
    partial sums. Groups that stay as they were are left out."""
    sums = sums_of(after, groups)
    less = before.select(*groups, *[(-F.col(c)).cast(after.schema[c].dataType).alias(c) for c in sums])
    changed = summed(after.unionByName(less), groups)
    return changed.filter(" OR ".join(f"`{c}` <> 0" for c in sums))


def folded(state: DataFrame, delta: DataFrame, groups: list[str]) -> DataFrame:
    """The state with the difference added."""
    return summed(state.unionByName(delta.select(*state.columns)), groups).filter(F.col(ROWS) != 0)
