"""Profiles that are kept by batch and merged, so that a new batch costs its own rows.

A state is a small table of counts: rows, NULLs of each column, rows of each value of
chosen columns, and bins of chosen numbers. States add up, so the profile of a table is
the sum over its batches, and equals that of a full scan. Value counts are exact; choose
columns with few values, as a state has a row for each.

Defined cases: an empty batch has no state and adds nothing; NULL is a value like any
other in value counts and is in no bin.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import bin_number
from ..sinks.tables import Warehouse, append_rows
from .incremental import LEDGER

STATES = "meta.profile_states"
_KEYS = ["kind", "column_name", "value"]


@dataclass(frozen=True)
class ProfileSpec:
    """What is counted besides rows and NULLs: values of ``frequencies``, and bins of
    ``bins`` (column -> low, high, number of bins)."""

    frequencies: tuple[str, ...] = ()
    bins: dict[str, tuple[float, float, int]] = field(default_factory=dict)


def states_of(df: DataFrame, spec: ProfileSpec, batch: str = "batch_id") -> DataFrame:
    """batch, kind, column_name, value, n of each batch of ``df``. Counts are combined
    map-side, so a batch that holds most rows sends no more than another."""
    columns = [c for c in df.columns if c != batch]
    totals = df.groupBy(batch).agg(F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)])

    def entry(kind: str, column: str | None, value, n=None):
        parts = [F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column_name"), value.cast("string").alias("value")]
        return F.struct(*parts, *([] if n is None else [n.alias("n")]))

    nothing = F.lit(None)
    counts = totals.select(batch, F.inline(F.array(
        entry("rows", None, nothing, F.col("_rows")), *[entry("nulls", c, nothing, F.col(f"_null_{i}")) for i, c in enumerate(columns)])))
    shown = [entry("value", c, F.col(f"`{c}`")) for c in spec.frequencies]
    binned = [entry("bin", c, bin_number(F.col(f"`{c}`"), *limits)) for c, limits in spec.bins.items()]
    if not shown and not binned:
        return counts
    seen = df.select(batch, F.inline(F.array(*shown, *binned))).filter((F.col("kind") == "value") | F.col("value").isNotNull())
    return counts.unionByName(seen.groupBy(batch, *_KEYS).agg(F.count("*").alias("n")))


def merged(states: DataFrame) -> DataFrame:
    """kind, column_name, value, n over all batches."""
    return states.groupBy(*_KEYS).agg(F.sum("n").alias("n"))


def new_batches(wh: Warehouse, name: str) -> dict[int, str]:
    """Committed batches of a table that have no state yet; one row a batch."""
    ledger = wh.table(LEDGER).filter(F.col("table_name") == name).select("batch_id", "batch_uuid")
    if wh.exists(STATES):
        ledger = ledger.join(wh.table(STATES).filter(F.col("table_name") == name).select("batch_uuid").distinct(), "batch_uuid", "left_anti")
    return {r["batch_id"]: r["batch_uuid"] for r in ledger.collect()}


def pending(wh: Warehouse, name: str, batches: dict[int, str]) -> DataFrame:
    """The rows of some batches; other partitions are not read."""
    return wh.table(name).filter(F.col("batch_id").isin(*batches))


def update(wh: Warehouse, name: str, spec: ProfileSpec) -> int:
    """Bring the stored states up to the ledger and return the number of batches read."""
    batches = new_batches(wh, name)
    if batches:
        ids = F.create_map(*[x for b, u in batches.items() for x in (F.lit(b).cast("bigint"), F.lit(u))])
        found = states_of(pending(wh, name, batches), spec)
        append_rows(wh, found.select(
            F.lit(name).alias("table_name"), F.try_element_at(ids, F.col("batch_id").cast("bigint")).alias("batch_uuid"), *_KEYS, "n"), STATES)
    return len(batches)


def profile(wh: Warehouse, name: str) -> DataFrame:
    """The merged profile of a table's committed batches. A batch that was profiled
    twice, by two updates at the same time, counts once."""
    committed = wh.table(LEDGER).filter(F.col("table_name") == name).select("batch_uuid")
    states = wh.table(STATES).filter(F.col("table_name") == name).join(committed, "batch_uuid", "left_semi")
    return merged(states.dropDuplicates(["batch_uuid", *_KEYS]))
