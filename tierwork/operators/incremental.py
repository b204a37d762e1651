"""Incremental append with a high-watermark.

A load has one commit point: the ledger row that names the batch, its row count
and the new watermark together. A load that dies earlier leaves a folder nobody
reads; the next load has the same batch number and replaces it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import newer_than
from ..schema import EPOCH_WATERMARK
from ..sinks.tables import Warehouse, append_batch, append_rows, publish, publish_empty, with_partitions
from ..sources.files import inline_rows
from . import membership
from .sets import absent_rows, replace_rows
from .windows import dedupe

LEDGER = "meta.batch_ledger"
WATERMARKS = "meta.ingest_watermark"
MEMBERS = "meta.batch_members"
LEDGER_SCHEMA = (
    "table_name string, batch_id bigint, batch_uuid string, operation string, "
    "row_count bigint, watermark_value timestamp_ntz, committed_at timestamp"
)


@dataclass(frozen=True)
class Position:
    """How far a table has been loaded."""

    watermark: datetime
    batch_id: int


@dataclass(frozen=True)
class Load:
    batch_id: int | None
    row_count: int
    watermark: datetime


def epoch() -> datetime:
    return datetime.fromisoformat(EPOCH_WATERMARK)


def position(wh: Warehouse, name: str) -> Position:
    """Watermark and last batch of a table; the epoch and 0 before its first load."""
    if not wh.exists(LEDGER):
        return Position(epoch(), 0)
    row = (
        wh.table(LEDGER).filter(F.col("table_name") == name)
        .agg(F.max("watermark_value").alias("mark"), F.max("batch_id").alias("batch")).first()
    )
    return Position(row["mark"] or epoch(), row["batch"] or 0)


def loaded_rows(wh: Warehouse, names: list[str]) -> int:
    """Rows of all committed batches, from the ledger."""
    if not wh.exists(LEDGER):
        return 0
    return wh.table(LEDGER).filter(F.col("table_name").isin(*names)).agg(F.sum("row_count")).first()[0] or 0


def new_rows(df: DataFrame, mark_column: str, mark) -> DataFrame:
    """Rows strictly newer than the watermark. The comparison is on the bare
    column, so it reaches the Parquet or JDBC scan. NULL is never newer."""
    return df.filter(newer_than(mark_column, mark))


def advance_watermark(current: DataFrame, name: str, value, updated_at) -> DataFrame:
    """The watermark table with one table's row replaced."""
    types = {f.name: f.dataType.simpleString() for f in current.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in ("table_name", "watermark_value", "updated_at"))
    fresh = inline_rows(current.sparkSession, [(name, value, updated_at)], schema)
    return replace_rows(current, "table_name", name, fresh)


def watermarks_after(current: DataFrame, loaded: DataFrame, mark_column: str, name: str, updated_at) -> DataFrame:
    """Like :func:`advance_watermark`, with the new value taken from loaded rows
    inside the plan."""
    fresh = loaded.agg(F.max(mark_column).alias("watermark_value")).select(
        F.lit(name).alias("table_name"),
        F.col("watermark_value").cast(current.schema["watermark_value"].dataType).alias("watermark_value"),
        F.lit(updated_at).cast(current.schema["updated_at"].dataType).alias("updated_at"),
    )
    return replace_rows(current, "table_name", name, fresh)


def publish_watermarks(wh: Warehouse) -> None:
    """The current watermark of every table, derived from the ledger."""
    wh.spark.sql(
        f"CREATE OR REPLACE VIEW {wh.catalog_name(WATERMARKS)} AS SELECT table_name, max(watermark_value) AS watermark_value, "
        f"max(committed_at) AS updated_at FROM {wh.catalog_name(LEDGER)} GROUP BY table_name"
    )


def _commit(wh: Warehouse, name: str, batch_id: int, rows: int, mark: datetime, run_ts: datetime, operation: str, batch_uuid: str) -> None:
    entry = (name, batch_id, batch_uuid, operation, rows, mark, run_ts)
    append_rows(wh, inline_rows(wh.spark, [entry], LEDGER_SCHEMA), LEDGER)
    publish_watermarks(wh)


def load_micro_batch(wh: Warehouse, rows: DataFrame, name: str, mark_column: str, partition_ts: str, stream: str, epoch: int) -> Load:
    """Append micro-batch ``epoch`` of a stream as the table's next batch.

    The ledger keeps stream and epoch with the batch, so a repeated micro-batch is
    told from a new one whatever else was loaded into the table. A stream that the
    ledger doesn't know, on a table that another stream has fed, has lost its progress
    and would load every file again: it is refused. One control row reaches the driver.
    """
    own, at = f"stream {stream} {epoch}", position(wh, name)
    if at.batch_id:
        fed = wh.table(LEDGER).filter((F.col("table_name") == name) & F.col("operation").startswith("stream "))
        seen = fed.agg(F.count_if(F.col("operation") == own).alias("own"), F.count_if(~F.col("operation").startswith(f"stream {stream} ")).alias("others")).first()
        if seen["own"]:
            return Load(None, 0, at.watermark)
        if seen["others"]:
            raise RuntimeError(f"{name} was fed by another stream: its progress folder is lost, and the files it has read would be loaded again")
    return load_batch(wh, rows, name, mark_column, partition_ts, at.batch_id + 1, operation=own)


def load_increment(
    wh: Warehouse, df: DataFrame, name: str, mark_column: str, partition_ts: str,
    lookback: timedelta | None = None, keys: list[str] | None = None, run_ts: datetime | None = None,
) -> Load:
    """Append the rows newer than the stored watermark as one batch, partitioned
    by the month of ``partition_ts``.

    By default late rows and rows equal to the watermark are not loaded. With
    ``lookback`` the window starts earlier and rows already present (same
    ``keys`` and watermark value) are left out instead; see :func:`unseen_rows` for
    what is read for that. A source without the watermark column falls back to
    ``partition_ts``.
    """
    if lookback and not keys:
        raise ValueError("a load that looks back needs the keys that tell rows apart")
    mark_column = mark_column if mark_column in df.columns else partition_ts
    at = position(wh, name)
    start = at.watermark - lookback if lookback else at.watermark
    rows = new_rows(df, mark_column, start)
    identity = [*keys, mark_column] if lookback else None
    if lookback and at.batch_id:
        rows = unseen_rows(wh, name, rows, identity, mark_column, start, at.watermark)
    return load_batch(wh, rows, name, mark_column, partition_ts, at.batch_id + 1, run_ts, members=identity)


def holding_batches(wh: Warehouse, name: str, rows: DataFrame, keys: list[str], start: datetime) -> list[int]:
    """Committed batches that may hold one of ``rows`` (all later than ``start``): those
    whose watermark is past ``start`` and whose filter passes a key. A batch without
    a filter over these keys, or whose keys are of other types, counts as holding."""
    ledger = wh.table(LEDGER).filter((F.col("table_name") == name) & (F.col("watermark_value") > F.lit(start)))
    found = {r["batch_id"]: r["batch_uuid"] for r in ledger.select("batch_id", "batch_uuid").collect()}     # one row a batch
    if not wh.exists(MEMBERS):
        return sorted(found)
    stored, said = wh.table(name), _identity(rows, keys)
    if said != _identity(stored, keys):
        return sorted(found)
    sketches = wh.table(MEMBERS).filter((F.col("table_name") == name) & (F.col("identity") == said) & F.col("batch_uuid").isin(*found.values()))
    sizes = {r["batch_id"]: r["size_log2"] for r in sketches.select("batch_id", "size_log2").distinct().collect()}
    return sorted({b for b in found if b not in sizes} | set(membership.may_hold(rows, sketches, keys, sizes)))


def _identity(df: DataFrame, keys: list[str]) -> str:
    """Names and types of the keys: filters hash values of exactly these types."""
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def unseen_rows(wh: Warehouse, name: str, rows: DataFrame, keys: list[str], mark_column: str, start: datetime, watermark: datetime) -> DataFrame:
    """The rows that the table doesn't hold yet, one per key (``mark_column`` is one of
    ``keys``). Rows past the watermark can't be in it; only the others are compared,
    and only with the batches that may hold one of them, which prunes partitions."""
    ahead = newer_than(mark_column, watermark)
    late = rows.filter(~ahead)
    batches = holding_batches(wh, name, late, keys, start)
    newer = dedupe(rows.filter(ahead), keys).select(*rows.columns)
    if not batches:
        return dedupe(late, keys).select(*rows.columns).unionByName(newer)
    held = wh.table(name).filter(F.col("batch_id").isin(*batches))
    return absent_rows(late, new_rows(held, mark_column, start), keys).unionByName(newer)


def load_batch(
    wh: Warehouse, rows: DataFrame, name: str, mark_column: str, partition_ts: str, batch_id: int, run_ts: datetime | None = None,
    operation: str = "append", members: list[str] | None = None,
) -> Load:
    """Append ``rows`` as batch ``batch_id``, whatever their watermark. A batch that
    the ledger already names is not loaded again. ``operation`` is what the ledger
    says of the batch. With ``members`` a filter over these columns is kept with it."""
    at = position(wh, name)
    if batch_id <= at.batch_id:
        return Load(None, 0, at.watermark)
    mark_column = mark_column if mark_column in rows.columns else partition_ts
    rows = rows.withColumn("_part_ts", F.col(partition_ts).cast("timestamp_ntz"))
    spec = "months(_part_ts)"
    folder = append_batch(wh, rows, name, batch_id, spec)

    # count and maximum come from the files just written: the source may have
    # gained rows since, and they must not move the watermark
    written = wh.spark.read.schema(with_partitions(rows, spec)[0].schema).parquet(folder)
    loaded = written.agg(F.count("*").alias("n"), F.max(F.col(mark_column).cast("timestamp_ntz")).alias("mark")).first()
    if loaded["n"] == 0:
        if not wh.exists(name):
            publish_empty(wh, name, with_partitions(rows, spec)[0].withColumn("batch_id", F.lit(0)))
        return Load(None, 0, at.watermark)
    mark = max(at.watermark, loaded["mark"] or at.watermark)
    batch_uuid = uuid.uuid4().hex
    if members:     # before the commit; a load that dies here leaves a filter under an id that the ledger never names
        kept = membership.sketch(written, members, loaded["n"])
        append_rows(wh, kept.select(
            F.lit(name).alias("table_name"), F.lit(batch_uuid).alias("batch_uuid"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(_identity(written, members)).alias("identity"), "size_log2", "bucket", "bits"), MEMBERS)
    _commit(wh, name, batch_id, loaded["n"], mark, run_ts or datetime.now(timezone.utc), operation, batch_uuid)
    publish(wh, name, wh.location(name), f"batch_id <= {batch_id}")
    return Load(batch_id, loaded["n"], mark)
