"""Moving tables to another location or partitioning, guarded by their contents, and
fingerprints kept with table versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import contents
from .tables import Warehouse, append_rows, publish, read_version, record_version, with_partitions, write_files

CONTENTS = "meta.version_contents"


class RewriteError(RuntimeError):
    """The rewritten table does not hold the rows of the original."""


def rewrite_table(wh: Warehouse, name: str | None, df: DataFrame, target: str, partitioned_by: str = "") -> tuple[int, int]:
    """Write ``df`` to ``target``, read it back, compare row count and content
    fingerprint, and only then record it as a version of ``name`` and publish it. The
    original files are left in place. A value that changed at an equal number of rows
    is found as well as a lost row."""
    before = contents.whole(df)
    write_files(df, target, partitioned_by)
    columns = with_partitions(df, partitioned_by)[0].schema
    after = contents.whole(wh.spark.read.schema(columns).parquet(target), df.columns)
    if after != before:
        said = f"{before[0]} rows became {after[0]}" if after[0] != before[0] else f"the {before[0]} rows are not those of the original"
        raise RewriteError(f"{name or target}: {said}; nothing was published")
    if name is not None:
        record_version(wh, {name: (uuid.uuid4().hex, target, after[0], columns)}, "rewrite")
        publish(wh, name, target, columns=columns)
    return before[0], after[0]


def record_contents(wh: Warehouse, name: str, version: str, by: list[str]) -> None:
    """Keep the fingerprints of a version by partition, read from its files. One row a
    partition; ``slot`` is its values as JSON, so tables of any partitioning share
    the log."""
    found = contents.fingerprints(read_version(wh, name, version), by)
    append_rows(wh, found.select(
        F.lit(name).alias("table_name"), F.lit(version).alias("version"), _slot(by).alias("slot"), "row_count", *contents.SUMS), CONTENTS)


def _slot(by: list[str]):
    return F.to_json(F.struct(*by), {"ignoreNullFields": "false"})


def compare_versions(wh: Warehouse, name: str, before: str, after: str) -> DataFrame:
    """Partitions in which two versions differ, from their stored fingerprints: slot,
    rows_before, rows_after. No data file is read."""
    log = wh.table(CONTENTS).filter(F.col("table_name") == name)
    known = {r["version"] for r in log.filter(F.col("version").isin(before, after)).select("version").distinct().collect()}
    for version in (before, after):
        # an empty version has no partition to keep a row of
        if version not in known and not read_version(wh, name, version).isEmpty():
            raise LookupError(f"{name}: no contents are kept of version {version}")
    one, other = (log.filter(F.col("version") == v).dropDuplicates(["slot"]) for v in (before, after))
    return contents.differing(one, other, ["slot"])


def changed_between(wh: Warehouse, name: str, before: str, after: str, by: list[str]) -> DataFrame:
    """The rows by which two stored versions differ, with ``change`` as in
    :func:`contents.changed_rows`; reads the differing partitions alone."""
    old = read_version(wh, name, before)
    types = ", ".join(f"`{c}` {old.schema[c].dataType.simpleString()}" for c in by)
    slots = compare_versions(wh, name, before, after).select(F.from_json("slot", types).alias("of")).select(*[F.col(f"of.{c}").alias(c) for c in by])
    return contents.changed_rows(old, read_version(wh, name, after).select(*old.columns), by, slots)
