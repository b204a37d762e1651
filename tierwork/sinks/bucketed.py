"""Tables bucketed by a key, so that joins and totals on it need no exchange.

Rows are dealt to buckets by the hash of the key when they are written, one sorted
file a bucket; two tables with the same number of buckets join bucket by bucket, and
a total by key stays in its bucket. A key with a large share of the rows would fill
one bucket and one task: such keys (found by a sketch while writing, bounded in
number) are stored apart, without buckets, and meet the other side by broadcast,
which has one row for each of them.

A version is a pair of catalog tables; a view over both publishes it. Bucket
numbers live in the catalog, so this layout needs a persistent metastore to outlive
the session.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import MIN_HOT_ROWS, hot_keys, key_hash
from .tables import Warehouse

HOT_PROPERTY = "tierwork.hot"
VERSION_PROPERTY = "tierwork.version"


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table: rows of ordinary keys, rows of hot keys, and the hashes of
    the latter. A table that is unique by key has no hot keys."""

    key: str
    buckets: int
    cold: DataFrame
    hot: DataFrame
    hashes: tuple[int, ...]

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)


def _is_hot(df: DataFrame, key: str, hashes) -> Column:
    return key_hash([key], {key: dict(df.dtypes)[key]}).isin(list(hashes)) if hashes else F.lit(False)


def write_bucketed(wh: Warehouse, df: DataFrame, name: str, key: str, buckets: int, unique: bool = False, min_hot_rows: int = MIN_HOT_ROWS) -> Bucketed:
    """Write a version of ``name`` in ``buckets`` buckets of ``key`` and publish it.
    ``unique`` says that no key repeats, which spares the sketch."""
    if wh.table_format != "parquet":
        raise ValueError("buckets are written as Parquet tables; use a bucket transform where the catalog has a table format")
    hashes = tuple(h.key_hash for h in ([] if unique else hot_keys(df, [key], min_hot_rows)))
    version = uuid.uuid4().hex
    hot = _is_hot(df, key, hashes)
    stem = f"{wh.catalog_name(name)}__{version}"
    # one task a bucket writes one sorted file
    df.filter(~hot).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{wh.location(name)}/version={version}/cold").saveAsTable(f"{stem}_cold")
    df.filter(hot).write.option("path", f"{wh.location(name)}/version={version}/hot").saveAsTable(f"{stem}_hot")
    wh.spark.sql(
        f"CREATE OR REPLACE VIEW {wh.catalog_name(name)} TBLPROPERTIES ('{HOT_PROPERTY}' = '{json.dumps([key, buckets, *hashes])}', '{VERSION_PROPERTY}' = '{version}') "
        f"AS SELECT * FROM {stem}_cold UNION ALL SELECT * FROM {stem}_hot")
    return open_bucketed(wh, name)


def open_bucketed(wh: Warehouse, name: str) -> Bucketed:
    """The current version of a bucketed table."""
    found = {r["key"]: r["value"] for r in wh.spark.sql(f"SHOW TBLPROPERTIES {wh.catalog_name(name)}").collect()}
    if HOT_PROPERTY not in found:
        raise LookupError(f"{name} is not bucketed")
    key, buckets, *hashes = json.loads(found[HOT_PROPERTY])
    stem = f"{wh.catalog_name(name)}__{found[VERSION_PROPERTY]}"
    return Bucketed(key, buckets, wh.spark.table(f"{stem}_cold"), wh.spark.table(f"{stem}_hot"), tuple(hashes))


def _matching(left: Bucketed, right: Bucketed) -> None:
    if (left.key, left.buckets, dict(left.cold.dtypes)[left.key]) != (right.key, right.buckets, dict(right.cold.dtypes)[right.key]):
        raise ValueError("tables join bucket by bucket only with the same key, type and number of buckets")
    if right.hashes:
        raise ValueError("the right side has to be unique by key")


def bucket_join(left: Bucketed, right: Bucketed, how: str = "inner", columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """Join with a side that is unique by key (``columns`` of it, rows with ``where``).
    Rows of ordinary keys stay in their buckets; rows of hot keys stay where they are
    and meet at most one row for each hot key."""
    _matching(left, right)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot join buckets by {how}")
    other = right.cold if where is None else right.cold.filter(where)
    other = other if columns is None else other.select(left.key, *columns)
    joined = left.cold.join(other.hint("merge"), left.key, how)
    if not left.hashes:
        return joined
    few = other.filter(_is_hot(other, left.key, left.hashes))
    return joined.unionByName(left.hot.join(F.broadcast(few), left.key, how))


def bucket_totals(parent: Bucketed, child: Bucketed, totals: dict[str, Column]) -> DataFrame:
    """Left join of a parent, unique by key, with totals of its child. Totals of
    ordinary keys are made and joined within a bucket; hot keys are summed map-side
    and come to one row each."""
    _matching(child, parent)
    sums = [c.alias(n) for n, c in totals.items()]
    apart = _is_hot(parent.cold, parent.key, child.hashes)
    joined = parent.cold.filter(~apart).join(child.cold.groupBy(child.key).agg(*sums).hint("merge"), child.key, "left")
    if not child.hashes:
        return joined
    few = child.hot.groupBy(child.key).agg(*sums)
    return joined.unionByName(parent.cold.filter(apart).join(F.broadcast(few), child.key, "left"))
