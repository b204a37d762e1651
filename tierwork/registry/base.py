"""Registration of the queries and of the SQL they must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sinks.tables import Warehouse


@dataclass(frozen=True)
class Tables:
    """The given tables of one directory, read on first use."""

    spark: SparkSession
    folder: str
    opened: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def warehouse(self, label: str) -> Warehouse:
        """A fresh warehouse in the shared folder, apart from all others."""
        wh = Warehouse(self.spark, scratch_path(self.spark, label), namespace=f"tw_{uuid.uuid4().hex[:12]}_")
        wh.bootstrap()
        return wh


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL where there is one."""
    def register(fn: Callable[[Tables], DataFrame]):
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register
