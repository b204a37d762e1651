"""Relational sources over JDBC. The driver jar comes from the cluster."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str
    schema: str = ""
    properties: dict[str, str] = field(default_factory=dict)

    def options(self, **more) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties, **{k: str(v) for k, v in more.items()}}

    def qualified(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table


@dataclass(frozen=True)
class Slices:
    """How to read one table with several connections at once."""

    column: str
    lower: object
    upper: object
    count: int

    def options(self) -> dict[str, object]:
        return {
            "partitionColumn": self.column, "lowerBound": self.lower,
            "upperBound": self.upper, "numPartitions": self.count,
        }


def read_table(spark: SparkSession, source: JdbcSource, table: str, slices: Slices | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Whole-table scan. Column pruning and plain comparisons, the watermark
    filter among them, are pushed to the database by Spark. Without ``slices``
    one connection reads the whole table."""
    options = source.options(dbtable=source.qualified(table), fetchsize=fetch_size, **(slices.options() if slices else {}))
    return spark.read.format("jdbc").options(**options).load()


def read_query(spark: SparkSession, source: JdbcSource, query: str) -> DataFrame:
    """Run ``query`` in the database and read its result, e.g. a count."""
    return spark.read.format("jdbc").options(**source.options(query=query)).load()


def count_rows(spark: SparkSession, source: JdbcSource, table: str) -> DataFrame:
    """Row count taken by the database."""
    return read_query(spark, source, f"SELECT COUNT(*) AS row_count FROM {source.qualified(table)}")


def column_slices(spark: SparkSession, source: JdbcSource, table: str, column: str, count: int) -> Slices | None:
    """Slice bounds from the database's own minimum and maximum; None when the
    table is empty. Rows outside the bounds would still be read, by the outer slices."""
    span = read_query(
        spark, source, f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source.qualified(table)}").first()
    return None if span is None or span[0] is None else Slices(column, span[0], span[1], count)
