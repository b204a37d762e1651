"""Reads of a table as it was: rows carry the batch that brought them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def batch_history(df: DataFrame, batch: str = "batch_id", committed: str = "committed_at", operation: str = "append") -> DataFrame:
    """One row per batch: when it was committed and how many rows it added."""
    return df.groupBy(batch).agg(
        F.lit(operation).alias("operation"),
        F.max(committed).alias("committed_at"),
        F.count("*").alias("added_rows"),
    )


def with_summary(history: DataFrame, columns: list[str]) -> DataFrame:
    """Fold columns into a text map ``summary``, as version metadata is kept."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return history.select(*[c for c in history.columns if c not in columns], F.create_map(*pairs).alias("summary"))


def summary_value(key: str) -> Column:
    """Look up one entry of ``summary``; NULL when it is absent."""
    return F.try_element_at("summary", F.lit(key))


def as_of_version(df: DataFrame, version, batch: str = "batch_id") -> DataFrame:
    """Rows visible at a version of an append table. On a table partitioned by
    batch this prunes partitions."""
    return df.filter(F.col(batch) <= F.lit(version))


def as_of_time(df: DataFrame, moment: str, committed: str = "committed_at") -> DataFrame:
    """Rows committed up to a moment."""
    return df.filter(F.col(committed) <= F.lit(moment))


def replaced_as_of(df: DataFrame, version, batch: str = "batch_id") -> DataFrame:
    """Rows of a table that each batch replaces as a whole: those of the last
    batch not after ``version``. The one-row maximum is broadcast and prunes
    the partitions of the other side at run time."""
    visible = df.filter(F.col(batch) <= F.lit(version))
    last = visible.agg(F.max(batch).alias(batch))
    return visible.join(F.broadcast(last), batch, "left_semi")


def compare_versions(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows at the first and at the current version, from per-batch counts."""
    counts = df.groupBy(batch).agg(F.count("*").alias("n"))
    return counts.agg(
        F.min(F.struct(batch, "n")).alias("first"), F.max(batch).alias("current_version"), F.sum("n").alias("current_rows")
    ).select(
        F.col(f"first.{batch}").alias("first_version"), F.col("first.n").alias("first_rows"),
        "current_version", "current_rows",
    )


def file_stats(df: DataFrame, k: int = 20) -> DataFrame:
    """The data files with the most rows: path, rows and bytes."""
    files = df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    return (
        files.groupBy("file_path").agg(F.count("*").alias("record_count"), F.max("file_size").alias("file_size_in_bytes"))
        .orderBy(F.desc("record_count"), "file_path").limit(k)
    )
