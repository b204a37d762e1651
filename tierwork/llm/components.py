"""Connected components over an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import pinned

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b): root is the smallest
    vertex of its component. Alternates between linking larger neighbours to the
    smallest one (large star) and smaller neighbours to it (small star); both keep
    the number of edges at most, so a star of any size stays linear. Each round
    ends in a checkpoint; edges with a NULL end and loops are ignored.
    """
    edges = pinned(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = pinned(small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
