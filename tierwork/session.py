"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning is on by default in Spark 4; it is stated here because the
# row-level joins of this package count on it for skew splitting.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``settings`` override the defaults. A cluster supplies
    its own master, shuffle width and memory through spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, default: str | None = None) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or else ``default``,
    a folder that all executors reach.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir() or default
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tierwork-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    return f"{shared_folder(spark).rstrip('/')}/tierwork/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint, so that values which depend
    on physical partitioning stay fixed when executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
