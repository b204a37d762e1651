"""Batches driven by arriving files.

Structured Streaming remembers which files were read and numbers its
micro-batches; each becomes the table's next batch, and the ledger keeps the stream
and the number with it. What is loaded does not depend on how many files one
micro-batch holds, nor on the order in which they arrive; a micro-batch that is
repeated after a failure is not loaded twice, and one of a table that watermark
loads have fed as well is not lost. A stream without its progress is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..operators.incremental import load_micro_batch
from ..sinks.tables import Warehouse


def follow_folder(
    wh: Warehouse, folder: str, schema: StructType | str, name: str, mark_column: str, partition_ts: str,
    file_format: str = "parquet", files_per_batch: int = 1000,
) -> None:
    """Load every file that has arrived since the last call, then return. The
    query's progress is kept beside the warehouse."""
    arriving = (
        wh.spark.readStream.format(file_format).schema(schema)
        .option("maxFilesPerTrigger", files_per_batch).option("latestFirst", False).load(folder)
    )

    def load(batch: DataFrame, epoch: int) -> None:
        # Spark names the query here; the name stays with the progress folder
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_micro_batch(wh, batch, name, mark_column, partition_ts, stream, epoch)

    query = (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{wh.layer_path('meta')}/progress/{name}")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
