"""Batch-numbered storage for `foreachBatch`: writing a batch again replaces it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from martworks.session import write_table


def write_batch(df: DataFrame, path: str, batch_id: int, *partition_cols: str) -> None:
    write_table(df, f"{path}/batch_id={batch_id}", *partition_cols)


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    return lambda df, batch_id: write_batch(df, path, batch_id)


def stored(spark: SparkSession, path: str, before: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
    """All batches on disk, or those before one; None when nothing is there. A schema allows for batches without files."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        df = reader.parquet(path)
    except Exception as error:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return df if before is None else df.where(F.col("batch_id") < before)


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """Start a query: all data present and stop, or every given interval."""
    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
