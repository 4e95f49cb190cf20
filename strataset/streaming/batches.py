"""Bounded batches over a stored phase."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from strataset.session import any_path
from strataset.sources.storage import list_files

# Batches that what is stored is read in, about.
BATCHES = 24

Sink = Callable[[DataFrame, int], None]


def batch_files(spark: SparkSession, path: str, least: int, batches: int = BATCHES) -> int:
    """How many files a batch takes: `least`, or what it takes to read a folder in about `batches` of them.

    Each batch has a cost of its own, whatever its size, and its files are read by all tasks there are; a
    fixed number of files would make more batches of more data.
    """
    files = f"{path.rstrip('/')}/*.parquet"
    stored = list_files(spark, files).count() if any_path(spark, files) else 0
    return max(least, -(-stored // batches))


def stream_phase_batches(
    spark: SparkSession, path: str, schema: T.StructType, files: int, checkpoint: str,
    sink: Sink | str, transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Run a phase through `transform`, at most `files` files per batch, until all are read.

    `sink` is a directory, which gets Parquet exactly once, or a function (batch, batch id). A
    restart from the same checkpoint goes on with files that are new.
    """
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    )
    writer = (
        transform(stream).writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format("parquet").option("path", sink).outputMode("append").start()
