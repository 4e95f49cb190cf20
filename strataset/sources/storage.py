"""Files as rows, and access to the store from inside a task."""

from __future__ import annotations

import sys

import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system a path lives on and the path on it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, file_size_bytes) of the files matching a path or glob.

    Only the listing is used: the content column is pruned, so no file is read.
    """
    return spark.read.format("binaryFile").load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
    )


def plain_path(uri: Column) -> Column:
    """A file URI as a path: escapes decoded, the local scheme dropped."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")
