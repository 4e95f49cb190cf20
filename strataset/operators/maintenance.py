"""Keeping a dataset current: changed files, duplicates, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strataset.functions.names import unused
from strataset.session import hold


def with_hash(files: DataFrame) -> DataFrame:
    return files.withColumn("content_hash", F.sha2("content", 256))


def incremental_extract(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The files that are new or changed against (file_path, content_hash) of an earlier run.

    Only paths and hashes are compared and moved. The list of changed paths is held, so that its
    true size decides how contents are picked: few changes go to every task, and contents are
    filtered by path where they are read, before any is hashed again.
    """
    keys = ["file_path", "content_hash"]
    hashed = with_hash(files)
    changed = hold(
        hashed.select(*keys).join(seen, keys, "left_anti").select("file_path").distinct(),
        "changed-files",
    )
    return with_hash(files.join(changed, "file_path", "left_semi"))


def _comparable(name: str, dtype: T.DataType) -> Column:
    """A column as a key: long values by their hash, maps by their sorted entries."""
    column = F.col(f"`{name}`")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.sha2(column.cast("binary"), 256)
    if isinstance(dtype, T.MapType):
        return F.sort_array(F.map_entries(column))
    return column


def dedup_records(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first record, by `order`, of those that agree in `keys`; nulls agree with each other.

    Keys are compared by value, strings and binary ones by their hash, so long texts are not sorted
    as keys. The filter is of the form Spark turns into a limit per group ahead of the shuffle, so
    a group of very many copies shrinks to one row per partition before it is moved. All columns of
    the frame are kept, whatever their names.
    """
    *own, rank = unused(df.columns, *[f"_key{i}" for i in range(len(keys))], "_rank")
    names = {n: _comparable(k, df.schema[k].dataType) for n, k in zip(own, keys)}
    first = Window.partitionBy(*names).orderBy(*[F.col(f"`{c}`") for c in order])
    return (
        df.withColumns(names)
        .withColumn(rank, F.row_number().over(first))
        .filter(F.col(rank) == 1)
        .drop(*names, rank)
    )


def completeness_check(files: DataFrame, phases: Sequence[str], records: DataFrame) -> DataFrame:
    """(file_path, phase) pairs without any record."""
    wanted = files.select(
        "file_path", F.explode(F.array(*[F.lit(p) for p in phases])).alias("phase")
    )
    return wanted.join(
        records.select("file_path", "phase").distinct(), ["file_path", "phase"], "left_anti"
    )
