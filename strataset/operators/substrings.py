"""Substring search over a stored dataset through an index of its trigrams."""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from strataset.sources.storage import plain_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 16  # rows of a file that share a posting list
MOST_GRAMS = 32  # of a needle that are looked up; what is found is verified, so fewer lose nothing
_HELD = 1 << 20  # places a task holds before it hands them on
_INDEX = "gram string, file string, block long, deltas array<int>"


def _grams(text: str) -> set[str]:
    """The trigrams of a text; none where it is shorter."""
    return {text[i:i + 3] for i in range(len(text) - 2)}


def _bytes(text: Column) -> Column:
    """A text in lower case, as Spark has it for all texts and needles."""
    return F.lower(text).cast("binary")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each trigram, file and block, as far as a task has them; bytes that are no UTF-8 are replaced,
    which leaves the letters around them as they are."""
    found, held = defaultdict(list), 0

    def out() -> pa.RecordBatch:
        keys, rows = list(zip(*found)), list(found.values())
        made = [pa.array(k, t) for k, t in zip(keys, (pa.string(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays([*made, pa.array(rows, pa.list_(pa.int32()))], ["file", "block", "gram", "rows"])

    for batch in batches:
        for file, at, text in zip(*(batch[c].to_pylist() for c in ("file", "at", "text"))):
            block, row = divmod(at, BLOCK)
            for gram in _grams(text.decode("utf-8", "replace")):
                found[file, block, gram].append(row)
                held += 1
            if held >= _HELD:
                yield out()
                found.clear()
                held = 0
    if found:
        yield out()


def write_index(spark: SparkSession, dataset: str, schema: T.StructType, column: str, index: str) -> None:
    """Write the trigram index of a text column of a Parquet dataset.

    A row is known by its file and its number there. Per trigram and block of 65,536 rows of a file there
    is a list of rows, sorted and stored as differences, so the lists of a common trigram are as long as a
    block at most. A task has whole stretches of a file and shortens them to lists before it shuffles.
    """
    at = F.col("_metadata")
    rows = spark.read.schema(schema).parquet(dataset).select(
        at["file_path"].alias("file"), at["row_index"].alias("at"), _bytes(F.col(f"`{column}`")).alias("text")
    ).filter(F.octet_length("text") >= 3)
    lists = (
        rows.mapInArrow(_lists, "file string, block long, gram string, rows array<int>")
        .groupBy("gram", "file", "block").agg(F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"))
    )
    before = F.concat(F.array(F.lit(0)), F.slice("rows", F.lit(1), F.size("rows") - 1))
    packed = lists.withColumn("deltas", F.zip_with("rows", before, lambda a, b: a - b)).drop("rows")
    place = ["gram", "file", "block"]
    packed.repartitionByRange(*place).sortWithinPartitions(*place).write.parquet(index)


def read_index(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(index)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are in all lists of their block, from the shortest list on."""
    for batch in batches:
        for file, block, lists in zip(*(batch[c].to_pylist() for c in ("file", "block", "lists"))):
            first, *others = sorted((np.cumsum(x) for x in lists), key=len)
            for other in others:
                first = np.intersect1d(first, other, assume_unique=True)
            if len(first):
                yield pa.RecordBatch.from_pydict(
                    {"file": pa.array([file] * len(first)), "row": pa.array(first + block * BLOCK, pa.int64())}
                )


def needle_grams(spark: SparkSession, needle: str) -> list[str]:
    """The trigrams of a needle that are looked up, spread over all it has."""
    text = spark.range(1).select(_bytes(F.lit(needle))).first()[0]
    found = sorted(_grams(bytes(text).decode("utf-8", "replace")))
    return [found[i * len(found) // MOST_GRAMS] for i in range(MOST_GRAMS)] if len(found) > MOST_GRAMS else found


def candidate_rows(index: DataFrame, needle: str) -> DataFrame | None:
    """(file, row) of the rows that hold all trigrams of a needle, whatever their order; None if a needle
    has no trigram. Only the lists of these trigrams are read, by which the index is sorted, and only
    blocks where none of them is missing are taken apart."""
    wanted = needle_grams(index.sparkSession, needle)
    if not wanted:
        return None
    met = (
        index.filter(F.col("gram").isin(wanted)).groupBy("file", "block")
        .agg(F.collect_list("deltas").alias("lists")).filter(F.size("lists") == len(wanted))
    )
    return met.mapInArrow(_common, "file string, row long")


def search(
    spark: SparkSession, dataset: str, schema: T.StructType, column: str, index: str, needle: str
) -> DataFrame:
    """Rows of a dataset whose column contains `needle` whatever the case, as a scan finds them.

    Files that hold a candidate are read and their rows are verified; the driver has the names of these
    files, as it has for any scan. A needle shorter than three letters reads all files.
    """
    found = candidate_rows(read_index(spark, index), needle)
    paths = [dataset]
    if found is not None:
        paths = [r.path for r in found.select("file").distinct().select(plain_path(F.col("file")).alias("path")).collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.filter(F.lower(F.col(f"`{column}`")).contains(F.lower(F.lit(needle))))
