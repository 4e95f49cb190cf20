"""Planned readers: rows and files read where they lie, with columns attached to each of them.

What is worked out about a row from a few of its columns (a number, a file it belongs to) is narrow. To
give it back to whole rows, a join would move their contents. Here the narrow table is sorted by where
the rows lie, and each split of a second scan fetches the stretch that belongs to it, so that contents
are read and never exchanged.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from strataset.functions.numbering import running_totals
from strataset.functions.text import path_order
from strataset.session import scratch_path
from strataset.sources.files import relative_path
from strataset.sources.storage import list_files, open_store, plain_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE, ROW = "_at_file", "_at_row"  # where a row lies: the file it is in and its number there
_SPLIT = "_at_split"
_ROWS = 4096  # rows handed over together, before their size is looked at
_BYTES = 32 << 20  # bytes handed over together, one row at least
_SPLIT_ROWS = 50_000  # rows of a split at most, however small they are


# ---- the narrow side: sorted by place, found by the first and last place of each of its files -----


def _sorted_by(df: DataFrame, keys: Sequence[str], label: str) -> list[list]:
    """Write `df` sorted by `keys`; the files with their least and greatest keys, a row per task."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .write.option("parquet.block.size", 8 << 20).parquet(path)
    )
    place = F.struct(*keys)
    bounds = (
        spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.min(place).alias("least"), F.max(place).alias("most"))
    )
    return sorted([list(r.least), list(r.most), r.path] for r in bounds.collect())


def _overlapping(bounds: list[list], least: list, most: list) -> list[str]:
    return [path for a, b, path in bounds if a <= most and least <= b]


def _stretch(paths: Sequence[str], wanted: list) -> pa.Table | None:
    """The rows of sorted files that pass a filter; row groups beyond it are not read."""
    parts = []
    for path in paths:
        store, local = open_store(path)
        parts.append(pq.read_table(local, filesystem=store, filters=wanted, partitioning=None))
    return pa.concat_tables(parts) if parts else None


def _batches(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.combine_chunks().to_batches(max_chunksize=_ROWS):
        step = max(1, batch.num_rows * _BYTES // max(batch.nbytes, 1))
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step)


def _split_bytes(spark: SparkSession, total: int) -> int:
    """As many bytes as Spark would give to a split of a scan."""

    def setting(key: str) -> int:
        return int(spark._jsparkSession.sessionState().conf().getConf(
            getattr(spark._jvm.org.apache.spark.sql.internal.SQLConf, key)()
        ))

    most, least = setting("FILES_MAX_PARTITION_BYTES"), setting("FILES_OPEN_COST_IN_BYTES")
    return max(1, min(most, max(least, total // spark.sparkContext.defaultParallelism)))


# ---- rows of Parquet files -----------------------------------------------------------------------


@dataclass
class RowRanges(InputPartition):
    ranges: list[tuple[str, int, int, list[str]]]  # file, rows from and to, files of the narrow side


class _RowReader(DataSourceReader):
    def __init__(self, splits: list, columns: Sequence[str], schema: T.StructType) -> None:
        self._splits, self._columns, self._schema = splits, columns, schema

    def partitions(self) -> list[InputPartition]:
        return [RowRanges([tuple(r) for r in ranges]) for ranges in self._splits]

    def read(self, partition: RowRanges) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self._schema)
        extra = self._schema.names[len(self._columns):]
        for path, first, last, sides in partition.ranges:
            side = _stretch(sides, [(FILE, "==", path), (ROW, ">=", first), (ROW, "<", last)])
            if side is None or not side.num_rows:
                continue
            side = side.sort_by(ROW)
            rows = side.column(ROW).to_numpy()
            store, local = open_store(path)
            with store.open_input_file(local) as handle:
                file, start = pq.ParquetFile(handle), 0
                for group in range(file.num_row_groups):
                    n = file.metadata.row_group(group).num_rows
                    if start < last and first < start + n:
                        at = start
                        for batch in file.iter_batches(_ROWS, [group], list(self._columns)):
                            if at >= last:
                                break
                            a, b = np.searchsorted(rows, [max(at, first), min(at + batch.num_rows, last)])
                            if a < b:
                                kept = pa.Table.from_batches([batch]).take(pa.array(rows[a:b] - at))
                                for name in extra:
                                    kept = kept.append_column(name, side.column(name).slice(a, b - a))
                                yield from _batches(kept.select(target.names).cast(target))
                            at += batch.num_rows
                    start += n


class PlannedRows(DataSource):
    """Rows of Parquet files with columns attached to them; made by `attach`."""

    @classmethod
    def name(cls) -> str:
        return "strataset_planned_rows"

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["fields"]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _RowReader(json.loads(self.options["splits"]), json.loads(self.options["columns"]), schema)


def locate(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a Parquet dataset with the place of each, `_at_file` and `_at_row`."""
    return spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)
    )


def attach(spark: SparkSession, path: str, columns: Sequence[str], places: DataFrame) -> DataFrame:
    """`columns` of the rows that `places` (`_at_file`, `_at_row` as from `locate`, unique, and any
    narrow columns) names, with those columns; other rows are left out.

    `places` is sorted and written. Each split reads a range of rows where they lie, fetches the places
    in it and puts both together, so contents are not exchanged, whatever their size. Splits are bounded by
    bytes and by rows: a task holds the places of its split. What reaches the driver is a row per file and
    a line per split, as in any scan. Columns must be top-level ones of types that Arrow and
    Spark read alike, which all but nested timestamps are.
    """
    source = spark.read.parquet(path)
    extra = [f for f in places.schema.fields if f.name not in (FILE, ROW)]
    shape = T.StructType([source.schema[c] for c in columns] + extra)
    if len(set(shape.names)) < len(shape.names):
        raise ValueError("attached columns must have names of their own")
    bounds = _sorted_by(places, [FILE, ROW], "row-places")
    files = (
        source.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.max("_metadata.row_index").alias("last"))
    ).collect()
    size = _split_bytes(spark, sum(r.bytes for r in files))
    splits, held, full = [[]], 0, 0
    for r in sorted(files, key=lambda r: r.path):
        parts = max(1, -(-r.bytes // size), -(-(r.last + 1) // _SPLIT_ROWS))
        step = -(-(r.last + 1) // parts)
        for a in range(0, r.last + 1, step):
            b = min(a + step, r.last + 1)
            sides = _overlapping(bounds, [r.path, a], [r.path, b - 1])
            if not sides:
                continue
            if splits[-1] and (held + r.bytes // parts > size or full + b - a > _SPLIT_ROWS):
                splits.append([])
                held = full = 0
            splits[-1].append((r.path, a, b, sides))
            held, full = held + r.bytes // parts, full + b - a
    return _planned(spark, PlannedRows, shape, splits, columns=json.dumps(list(columns)))


def _planned(spark: SparkSession, source: type[DataSource], shape: T.StructType, splits: list, **more: str) -> DataFrame:
    splits = [s for s in splits if s]
    if not splits:
        return spark.createDataFrame([], shape)
    spark.dataSource.register(source)
    reader = spark.read.format(source.name()).option("fields", shape.json())
    for key, value in {"splits": json.dumps(splits), **more}.items():
        reader = reader.option(key, value)
    return reader.load()


# ---- whole files ---------------------------------------------------------------------------------


@dataclass
class FileStretch(InputPartition):
    split: int
    sides: list[str]


class _FileReader(DataSourceReader):
    def __init__(self, splits: list, schema: T.StructType) -> None:
        self._splits, self._schema = splits, schema

    def partitions(self) -> list[InputPartition]:
        return [FileStretch(*s) for s in self._splits]

    def read(self, partition: FileStretch) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self._schema)
        rows = _stretch(partition.sides, [(_SPLIT, "==", partition.split)])
        held, at, start = [], 0, 0
        rows = rows.sort_by("_at_seq") if rows is not None else pa.table({"uri": []})

        def out(start: int) -> pa.RecordBatch:
            part = rows.slice(start, len(held)).append_column("content", pa.array(held, pa.string()))
            return part.select(target.names).cast(target).combine_chunks().to_batches()[0]

        for i, uri in enumerate(rows.column("uri").to_pylist()):
            store, local = open_store(uri)
            with store.open_input_stream(local) as file:
                held.append(file.read().decode("utf-8", "replace"))
            at += len(held[-1])
            if at >= _BYTES or len(held) >= _ROWS:
                yield out(start)
                start, held, at = i + 1, [], 0
        if held:
            yield out(start)


class PlannedFiles(DataSource):
    """Whole text files in planned splits; made by `planned_texts`."""

    @classmethod
    def name(cls) -> str:
        return "strataset_planned_files"

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["fields"]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FileReader(json.loads(self.options["splits"]), schema)


def list_texts(spark: SparkSession, root: str, names: str, skip: Sequence[str] = ()) -> DataFrame:
    """(uri, file_path, bytes) of the files below a directory whose name matches a glob; see
    `files.scan_text_files` for what is left out. Nothing is read but the listing."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(root)
    found = listed.select(
        F.col("path").alias("uri"), plain_path(F.col("path")).alias("file_path"), F.col("length").alias("bytes")
    )
    folders = F.split(relative_path(F.col("file_path"), root), "/")
    folders = F.slice(folders, F.lit(1), F.size(folders) - 1)
    skipped = F.arrays_overlap(folders, F.array(*[F.lit(s) for s in skip]).cast("array<string>"))
    return found.filter(~F.coalesce(skipped, F.lit(False)))


def planned_texts(spark: SparkSession, listed: DataFrame, order: Column | None = None) -> DataFrame:
    """(file_path, content, other columns of `listed`) of files (uri, file_path, bytes, any more).

    Files are sorted by path, or `order`, and packed into splits by bytes, so that the splits of the
    scan follow the order and a split's files do too; a split of many small files is one task, and the
    contents stay where they are read. Bytes that are no UTF-8 become replacement characters.
    """
    order = path_order(F.col("file_path")) if order is None else order
    more = [f for f in listed.schema.fields if f.name not in ("uri", "file_path", "bytes")]
    shape = T.StructType([
        T.StructField("file_path", T.StringType()), T.StructField("content", T.StringType()), *more
    ])
    counted = listed.withColumn("_files", F.lit(1).cast("long"))
    placed, sums = running_totals(counted, [order], ["bytes", "_files"])
    if not sums["_files"]:
        return spark.createDataFrame([], shape)
    size = _split_bytes(spark, sums["bytes"])
    split = F.floor(F.col("bytes_before") / size).cast("long").alias(_SPLIT)
    plan = placed.select("uri", "file_path", *[f.name for f in more], split, F.col("_files_before").alias("_at_seq"))
    bounds = _sorted_by(plan, [_SPLIT, "_at_seq"], "file-splits")
    splits = []
    for k in range(sums["bytes"] // size + 1):
        sides = [path for a, b, path in bounds if a[0] <= k <= b[0]]
        if sides:
            splits.append((k, sides))
    return _planned(spark, PlannedFiles, shape, splits)
