"""Files of a wanted size after encoding: written once, measured by their footers, packed without a shuffle."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from strataset.session import any_path, delete, open_together, scratch, scratch_path
from strataset.sinks.writers import FILL, MAX_MB
from strataset.sources.files import read_footers
from strataset.sources.storage import open_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NULL = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of null keys
_ROWS = 4096
_LEAST_FILL = 0.7  # of the largest file; below it files are packed again
_TRIES = 4  # packings for the sake of fullness; the limit is kept however many that takes
_TRIAL = 32  # bins that show how files are encoded together, before all are packed
_JOB = 2000  # bins of a job, whose plan every task is told

Piece = tuple[str, int, int]  # file, rows from and to


@dataclass
class Bin(InputPartition):
    values: list[str | None]  # of the keys
    pieces: list[Piece]


class _BinReader(DataSourceReader):
    def __init__(self, bins: list, keys: int, schema: T.StructType) -> None:
        self._bins, self._keys, self._schema = bins, keys, schema

    def partitions(self) -> list[InputPartition]:
        return [Bin(values, [tuple(p) for p in pieces]) for values, pieces in self._bins]

    def read(self, partition: Bin) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self._schema)
        columns = self._schema.names[: len(target) - self._keys]
        for path, first, last in partition.pieces:
            store, local = open_store(path)
            with store.open_input_file(local) as handle:
                file, start = pq.ParquetFile(handle), 0
                for group in range(file.num_row_groups):
                    rows = file.metadata.row_group(group).num_rows
                    if start < last and first < start + rows:
                        at = start
                        for batch in file.iter_batches(_ROWS, [group], columns):
                            if at >= last:
                                break
                            a, b = max(first - at, 0), min(last - at, batch.num_rows)
                            if a < b:
                                kept = pa.Table.from_batches([batch.slice(a, b - a)]).select(columns)
                                for field, value in zip(list(target)[len(columns):], partition.values):
                                    kept = kept.append_column(field, pa.array([value] * (b - a), pa.string()))
                                yield from kept.cast(target).combine_chunks().to_batches()
                            at += batch.num_rows
                    start += rows


class Bins(DataSource):
    """Pieces of Parquet files, a task per bin; made by `pack_files`."""

    @classmethod
    def name(cls) -> str:
        return "strataset_bins"

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["fields"]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BinReader(json.loads(self.options["bins"]), int(self.options["keys"]), schema)


def plan_bins(files: Sequence[tuple[tuple, str, int, int]], target: float) -> list[tuple[tuple, list[Piece]]]:
    """Pack files (values of the keys, path, rows, bytes) into bins of at most `target` bytes and one value
    of the keys, in the order of their paths; a file that is larger is cut by rows, one at least.

    What is left of a bin is filled with rows of the next file, so all bins of a value but the last are full.
    """
    bins: list[tuple[tuple, list[Piece]]] = []
    last, room = None, 0.0
    for values, path, rows, size in sorted(files, key=lambda f: ([(v is not None, v or "") for v in f[0]], f[1])):
        if not rows:
            continue
        row, at = max(size, 1) / rows, 0
        if values != last:
            last, room = values, 0.0
        while at < rows:
            fits = min(int(max(room, 0) / row), rows - at)
            if not fits:
                bins.append((values, []))
                room = target
                fits = min(max(int(room / row), 1), rows - at)
            bins[-1][1].append((path, at, at + fits))
            at, room = at + fits, room - fits * row
    return bins


def _files(spark: SparkSession, path: str, keys: Sequence[str]) -> list[tuple[tuple, str, int, int]]:
    if not any_path(spark, path.rstrip("/") + "/*" * len(keys) + "/*.parquet"):
        return []
    found = read_footers(spark, path, keys).select(*[F.col(k) for k in keys], "path", "num_rows", "file_size_bytes")
    return [
        (tuple(None if v == _NULL else unquote(v) for v in r[: len(keys)]), *r[len(keys):]) for r in found.collect()
    ]


def pack_files(
    spark: SparkSession, source: str, schema: T.StructType, keys: Sequence[str], out: str, max_mb: float = MAX_MB
) -> None:
    """Write the dataset at `source`, Parquet below key=value folders of text keys, to `out` in files of
    at most `max_mb` that are as full as their encoding lets one plan.

    `schema` is that of the other columns. Footers give rows and bytes of each file, of which the driver has
    a line, as for any scan. Each bin of pieces is read by one task and written as one file, so no row is
    exchanged. Files encoded together have another size than apart: the largest file that came out corrects
    the plan. If there are many bins, some of all folders are packed for that first, and all of them once;
    files that are still above the limit are packed again, from what was written, and deleted then, until
    none is, or holds one row only.
    """
    files = _files(spark, source, keys)
    limit = max_mb * 1024 * 1024
    shape = T.StructType([*schema.fields, *[T.StructField(k, T.StringType()) for k in keys]])
    spark.dataSource.register(Bins)

    def write(bins: list, to: str, mode: str) -> None:
        for a in range(0, max(len(bins), 1), _JOB):
            packed = spark.createDataFrame([], shape)
            if bins:
                packed = (
                    spark.read.format(Bins.name()).option("fields", shape.json()).option("keys", str(len(keys)))
                    .option("bins", json.dumps(bins[a : a + _JOB])).load()
                )
            with open_together(spark):
                packed.write.mode("append" if a else mode).partitionBy(*keys).option("compression", "snappy").parquet(to)

    target, tried = limit * FILL, 0
    while True:
        bins, tried = plan_bins(files, target), tried + 1
        step = -(-len(bins) // _TRIAL) or 1
        some = bins[::step]
        to = out if step == 1 else scratch_path(spark, "trial")
        write(some, to, "overwrite")
        if not bins:
            return
        made = _files(spark, to, keys)
        above = [f for f in made if f[3] > limit and f[2] > 1]
        largest = max((f[3] for f in above), default=max(f[3] for f in made))
        several = len(bins) > len({values for values, _ in bins})
        if not above and (tried >= _TRIES or not several or largest >= _LEAST_FILL * limit):
            break
        target *= limit * FILL / largest
    if step == 1:
        return
    write(bins, out, "overwrite")
    target = limit * FILL
    while above := [f for f in _files(spark, out, keys) if f[3] > limit and f[2] > 1]:
        write(plan_bins(above, target), out, "append")
        delete(spark, [f[1] for f in above])
        target *= FILL


def write_packed_parquet(
    df: DataFrame, path: str, keys: Sequence[str] = ("phase",), max_mb: float = MAX_MB
) -> None:
    """Rows by text keys in files that are nearly `max_mb` large after encoding; an empty key writes nothing.

    The rows are evaluated once and written as the tasks have them, and packed from there; the first files
    are deleted. Null keys keep their folder.
    """
    spark = df.sparkSession
    rest = T.StructType([f for f in df.schema.fields if f.name not in keys])
    with scratch(spark):
        first = scratch_path(spark, "unpacked")
        # A bin reads the row groups it has rows of, so these are not much larger than a bin.
        group = min(max(int(4 * max_mb * 1024 * 1024), 1 << 20), 128 << 20)
        with open_together(spark):
            df.write.partitionBy(*keys).option("compression", "snappy").option("parquet.block.size", group).parquet(first)
        pack_files(spark, first, rest, keys, path, max_mb)
