"""Writers: Parquet by phase, split and level, JSON lines, reports, and the file layout as data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from strataset.functions.numbering import dense_position
from strataset.operators.ir import ir_projection
from strataset.operators.terms import sample_per_group
from strataset.schemas import PROJECT_RECORD
from strataset.session import hold, open_together, scratch_path
from strataset.sources import planned

# File limit, share of it that is used, rows per split file; rows per gzipped file.
MAX_MB = 9
FILL = 0.9
SPLIT_ROWS = 10_000
JSON_ROWS = 250_000


def _row_bytes(df: DataFrame) -> Column:
    """The size of a row before compression."""
    sizes = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    return reduce(lambda a, b: a + b, sizes).cast("long")


def rows_per_file(df: DataFrame, max_mb: float = MAX_MB, key: str | None = None) -> int | None:
    """How many rows fit into a file, by the mean size over all rows; None without rows.

    With `key` the group of the largest mean decides. Sizes are those before compression, so files
    come out smaller than the limit.
    """
    per_group = df.groupBy(*([key] if key else [])).agg(F.avg(_row_bytes(df)).alias("_bytes"))
    largest = per_group.agg(F.max("_bytes")).first()[0]
    return None if largest is None else max(int(max_mb * 1024 * 1024 * FILL / max(largest, 1)), 1)


def _write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str], rows: int | None, gather: bool = False
) -> None:
    """Parquet below key=value directories.

    With a limit on rows each task writes the rows it has, to a few files per directory: the limits
    are far below what a task holds, so gathering a directory's rows first would only add a
    shuffle. Without one, `gather` brings a directory's rows together in as many tasks as their
    size asks for, else every task would write a small file to every directory.
    """
    if gather:
        df = df.hint("rebalance", *[F.col(k) for k in keys])
    writer = df.write.partitionBy(*keys).option("compression", "snappy")
    if rows is not None:
        writer = writer.option("maxRecordsPerFile", rows)
    with open_together(df.sparkSession):
        writer.parquet(path)


def write_phase_parquet(records: DataFrame, path: str, max_mb: float = MAX_MB) -> None:
    """Records by phase, in files of at most about `max_mb`; an empty phase writes nothing.

    The records are gone through once for their sizes and once to be written.
    """
    _write_partitioned(records, path, ["phase"], rows_per_file(records, max_mb, "phase"))


def write_split_parquet(df: DataFrame, path: str, rows: int = SPLIT_ROWS) -> None:
    """Rows by split, at most `rows` per file; an empty split writes nothing."""
    _write_partitioned(df, path, ["split"], rows)


def write_project_parquet(records: DataFrame, path: str) -> None:
    """Project records in the full layout, by phase."""
    full = records.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in PROJECT_RECORD.fields
    ])
    _write_partitioned(full, path, ["phase"], None, gather=True)


def write_ir_parquet(ir: DataFrame, path: str) -> None:
    """IR records in the persisted layout, by phase and level."""
    _write_partitioned(
        ir_projection(ir), path, ["phase", "optimization_level"], None, gather=True
    )


def chunk_plan(
    df: DataFrame, key: str, order: Sequence[Column], rows: int = SPLIT_ROWS
) -> DataFrame:
    """The file each row belongs to: chunk, chunks and file_name, `rows` rows per file and key.

    Rows are written once and keep their place. Their key, order and place are sorted and numbered, and
    the file is told to them where they lie, so other columns are neither sorted nor moved. `order` must
    be unique inside a key; a null key is a key.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "chunk-rows")
    taken = {"chunk", "chunks", "file_name", "_pos", *(f"_order{i}" for i in range(len(order)))} & set(df.columns)
    if taken:
        raise ValueError(f"columns have names that are needed: {', '.join(sorted(taken))}")
    df.write.parquet(path)
    sorted_by = {f"_order{i}": o for i, o in enumerate(order)}
    keys = planned.locate(spark, path).select(
        F.col(f"`{key}`").alias("_key"), *[o.alias(n) for n, o in sorted_by.items()], planned.FILE, planned.ROW
    )
    placed = dense_position(keys, [F.col(n) for n in sorted_by], within=["_key"], name="_pos")
    # Held, so that its true size decides how it is joined: a few rows go to every task, and the
    # rows of a huge key are not brought together.
    sizes = hold(
        placed.groupBy(F.col("_key").alias("_sized")).agg(F.ceil(F.max("_pos") / rows).cast("int").alias("chunks")),
        "chunk-sizes",
    )
    places = placed.join(sizes, F.col("_key").eqNullSafe(F.col("_sized"))).select(
        planned.FILE, planned.ROW, F.expr(f"CAST((_pos - 1) DIV {rows} AS INT)").alias("chunk"), "chunks"
    )
    return planned.attach(spark, path, df.columns, places).withColumn(
        "file_name", F.format_string("%s-%05d-of-%05d.parquet", F.col(f"`{key}`"), "chunk", "chunks")
    )


def export_jsonl(df: DataFrame, path: str) -> int:
    """All rows as JSON lines, nulls written out; returns how many, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option(
        "ignoreNullFields", False
    ).json(path)
    return seen.get["rows"]


def write_sample_jsonl(terms: DataFrame, path: str, n: int = 1000) -> None:
    """The first terms of each group as JSON lines below sample=<group>/."""
    sample = sample_per_group(terms, n).withColumn("sample", F.col("character_group"))
    sample.write.partitionBy("sample").option("ignoreNullFields", False).json(path)


def write_grouped_json(df: DataFrame, key: str, path: str) -> None:
    """JSON lines below key=<value>/, gzipped, as the names and nulls of each record are most of its text.

    A gzipped file is read by one task from its start, so it has at most `JSON_ROWS` records.
    """
    with open_together(df.sparkSession):
        (
            df.write.partitionBy(key).option("ignoreNullFields", False).option("compression", "gzip")
            .option("maxRecordsPerFile", JSON_ROWS).json(path)
        )


def write_report_json(df: DataFrame, path: str) -> None:
    """Each row as a pretty JSON document; a report is usually one row."""
    text = F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]),
        {"pretty": "true", "ignoreNullFields": "false"},
    )
    df.select(text.alias("value")).write.option("lineSep", "\n").text(path)
