"""Summaries of the files of a dataset that shorten the list of files a filter has to read.

Per file and column there are bounds and, where wanted, a Bloom filter. They are kept as tables and made
by one pass over the columns; footers have bounds per row group, but every file has to be opened for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from strataset.functions.keys import order_text
from strataset.session import hold, release
from strataset.sources.storage import plain_path

Condition = tuple[str, str, Any]  # column, one of = < <= > >=, value

_LENGTH = 64  # letters of a bound; a longer one is cut, which only widens it
_BITS = 32_768  # of a part of a Bloom filter, as the bitmap functions have them
_PER_VALUE, _HASHES = 12, 6  # bits for each distinct value, and how many of them it sets: 1 in 200 by chance


def _columns_of(spark: SparkSession, dataset: str, schema: T.StructType, names: Sequence[str]) -> DataFrame:
    at = F.col("_metadata")
    values = [F.col(f"`{n}`").alias(f"v{i}") for i, n in enumerate(names)]
    return spark.read.schema(schema).parquet(dataset).select(
        at["file_path"].alias("file"), at["file_size"].alias("size"),
        at["file_modification_time"].alias("changed"), *values,
    )


def write_bounds(spark: SparkSession, dataset: str, schema: T.StructType, columns: Sequence[str], out: str) -> None:
    """Write (file, size, changed, bounds): least and greatest value of each column as texts in order,
    null where a file has none. Columns of whole numbers, dates, times, strings and binary values."""
    bounds = []
    for i, name in enumerate(columns):
        text = F.when(F.col(f"v{i}").isNotNull(), order_text(F.col(f"v{i}"), schema[name].dataType))
        most = F.max(text)
        bounds.append(F.struct(
            F.lit(name).alias("column"), F.substring(F.min(text), 1, _LENGTH).alias("least"),
            F.when(F.length(most) > _LENGTH, F.concat(F.substring(most, 1, _LENGTH), F.lit("~"))).otherwise(most).alias("most"),
        ))
    rows = _columns_of(spark, dataset, schema, columns)
    rows.groupBy("file", "size", "changed").agg(F.array(*bounds).alias("bounds")).write.parquet(out)


def _hashes(value: Column) -> list[Column]:
    """The part of a filter a value belongs to, before it is cut to the number of parts, and its bits there."""
    return [F.xxhash64(value, F.lit(-1)), *[F.pmod(F.xxhash64(value, F.lit(i)), F.lit(_BITS)) for i in range(_HASHES)]]


def write_blooms(spark: SparkSession, dataset: str, schema: T.StructType, columns: Sequence[str], out: str) -> None:
    """Write (file, size, changed, column, parts, part, bits): a Bloom filter per file and column, in as
    many parts of 4 KB as its distinct values need, each value in one part.

    Values become hashes first, one per file and value, so a hot value is one row, and a file of very many
    values is several parts, which are made apart from each other.
    """
    key = ["file", "size", "changed", "column"]
    rows = _columns_of(spark, dataset, schema, columns)
    values = F.array(*[
        F.struct(F.lit(name).alias("column"), F.when(F.col(f"v{i}").isNotNull(), F.array(*_hashes(F.col(f"v{i}")))).alias("hash"))
        for i, name in enumerate(columns)
    ])
    distinct = hold(
        rows.select(*key[:3], F.inline(values)).filter(F.col("hash").isNotNull()).distinct(), "value-hashes"
    )
    parts = hold(distinct.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) * _PER_VALUE / _BITS).alias("parts")), "bloom-parts")
    dealt = distinct.join(parts, key).select(
        *key, "parts", F.pmod(F.element_at("hash", 1), "parts").alias("part"), F.explode(F.slice("hash", 2, _HASHES)).alias("bit")
    )
    dealt.groupBy(*key, "parts", "part").agg(F.bitmap_construct_agg("bit").alias("bits")).write.parquet(out)
    release(distinct, parts)


def _may_hold(schema: T.StructType, condition: Condition) -> Column:
    """Whether the bounds of a file leave room for a row that meets a condition; true without bounds."""
    name, sign, value = condition
    dtype = schema[name].dataType
    wanted = order_text(F.lit(value).cast(dtype), dtype)
    known = F.get(F.filter("bounds", lambda b: b["column"] == name), 0)
    least, most = known["least"], known["most"]
    room = {
        "=": (least <= wanted) & (most >= wanted), "<": least < wanted, "<=": least <= wanted,
        ">": most > wanted, ">=": most >= wanted,
    }[sign]
    return known.isNull() | F.coalesce(room, F.lit(False))


def _bloom_misses(blooms: DataFrame, schema: T.StructType, condition: Condition) -> DataFrame:
    """Files with a filter of the column that say they do not hold the value."""
    name, _, value = condition
    part, *bits = _hashes(F.lit(value).cast(schema[name].dataType))
    own = blooms.filter(F.col("column") == name)
    byte = [F.conv(F.hex(F.substring("bits", (b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int") for b in bits]
    is_set = [F.call_function("shiftright", x, (b % 8).cast("int")).bitwiseAND(F.lit(1)) == 1 for x, b in zip(byte, bits)]
    holds = (F.col("part") == F.pmod(part, F.col("parts"))) & reduce(Column.__and__, is_set)
    key = ["file", "size", "changed"]
    return own.groupBy(*key).agg(F.bool_or(holds).alias("holds")).filter(~F.col("holds")).select(*key)


def files_for(
    spark: SparkSession, dataset: str, schema: T.StructType, conditions: Sequence[Condition], bounds: str,
    blooms: str | None = None,
) -> DataFrame:
    """(path) of the files of a dataset that may hold a row that meets all conditions.

    A file that is new, or whose size or time has changed since it was summed up, is always among them.
    """
    at, key = F.col("_metadata"), ["file", "size", "changed"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(
        dataset
    ).select(at["file_path"].alias("file"), at["file_size"].alias("size"), at["file_modification_time"].alias("changed"))
    room = reduce(Column.__and__, [_may_hold(schema, c) for c in conditions], F.lit(True))
    files = files.join(spark.read.parquet(bounds).filter(~room).select(*key), key, "left_anti")
    for condition in conditions if blooms else ():
        if condition[1] == "=" and condition[2] is not None:
            files = files.join(_bloom_misses(spark.read.parquet(blooms), schema, condition), key, "left_anti")
    return files.select(plain_path(F.col("file")).alias("path"))


def read_where(
    spark: SparkSession, dataset: str, schema: T.StructType, conditions: Sequence[Condition], bounds: str,
    blooms: str | None = None,
) -> DataFrame:
    """Rows of a dataset that meet all conditions, read from the files that may hold one.

    No row is null in a column that has a condition, and a condition with a null is met by none. The
    driver has the names of the files that are read, as it has for any scan.
    """
    paths = [r.path for r in files_for(spark, dataset, schema, conditions, bounds, blooms).collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", dataset).parquet(*paths)
    for name, sign, value in conditions:
        column, wanted = F.col(f"`{name}`"), F.lit(value).cast(schema[name].dataType)
        rows = rows.filter({
            "=": column == wanted, "<": column < wanted, "<=": column <= wanted, ">": column > wanted, ">=": column >= wanted,
        }[sign])
    return rows
