"""Values as texts that can be compared outside the JVM: equal ones, and ones in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WHOLE = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def digest(column: Column, dtype: T.DataType) -> Column:
    """A SHA-256 that is the same for equal values only; nulls are equal, and so are 0.0 and -0.0.

    Lists and structs are hashed over the hashes of what they hold, maps over their sorted entries.
    """
    if isinstance(dtype, T.ArrayType):
        inner = F.array_join(F.transform(column, lambda x: digest(x, dtype.elementType)), ",")
    elif isinstance(dtype, T.StructType):
        inner = F.concat_ws(",", *[digest(column.getField(f.name), f.dataType) for f in dtype.fields])
    elif isinstance(dtype, T.MapType):
        entry = T.StructType().add("key", dtype.keyType).add("value", dtype.valueType)
        entries = F.transform(F.map_entries(column), lambda e: digest(e, entry))
        inner = F.array_join(F.sort_array(entries), ",")
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        inner = (column + F.lit(0.0)).cast("string")
    else:
        inner = column
    return F.when(column.isNull(), F.lit("null")).otherwise(F.sha2(inner.cast("binary") if isinstance(
        dtype, (T.StringType, T.BinaryType)) else inner.cast("string").cast("binary"), 256))


def digest_of(df: DataFrame, keys: Sequence[str]) -> Column:
    """One digest of several columns of a frame."""
    parts = [digest(F.col(f"`{k}`"), df.schema[k].dataType) for k in keys]
    return F.sha2(F.concat_ws(",", *parts).cast("binary"), 256)


def _whole(column: Column) -> Column:
    return F.lpad(F.hex(column.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def order_text(column: Column, dtype: T.DataType) -> Column:
    """A text that sorts by its bytes as the value does, nulls first; none is the start of another.

    Whole numbers, dates, times, strings and binary values have one.
    """
    if isinstance(dtype, _WHOLE):
        text = _whole(column)
    elif isinstance(dtype, T.DateType):
        text = _whole(F.unix_date(column))
    elif isinstance(dtype, T.TimestampType):
        text = _whole(F.unix_micros(column))
    elif isinstance(dtype, T.TimestampNTZType):
        text = F.concat(_whole(F.unix_date(column.cast("date"))), F.date_format(column, "HHmmssSSSSSS"))
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        text = F.concat(F.hex(column), F.lit("/"))  # less than any digit
    else:
        raise TypeError(f"no order for {dtype.simpleString()}")
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def order_of(df: DataFrame, order: Sequence[str]) -> Column:
    """One such text of several columns of a frame."""
    return F.concat(F.lit(""), *[order_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in order])
