"""Runs of equal keys in a sorted stream of Arrow batches, and narrow helpers shared by operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def whole_runs(
    batches: Iterator[pa.RecordBatch], key: Sequence[str], least_rows: int
) -> Iterator[pa.Table]:
    """Tables of `least_rows` rows or more that end where the key changes.

    `batches` is sorted by the integer columns `key`. Only rows since the last change of key
    beyond `least_rows` are held, so memory follows `least_rows` and the largest single run.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(table.num_rows, bool)
        for name in key:
            v = table.column(name).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(change)
        if len(at):
            yield table.slice(0, int(at[-1]))
            rest = table.slice(int(at[-1]))
            held, rows = rest.to_batches(), rest.num_rows
        else:
            held = table.to_batches()
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def text_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def total(df: DataFrame, amount: Column) -> int:
    """The sum of `amount` over all rows, as a number on the driver."""
    return int(df.agg(F.coalesce(F.sum(amount), F.lit(0))).first()[0])


def map_arrow(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """mapInArrow under a schema string."""
    return df.mapInArrow(make, schema)
