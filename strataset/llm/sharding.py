"""Sharding by a two-pass external shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from strataset.llm.streams import text_bytes, total
from strataset.session import hold


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniformly random order of n things, the same for the same seed."""
    order = list(range(n))
    picks = np.random.default_rng(seed).integers(0, np.arange(n, 0, -1)).tolist() if n else []
    for i, pick in zip(range(n - 1, 0, -1), picks):  # pick is one of 0 to i
        order[i], order[pick] = order[pick], order[i]
    return np.array(order, np.int64)


def _shuffled(schema: T.StructType, seed: int) -> Callable[[pa.Table], pa.Table]:
    def shuffle(bucket: pa.Table) -> pa.Table:
        # Arrival order depends on the run; the rows' hashes give an order that does not.
        bucket = bucket.sort_by([("hash", "ascending"), ("size", "ascending")])
        number = bucket.column("bucket")[0].as_py()
        bucket = bucket.take(pa.array(fisher_yates(bucket.num_rows, [seed, number])))
        return bucket.append_column("at", pa.array(np.arange(bucket.num_rows, dtype=np.int64))).select(schema.names)

    return shuffle


def shuffled(
    docs: DataFrame, text_col: str = "text", seed: int = 11, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """(row, position): all rows of `docs`, as structs, in random order; position is gapless from 0.

    Pass 1 scatters rows into buckets by a seeded hash of the whole row; there are as many buckets
    as make them about `bucket_bytes` of text each, so a bucket fits a task's memory at any size of
    the input, and copies under different ids spread. Pass 2 draws a Fisher-Yates order inside each
    bucket. The buckets are written to the shared folder; positions come from the buckets' counts
    (one row per bucket). The order depends on the rows and `seed` alone. Rows that are equal in
    every column share a bucket; null and empty texts have a size of one byte; no rows give no rows.
    """
    size = text_bytes(F.col(text_col)) + 1
    buckets = max(1, -(-total(docs.select(text_col), size) // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns])
    scattered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.alias("size"), hashed.alias("hash")
    ).withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(buckets)).cast("int"))
    schema = scattered.select("row", "bucket").schema.add("at", "long")
    rows = hold(scattered.groupBy("bucket").applyInArrow(_shuffled(schema, seed), schema), "shuffled-buckets")
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = hold(
        rows.groupBy("bucket").count().withColumn("start", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count"),
        "bucket-starts",
    )
    return rows.join(starts, "bucket").select("row", (F.col("start") + F.col("at")).alias("position"))


def shards(docs: DataFrame, count: int = 16, **options) -> DataFrame:
    """`shuffled` rows with shard (0 to count - 1) and slot (gapless from 0), under the law `rows`:
    the shards' counts are at most one apart. A shard is a run of the random order, so writing
    shards moves no bucket but the first and last of each. Columns of these names are replaced."""
    ordered = shuffled(docs, **options)
    rows = max(1, ordered.count())
    shard = F.expr(f"(position * {count} + {count - 1}) div {rows}")
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    return ordered.withColumn("shard", shard).select(
        *[F.col("row").getField(c).alias(c) for c in kept], F.col("shard").cast("int"),
        (F.col("position") - F.expr(f"(shard * {rows}) div {count}")).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder per shard, each in the order of its slots."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
