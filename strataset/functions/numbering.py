"""Dense numbering of rows in a total order, without a window over one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataset.session import hold

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low bits


def dense_position(
    df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Add the 1-based position of each row in `order`, restarting for each `within` group.

    `order` must be unique inside a group. Rows are sorted into range partitions, so one huge
    group or key prefix spreads over many tasks. The sorted rows are written to the shared folder
    once, because range bounds are sampled anew whenever a plan is run again; then only the row
    counts per partition (and group) are added up.
    """
    groups = [F.col(g) for g in within]
    stamped = (
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_stamp", F.monotonically_increasing_id())
    )
    held = (
        hold(stamped, "positions")
        .withColumn("_part", F.shiftright("_stamp", _ROW_BITS))
        .withColumn("_row", F.col("_stamp").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per partition and group: the window below sees at most as many rows per group as
    # the sort had partitions. Held, so that its true size decides how the join below is done.
    starts = hold(
        held.groupBy("_part", *within)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(
            F.col("_part").alias("_start_part"),
            *[F.col(g).alias(f"_start_{g}") for g in within],
            (F.col("_before") - F.col("_first") + 1).alias("_shift"),
        ),
        "position-starts",
    )
    same = F.col("_part") == F.col("_start_part")
    for g in within:
        same = same & F.col(g).eqNullSafe(F.col(f"_start_{g}"))
    return held.join(starts, same).select(
        *df.columns, (F.col("_row") + F.col("_shift")).alias(name)
    )


def running_totals(
    df: DataFrame, order: Sequence[Column], amounts: Sequence[str]
) -> tuple[DataFrame, dict[str, int]]:
    """Add `<amount>_before`, the sum of each amount over all earlier rows in `order`, and give the
    totals. `order` must be unique.

    For narrow rows: they are sorted into range partitions and written; sums inside a partition and
    over the partitions before it (one row per partition) add up.
    """
    held = hold(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_stamp", F.monotonically_increasing_id()),
        "running",
    ).withColumn("_part", F.shiftright("_stamp", _ROW_BITS))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("_stamp").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = hold(
        held.groupBy("_part").agg(*[F.sum(a).alias(a) for a in amounts]).select(
            "_part", *[F.coalesce(F.sum(a).over(ahead), zero).alias(f"_{a}_start") for a in amounts]
        ),
        "running-starts",
    )
    sums = held.agg(*[F.coalesce(F.sum(a), zero).alias(a) for a in amounts]).first()
    placed = held.join(starts, "_part").select(
        *df.columns,
        *[
            (F.coalesce(F.sum(a).over(inside), zero) + F.col(f"_{a}_start")).alias(f"{a}_before")
            for a in amounts
        ],
    )
    return placed, sums.asDict()
