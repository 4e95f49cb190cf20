"""The latest fact before each row, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataset.functions.numbering import _ROW_BITS
from strataset.session import hold


def fill_forward(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], fact: str, label: str = "forward"
) -> DataFrame:
    """Rows with `fact` replaced by the last one that is not null up to and with each row, by `order`
    within `group` (nulls are a group); null where there is none yet.

    One sort by ranges over all rows, so a group of very many rows is cut into ranges that each fill
    themselves; the last fact of a range is then carried to the later ranges of its group. Rows of
    equal order come in any order, facts ahead of questions if `order` says so. For narrow rows: they
    are written once, since ranges are sampled anew whenever a plan is run again.
    """
    names = {f"_g{i}": F.col(f"`{g}`") for i, g in enumerate(group)}
    held = hold(
        df.repartitionByRange(*names.values(), *order).sortWithinPartitions(*names.values(), *order)
        .withColumn("_stamp", F.monotonically_increasing_id()),
        label,
    ).withColumn("_part", F.shiftright("_stamp", _ROW_BITS)).withColumns(names)
    inside = Window.partitionBy("_part", *names).orderBy("_stamp").rowsBetween(Window.unboundedPreceding, 0)
    own = held.withColumn("_own", F.last(F.col(f"`{fact}`"), ignorenulls=True).over(inside))
    # A row per range and group, of which only groups that go on in a later range are kept.
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy(*names, "_part").agg(
        F.max_by(F.col(f"`{fact}`"), F.when(F.col(f"`{fact}`").isNotNull(), F.col("_stamp"))).alias("_end")
    )
    carried = hold(
        ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).filter("_carry IS NOT NULL")
        .select(F.col("_part").alias("_to"), *[F.col(n).alias(f"{n}_to") for n in names], "_carry"),
        f"{label}-carried",
    )
    same = F.col("_part") == F.col("_to")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}_to"))
    return own.join(carried, same, "left").select(
        *[F.col(f"`{c}`") for c in df.columns if c != fact], F.coalesce("_own", "_carry").alias(fact)
    )


def as_of(
    rows: DataFrame, facts: DataFrame, key: str, at: str, valid_from: str, label: str = "as-of"
) -> DataFrame:
    """`rows` with the struct `fact`: the columns of the fact of the same `key` that is the latest one
    valid at `at`, null if there is none. Null keys agree with each other; rows without a time find
    nothing, facts without one are not found. Of facts of one time the greatest, column by column, counts.

    One sort over rows and facts together, so a key of very many rows is no single task.
    """
    payload = F.struct(F.col(valid_from), *[F.col(c) for c in facts.columns if c not in (key, valid_from)])
    both = (
        facts.filter(F.col(valid_from).isNotNull())
        .select(F.col(key).alias("key"), F.col(valid_from).alias("time"), payload.alias("fact"))
        .groupBy("key", "time").agg(F.max("fact").alias("fact"))
        .withColumn("row", F.lit(None).cast(rows.schema))
        .unionByName(rows.select(
            F.col(key).alias("key"), F.col(at).alias("time"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        ).withColumn("fact", F.lit(None).cast(facts.select(payload.alias("f")).schema["f"].dataType)))
    )
    order = [F.col("time").asc_nulls_first(), F.col("row").isNotNull()]
    filled = fill_forward(both, ["key"], order, "fact", label).filter("row IS NOT NULL")
    return filled.select("row.*", F.when(F.col("time").isNotNull(), F.col("fact")).alias("fact"))
