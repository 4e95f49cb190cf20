"""Compiler IR records: the source by level grid and comparisons across levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataset.schemas import IR_RECORD


def _indexed(values: Sequence[str]) -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(values)
    ])


def ir_grid(sources: DataFrame, levels: str, phases: Sequence[str] = ("ir_generation",)) -> DataFrame:
    """Every source at every level and phase, ordered by level, then phase."""
    names = levels.split(",")
    grid = sources.select("source_file", F.explode(_indexed(names)).alias("_l")).select(
        "source_file", "_l", F.explode(_indexed(phases)).alias("_p")
    )
    return grid.select(
        F.concat_ws(":", F.lit("ir_gen"), "source_file", "_l.v").alias("id"),
        "source_file",
        F.col("_p.v").alias("phase"),
        F.col("_l.v").alias("optimization_level"),
        (F.col("_l.i") * len(phases) + F.col("_p.i") + 1).cast("long").alias("processing_order"),
    )


def ir_records(grid: DataFrame, compiled: DataFrame) -> DataFrame:
    """The grid's rows with what the compiler made of them; places nothing was compiled for are left
    out. compiled: (source_file, optimization_level, construct_name, rust_source, llvm_ir,
    target_architecture, extractor_version), a row per construct."""
    return ir_projection(grid.join(compiled, ["source_file", "optimization_level"]))


def ir_projection(ir: DataFrame) -> DataFrame:
    """The ten persisted columns."""
    return ir.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in IR_RECORD.fields])


def optimization_compare(ir: DataFrame, lo: str = "O0", hi: str = "O2", k: int = 10) -> DataFrame:
    """The k largest relative instruction reductions between two levels of the same construct.

    The reduction grows with the count at `lo` and falls with the one at `hi`, so of a construct
    recorded many times only the k largest and the k smallest counts can take part in the result;
    the join never forms all pairs. No instructions at `lo` give null, which sorts last.
    """
    instructions = F.col("ir_instruction_count")

    def extremes(level: str, order: Column, name: str) -> DataFrame:
        first = Window.partitionBy("construct_name").orderBy(order)
        return (
            ir.filter(F.col("optimization_level") == level)
            .select("construct_name", instructions)
            .withColumn("_rank", F.row_number().over(first))
            .filter(F.col("_rank") <= k)
            .select("construct_name", instructions.alias(name))
        )

    pairs = extremes(lo, instructions.desc_nulls_last(), "_lo").join(
        extremes(hi, instructions.asc_nulls_last(), "_hi"), "construct_name"
    )
    reduction = F.when(F.col("_lo") != 0, (F.col("_lo") - F.col("_hi")) / F.col("_lo"))
    return (
        pairs.select("construct_name", reduction.alias("instruction_reduction"))
        .orderBy(F.desc_nulls_last("instruction_reduction"), "construct_name")
        .limit(k)
    )


def level_summary(ir: DataFrame) -> DataFrame:
    return ir.groupBy("optimization_level").agg(
        F.count(F.lit(1)).alias("records"),
        F.avg("ir_instruction_count").alias("avg_instructions"),
        F.avg("complexity_score").alias("avg_complexity"),
    )
