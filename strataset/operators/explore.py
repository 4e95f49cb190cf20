"""Loading and exploration: splits, filters, searches, histograms and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def list_splits(df: DataFrame) -> DataFrame:
    return df.select("split").distinct().orderBy("split")


def load_split(df: DataFrame, split: str) -> DataFrame:
    """Rows of one split; on a partitioned table only its files are read."""
    return df.filter(F.col("split") == split)


def split_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("examples"))


def filter_examples(df: DataFrame, split: str, condition: Column) -> DataFrame:
    return load_split(df, split).filter(condition)


def search_by_term(df: DataFrame, split: str, text: str) -> DataFrame:
    """Terms containing `text` whatever the case; `%` and `_` stand for themselves."""
    return filter_examples(df, split, F.lower("term").contains(F.lower(F.lit(text))))


def by_character_group(df: DataFrame, split: str, group: str) -> DataFrame:
    return filter_examples(df, split, F.col("character_group") == group)


def head_examples(df: DataFrame, k: int, order: str = "id") -> DataFrame:
    return df.orderBy(order).limit(k)


def element_distribution(records: DataFrame) -> DataFrame:
    return (
        records.groupBy("element_type")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "element_type")
    )


def file_complexity(records: DataFrame) -> DataFrame:
    """Records per file, most first."""
    return (
        records.groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "file_path")
    )


def longest_functions(records: DataFrame, k: int = 5) -> DataFrame:
    """The functions with the longest snippets, in characters."""
    return (
        records.filter(F.col("element_type") == "function")
        .select(
            "element_name", "file_path", "line", F.char_length("source_snippet").alias("complexity")
        )
        .orderBy(F.desc("complexity"), "file_path", "line")
        .limit(k)
    )


def type_patterns(records: DataFrame) -> DataFrame:
    """Histogram of the inferred types found in the JSON payload."""
    found = F.coalesce(F.get_json_object("type_data", "$.inferred_type"), F.lit("unknown"))
    return (
        records.groupBy(found.alias("inferred_type"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "inferred_type")
    )


def project_totals(projects: DataFrame) -> DataFrame:
    """Records, dependencies and lines of all projects."""
    return projects.agg(
        F.count(F.lit(1)).alias("projects"),
        F.sum("total_dependencies").alias("total_dependencies"),
        F.sum("lines_of_code").alias("lines_of_code"),
    )


def record_count(records: DataFrame, phase: str) -> DataFrame:
    return records.filter(F.col("phase") == phase).agg(F.count(F.lit(1)).alias("records"))


def dataset_summary(records: DataFrame, projects: DataFrame, ir: DataFrame) -> DataFrame:
    """Semantic, project and IR figures as (section, metric, value) rows."""

    def rows(df: DataFrame, section: Column, metrics: dict[str, Column]) -> DataFrame:
        entries = F.array(*[
            F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
            for name, value in metrics.items()
        ])
        return df.select(section.alias("section"), F.inline(entries))

    section = F.concat(F.lit("semantic_"), F.col("phase"))
    # Both semantic summaries start from the same counts, so the records are scanned once.
    per_file = records.groupBy("phase", "file_path", "element_type").agg(
        F.count(F.lit(1)).alias("records")
    )
    per_phase = per_file.groupBy("phase").agg(
        F.sum("records").alias("records"), F.countDistinct("file_path").alias("files")
    )
    per_element = per_file.groupBy("phase", "element_type").agg(F.sum("records").alias("records"))
    levels = ir.groupBy("optimization_level").agg(
        F.count(F.lit(1)).alias("records"),
        F.avg("ir_instruction_count").alias("instructions"),
        F.avg("complexity_score").alias("complexity"),
    )
    parts = [
        rows(per_phase, section, {"records": F.col("records"), "files": F.col("files")}),
        per_element.select(
            section.alias("section"),
            F.concat(F.lit("elements."), F.col("element_type")).alias("metric"),
            F.col("records").cast("double").alias("value"),
        ),
        rows(project_totals(projects), F.lit("project"), {
            "projects": F.col("projects"),
            "total_dependencies": F.col("total_dependencies"),
            "lines_of_code": F.col("lines_of_code"),
        }),
        rows(levels, F.concat(F.lit("ir_"), F.col("optimization_level")), {
            "records": F.col("records"),
            "avg_instructions": F.col("instructions"),
            "avg_complexity": F.col("complexity"),
        }),
    ]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary
