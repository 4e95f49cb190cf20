"""Record layouts. Names, order, types and nullability are part of the on-disk format."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, F32 = T.StringType(), T.LongType(), T.BooleanType(), T.FloatType()


def _schema(spec: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in spec])


# Phase names, in processing order.
SEMANTIC_PHASES = (
    "parsing",
    "name_resolution",
    "type_inference",
    "hir_generation",
    "diagnostics",
    "completions",
    "hover",
    "goto_definition",
    "find_references",
)
PROJECT_PHASES = (
    "project_metadata",
    "dependency_analysis",
    "source_code_analysis",
    "build_analysis",
    "ecosystem_analysis",
    "version_history",
)
IR_PHASES = (
    "ir_generation",
    "optimization_passes",
    "code_generation",
    "performance_analysis",
    "type_system_mapping",
    "memory_analysis",
)
IR_LEVELS = ("O0", "O1", "O2", "O3")
TERM_SPLITS = ("train", "validation", "test")

# Columns of the semantic record.
SEMANTIC_RECORD = _schema([
    ("id", S, False),
    ("file_path", S, False),
    ("line", L, False),
    ("column", L, False),
    ("phase", S, False),
    ("processing_order", L, True),
    ("element_type", S, False),
    ("element_name", S, True),
    ("element_signature", S, True),
    ("syntax_data", S, True),
    ("symbol_data", S, True),
    ("type_data", S, True),
    ("diagnostic_data", S, True),
    ("processing_time_ms", L, False),
    ("timestamp", L, False),
    ("rust_version", S, False),
    ("analyzer_version", S, False),
    ("source_snippet", S, False),
    ("context_before", S, True),
    ("context_after", S, True),
])

# Columns of the project record.
PROJECT_RECORD = _schema([
    ("id", S, False),
    ("project_path", S, False),
    ("project_name", S, False),
    ("project_version", S, False),
    ("phase", S, False),
    ("processing_order", L, True),
    ("description", S, True),
    ("authors", S, True),
    ("license", S, True),
    ("repository", S, True),
    ("homepage", S, True),
    ("documentation", S, True),
    ("keywords", S, True),
    ("categories", S, True),
    ("lines_of_code", L, False),
    ("source_file_count", L, False),
    ("test_file_count", L, False),
    ("example_file_count", L, False),
    ("benchmark_file_count", L, False),
    ("complexity_score", F32, False),
    ("documentation_coverage", F32, False),
    ("direct_dependencies", L, False),
    ("total_dependencies", L, False),
    ("dev_dependencies", L, False),
    ("build_dependencies", L, False),
    ("dependency_data", S, True),
    ("features", S, True),
    ("targets", S, True),
    ("has_build_script", B, False),
    ("build_script_complexity", L, False),
    ("download_count", L, True),
    ("github_stars", L, True),
    ("github_forks", L, True),
    ("github_issues", L, True),
    ("last_updated", L, True),
    ("commit_count", L, True),
    ("contributor_count", L, True),
    ("project_age_days", L, True),
    ("release_frequency", F32, True),
    ("processing_time_ms", L, False),
    ("timestamp", L, False),
    ("extractor_version", S, False),
    ("cargo_version", S, False),
    ("rust_version", S, False),
])

# Columns of the persisted IR record.
IR_RECORD = _schema([
    ("id", S, False),
    ("source_file", S, False),
    ("construct_name", S, False),
    ("phase", S, False),
    ("processing_order", L, False),
    ("rust_source", S, False),
    ("llvm_ir", S, False),
    ("optimization_level", S, False),
    ("target_architecture", S, False),
    ("extractor_version", S, False),
])

# Fields of one term document, and columns of the exported term record.
RAW_TERM = _schema([
    ("term", S, False),
    ("count", L, False),
    ("category", S, False),
    ("significance", S, False),
    ("vibe", S, False),
    ("action_suggestion", S, False),
    ("emoji_representation", S, True),
    ("semantic_names", T.ArrayType(S), True),
    ("osi_layer", S, True),
    ("prime_factor", L, True),
    ("is_power_of_two", B, True),
    ("numerical_address", S, True),
    ("embedding_vectors", T.ArrayType(T.DoubleType()), True),
    ("versions", T.ArrayType(S), True),
    ("first_seen_timestamp", L, True),
    ("last_seen_timestamp", L, True),
])
TERM_RECORD = _schema([
    ("id", S, False),
    ("term", S, False),
    ("count", L, False),
    ("category", S, False),
    ("significance", S, False),
    ("vibe", S, False),
    ("action_suggestion", S, False),
    ("emoji_representation", S, True),
    ("semantic_names", T.ArrayType(S), True),
    ("osi_layer", S, True),
    ("prime_factor", L, True),
    ("is_power_of_two", B, True),
    ("numerical_address", S, True),
    ("first_seen_timestamp", L, True),
    ("last_seen_timestamp", L, True),
    ("character_group", S, False),
])

# The five capability flags, in report order.
CAPABILITIES = ("viewer", "preview", "search", "filter", "statistics")
