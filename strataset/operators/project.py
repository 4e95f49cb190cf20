"""Project analytics: manifests, dependencies, sources, ecosystem and history per project."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataset.functions.names import unused
from strataset.functions.numbering import dense_position
from strataset.functions.text import repo_key
from strataset.operators.semantic import line_count
from strataset.schemas import PROJECT_PHASES, PROJECT_RECORD


def build_scripts(files: DataFrame) -> DataFrame:
    """(path, content) of any files to the build scripts among them, with their line counts."""
    return files.filter(F.col("path").endswith("/build.rs")).select(
        F.regexp_replace("path", "/[^/]*$", "").alias("project_path"),
        line_count(F.col("content")).alias("script_lines"),
    )


def _record_id(*parts: str | Column) -> Column:
    return F.concat_ws(":", *parts)


# What a package table may say about its packages beyond their name and version.
_PACKAGE_FACTS = (
    "description", "authors", "license", "repository", "homepage", "documentation", "keywords",
    "categories", "features", "targets", "has_build_script",
)


def _path_of(df: DataFrame, otherwise: str) -> Column:
    """The project's path where the table has it, else its name."""
    return F.col("project_path" if "project_path" in df.columns else otherwise).alias(
        "project_path"
    )


def _with_build_script(df: DataFrame, scripts: DataFrame | None) -> DataFrame:
    if scripts is None:
        return df.withColumn("has_build_script", F.lit(False)).withColumn(
            "script_lines", F.lit(None).cast("long")
        )
    return df.join(scripts, "project_path", "left").withColumn(
        "has_build_script", F.col("script_lines").isNotNull()
    )


def package_metadata(manifests: DataFrame, scripts: DataFrame | None = None) -> DataFrame:
    """A record per package manifest; a manifest that also has a workspace is not one."""
    usable = manifests.filter("problem IS NULL AND has_package AND NOT has_workspace")
    version = F.coalesce("version", F.lit("0.0.0"))
    phase = F.lit("project_metadata")
    return _with_build_script(usable, scripts).select(
        _record_id("name", version, phase).alias("id"),
        "project_path",
        F.col("name").alias("project_name"),
        version.alias("project_version"),
        phase.alias("phase"),
        "description", "authors", "license", "repository", "homepage", "documentation",
        "keywords", "categories", "has_build_script",
    )


def workspace_metadata(manifests: DataFrame, scripts: DataFrame | None = None) -> DataFrame:
    """A record per workspace manifest; its members stand in keywords and dependency_data."""
    usable = manifests.filter("problem IS NULL AND has_workspace")
    phase = F.lit("project_metadata")
    members = F.coalesce("member_count", F.lit(0))
    return _with_build_script(usable, scripts).select(
        _record_id("project_dir", F.lit("workspace"), phase).alias("id"),
        "project_path",
        F.col("project_dir").alias("project_name"),
        F.lit("workspace").alias("project_version"),
        phase.alias("phase"),
        F.format_string("Cargo workspace with %d members", members).alias("description"),
        F.col("members").alias("keywords"),
        F.col("members").alias("dependency_data"),
        "has_build_script",
    )


def build_config(manifests: DataFrame, scripts: DataFrame | None = None) -> DataFrame:
    """Features, library or binary target and build script of each project."""
    usable = manifests.filter("problem IS NULL OR problem NOT LIKE 'not TOML%'")
    phase = F.lit("build_analysis")
    return _with_build_script(usable, scripts).select(
        _record_id("project_dir", phase).alias("id"),
        "project_path",
        F.col("project_dir").alias("project_name"),
        F.lit("unknown").alias("project_version"),
        phase.alias("phase"),
        "features", "targets", "has_build_script",
        F.coalesce("script_lines", F.lit(0).cast("long")).alias("build_script_complexity"),
    )


def dependency_counts(pkgs: DataFrame, decl: DataFrame, edges: DataFrame) -> DataFrame:
    """Packages with their declared (all, dev, build) and resolved dependency counts."""
    declared = decl.groupBy("pkg_id").agg(
        F.count(F.lit(1)).alias("direct_dependencies"),
        F.count_if(F.col("kind") == "dev").alias("dev_dependencies"),
        F.count_if(F.col("kind") == "build").alias("build_dependencies"),
    )
    resolved = edges.groupBy("pkg_id").agg(F.count(F.lit(1)).alias("total_dependencies"))
    counts = ["direct_dependencies", "dev_dependencies", "build_dependencies", "total_dependencies"]
    return (
        pkgs.join(declared, "pkg_id", "left").join(resolved, "pkg_id", "left").fillna(0, counts)
    )


def dependency_detail(decl: DataFrame, edges: DataFrame, pkgs: DataFrame | None = None) -> DataFrame:
    """One row per declared dependency, with the version it resolved to.

    The resolved version is that of the package's first resolved edge, by edge_ord, to a package
    of the declared name. Edges are reduced to that first one per name before the join, so the
    join adds no rows. Edges without dep_pkg_name and dep_version get them from `pkgs`.
    """
    if "dep_pkg_name" not in edges.columns:
        targets = pkgs.select(
            F.col("pkg_id").alias("dep_pkg_id"),
            F.col("name").alias("dep_pkg_name"),
            F.col("version").alias("dep_version"),
        )
        edges = edges.join(targets, "dep_pkg_id")
    first = F.min(F.struct("edge_ord", "dep_pkg_id", "dep_version"))
    winners = edges.groupBy("pkg_id", F.col("dep_pkg_name").alias("dep_name")).agg(
        first.getField("dep_version").alias("resolved_version")
    )
    return decl.join(winners, ["pkg_id", "dep_name"], "left").select(
        "pkg_id",
        "dep_ord",
        F.col("dep_name").alias("name"),
        "version_req",
        "resolved_version",
        "optional",
        "default_features",
        "features",
        F.coalesce("source", F.lit("path")).alias("source"),
        (F.col("kind") == "dev").alias("is_dev"),
        (F.col("kind") == "build").alias("is_build"),
    )


def dependency_json(detail: DataFrame) -> DataFrame:
    """Each dependency as a JSON object: (pkg_id, dep_ord, dependency_data).

    A row per dependency for every package, however many it has; stored beside the project records,
    which keep the counts.
    """
    payload = [c for c in detail.columns if c not in ("pkg_id", "dep_ord")]
    return detail.select("pkg_id", "dep_ord", F.to_json(F.struct(*payload)).alias("dependency_data"))


def dependency_records(counts: DataFrame) -> DataFrame:
    """Project records of the dependency phase, one per package, with what pkgs says about it."""
    phase = F.lit("dependency_analysis")
    return counts.select(
        _record_id("name", "version", phase).alias("id"),
        _path_of(counts, "name"),
        F.col("name").alias("project_name"),
        F.col("version").alias("project_version"),
        phase.alias("phase"),
        "direct_dependencies", "total_dependencies", "dev_dependencies", "build_dependencies",
        *[c for c in _PACKAGE_FACTS if c in counts.columns],
    )


def with_project(files: DataFrame, folders: DataFrame, otherwise: str) -> DataFrame:
    """`files` (file_path, unique, and any narrow columns) with the project each belongs to: the
    nearest folder above it that is in `folders` (project_path), else `otherwise`.

    Each path is matched through the folders above it, so the join is on equal folders.
    """
    parts = F.split("file_path", "/")
    depth = F.explode(F.sequence(F.lit(1), F.size(parts) - 1))
    above = (
        files.filter(F.size(parts) > 1).select("file_path", parts.alias("_parts"), depth.alias("_depth"))
        .select("file_path", "_depth", F.array_join(F.slice("_parts", F.lit(1), F.col("_depth")), "/").alias("project_path"))
    )
    nearest = (
        above.join(folders.select("project_path").distinct(), "project_path")
        .groupBy("file_path").agg(F.max_by("project_path", "_depth").alias("project"))
    )
    return files.join(nearest, "file_path", "left").withColumn(
        "project", F.coalesce("project", F.lit(otherwise))
    )


def source_metrics(files: DataFrame, key: str) -> DataFrame:
    """Lines and files per project, with test, example and bench files told by their path.

    Files carry their content, or the number of their `lines`.
    """
    path = F.col("file_path")
    lines = F.col("lines") if "lines" in files.columns else line_count(F.col("content"))
    kind = (
        F.when(path.contains("/tests/"), "test")
        .when(path.contains("/examples/"), "example")
        .when(path.contains("/benches/"), "bench")
    )
    return (
        files.select(key, lines.alias("_lines"), kind.alias("_kind"))
        .groupBy(key)
        .agg(
            F.sum("_lines").alias("lines_of_code"),
            F.count(F.lit(1)).alias("source_file_count"),
            F.count_if(F.col("_kind") == "test").alias("test_file_count"),
            F.count_if(F.col("_kind") == "example").alias("example_file_count"),
            F.count_if(F.col("_kind") == "bench").alias("benchmark_file_count"),
        )
    )


def source_records(
    metrics: DataFrame, key: str, scripts: DataFrame | None = None
) -> DataFrame:
    phase = F.lit("source_code_analysis")
    renamed = metrics.withColumnRenamed(key, "project_path")
    name = F.element_at(F.split("project_path", "/"), -1)
    return _with_build_script(renamed, scripts).select(
        _record_id(name, phase).alias("id"),
        "project_path",
        name.alias("project_name"),
        F.lit("unknown").alias("project_version"),
        phase.alias("phase"),
        "lines_of_code", "source_file_count", "test_file_count", "example_file_count",
        "benchmark_file_count", "has_build_script",
    )


def ecosystem_enrich(
    pkgs: DataFrame, registry: DataFrame, repos: DataFrame, host: str = "github.com"
) -> DataFrame:
    """Packages joined to a registry snapshot by name and to a repository snapshot by its key.

    registry: (name, downloads), unique by name. repos: (owner, repo, stars, forks, issues,
    updated_at as RFC 3339 text), unique by owner and repo. No side is forced to be broadcast:
    the snapshots may be large, and a popular repository may be shared by very many packages,
    which adaptive execution splits as a skewed join. Packages without a repository at the host
    have nothing to look up there and take no part in that join.
    """
    key, *_ = unused(pkgs.columns, "_key")
    kept = [c for c in pkgs.columns if c not in ("owner", "repo")]
    keyed = pkgs.withColumn(key, repo_key(F.col("repository"), host)).select(
        *kept, F.col(key).getField("owner").alias("owner"), F.col(key).getField("repo").alias("repo")
    )
    downloads = registry.select("name", F.col("downloads").alias("download_count"))
    facts = repos.select(
        "owner",
        "repo",
        F.col("stars").alias("github_stars"),
        F.col("forks").alias("github_forks"),
        F.col("issues").alias("github_issues"),
        F.unix_timestamp(F.try_to_timestamp("updated_at")).alias("last_updated"),
    )
    counted = keyed.join(downloads, "name", "left")
    known = F.col("owner").isNotNull() & F.col("repo").isNotNull()
    hosted = counted.filter(known).join(facts, ["owner", "repo"], "left")
    return hosted.unionByName(counted.filter(~known), allowMissingColumns=True)


def ecosystem_records(enriched: DataFrame) -> DataFrame:
    phase = F.lit("ecosystem_analysis")
    return enriched.select(
        _record_id("name", phase).alias("id"),
        _path_of(enriched, "name"),
        F.col("name").alias("project_name"),
        F.coalesce("version", F.lit("unknown")).alias("project_version"),
        phase.alias("phase"),
        "download_count", "github_stars", "github_forks", "github_issues", "last_updated",
    )


def version_history(commits: DataFrame, as_of: str) -> DataFrame:
    """Commits, distinct authors, first commit and age in whole days at `as_of` per project."""
    when = F.lit(as_of).cast(commits.schema["ts"].dataType)
    return (
        commits.groupBy("project")
        .agg(
            F.count(F.lit(1)).alias("commit_count"),
            F.countDistinct(F.coalesce("author", F.lit("unknown"))).alias("contributor_count"),
            F.min("ts").alias("first_commit"),
        )
        .withColumn(
            "project_age_days",
            F.extract(F.lit("DAY"), when - F.date_trunc("second", "first_commit")
                      .cast(commits.schema["ts"].dataType)).cast("long"),
        )
    )


def history_records(history: DataFrame) -> DataFrame:
    phase = F.lit("version_history")
    return history.select(
        _record_id("project", phase).alias("id"),
        _path_of(history, "project"),
        F.col("project").alias("project_name"),
        F.lit("unknown").alias("project_version"),
        phase.alias("phase"),
        "commit_count", "contributor_count", "project_age_days",
    )


# What a column that may not be null holds when its phase does not compute it.
_EMPTY = {T.StringType(): "unknown", T.BooleanType(): False, T.LongType(): 0, T.FloatType(): 0.0}


def unify_project_records(
    *frames: DataFrame, timestamp: int | None = None, versions: Mapping[str, str] | None = None
) -> DataFrame:
    """The records of several phases in the full project layout, missing values filled.

    `versions` gives the columns that name the versions of the tools, those without stay unknown.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    fixed = {
        "processing_time_ms": F.lit(1),
        "timestamp": F.unix_timestamp(F.current_timestamp())
        if timestamp is None else F.lit(timestamp),
        **{name: F.lit(version) for name, version in (versions or {}).items()},
    }
    unknown = set(fixed) - set(PROJECT_RECORD.names)
    if unknown:
        raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")

    def column(field: T.StructField) -> Column:
        value = fixed.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in union.columns else F.lit(None)
        value = value.cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.lit(_EMPTY[field.dataType]).cast(field.dataType))
        return value.alias(field.name)

    return union.select(*[column(f) for f in PROJECT_RECORD.fields])


def project_order(records: DataFrame) -> DataFrame:
    """Fill processing_order with the dense sequence phase, project, id."""
    rank = F.array_position(F.array(*[F.lit(p) for p in PROJECT_PHASES]), F.col("phase"))
    numbered = dense_position(
        records.drop("processing_order"),
        [rank, F.col("project_path"), F.col("id")],
        name="processing_order",
    )
    return numbered.select(*records.columns)
