"""Whole jobs, from files to a stored dataset, composed of the operators.

What a job holds in between is deleted when it ends.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataset.operators import ir, project, report, semantic, terms
from strataset.schemas import SEMANTIC_PHASES
from strataset.session import hold, scratch
from strataset.sinks import writers
from strataset.sources import files, manifests


def semantic_dataset(
    spark: SparkSession, root: str, out: str, phases: str = ",".join(SEMANTIC_PHASES[:3]),
    run: semantic.RunInfo = semantic.RunInfo(), max_mb: float = writers.MAX_MB,
) -> None:
    """Source tree to semantic records by phase, numbered phase, file, line.

    `max_mb` is the size of the files; a large corpus needs a larger one, to have fewer of them.
    """
    names = semantic.parse_phases(phases)
    with scratch(spark):
        records = semantic.ordered_records(semantic.TreeFiles(spark, root), names, run)
        writers.write_phase_parquet(records, out, max_mb)


def project_dataset(
    spark: SparkSession, root: str, out: str, *, pkgs: DataFrame | None = None,
    decl: DataFrame | None = None, edges: DataFrame | None = None,
    registry: DataFrame | None = None, repos: DataFrame | None = None,
    commits: DataFrame | None = None, as_of: str | None = None,
    versions: Mapping[str, str] | None = None,
) -> None:
    """The projects in a directory to project records by phase.

    A project is a folder with a manifest, the directory itself among them; a source file belongs
    to the nearest one above it, or to the directory if there is none. Manifests, build scripts and
    sources are read from the tree. The dependency phase needs pkgs, decl and edges, the ecosystem
    phase registry and repos, the history phase commits and as_of; a phase without its tables is
    left out. Dependencies are stored as JSON lines, a row each, below `out`-dependencies.
    """
    with scratch(spark):
        named = files.scan_text_files(spark, root, "{Cargo.toml,build.rs}").withColumnRenamed(
            "file_path", "path"
        )
        found = hold(
            manifests.scan_manifests(named.filter(F.col("path").endswith("/Cargo.toml"))),
            "manifests",
        )
        scripts = project.build_scripts(named)
        sources = hold(
            files.scan_source_files(spark, root, skip=()).select(
                "file_path", semantic.line_count(F.col("content")).alias("lines")
            ),
            "source-lines",
        )
        owned = project.with_project(sources, found, files.plain_root(root).rstrip("/"))
        parts = [
            project.package_metadata(found, scripts),
            project.workspace_metadata(found, scripts),
            project.source_records(project.source_metrics(owned, "project"), "project", scripts),
            project.build_config(found, scripts),
        ]
        if pkgs is not None and decl is not None and edges is not None:
            parts.append(project.dependency_records(project.dependency_counts(pkgs, decl, edges)))
            detail = project.dependency_detail(decl, edges, pkgs)
            writers.export_jsonl(project.dependency_json(detail), f"{out.rstrip('/')}-dependencies")
        if registry is not None and repos is not None:
            # A workspace without a package has no name to look up, but gets its record.
            known = found.filter("problem IS NULL").select(
                "project_path", F.coalesce("name", F.lit("")).alias("name"), "version", "repository"
            )
            parts.append(project.ecosystem_records(
                project.ecosystem_enrich(known, registry, repos)
            ))
        if commits is not None and as_of is not None:
            parts.append(project.history_records(project.version_history(commits, as_of)))
        records = project.unify_project_records(*parts, versions=versions)
        writers.write_project_parquet(project.project_order(records), out)


def ir_dataset(
    spark: SparkSession, compiled: DataFrame, out: str, levels: str = "O0,O1,O2,O3",
    phases: Sequence[str] = ("ir_generation",),
) -> None:
    """Compiled constructs, see ir_records, to IR records by phase and level."""
    sources = compiled.select("source_file").distinct()
    writers.write_ir_parquet(ir.ir_records(ir.ir_grid(sources, levels, phases), compiled), out)


def term_dataset(spark: SparkSession, base: str, out: str, name: str) -> DataFrame:
    """Term documents to Parquet splits below data/ and a description below dataset_info/; returns
    how many documents there were, and how many for each reason could not be used."""
    with scratch(spark):
        scanned = hold(files.scan_term_json(spark, base), "term-documents")
        records = terms.term_records(scanned)
        shaped = terms.assign_split(terms.list_null_to_empty(records, "semantic_names"))
        writers.write_split_parquet(shaped, f"{out}/data")
        writers.write_report_json(terms.dataset_description(records, name), f"{out}/dataset_info")
        problems = scanned.groupBy("problem").agg(F.count(F.lit(1)).alias("documents"))
        return spark.createDataFrame(problems.collect(), problems.schema)


def validation_report(spark: SparkSession, path: str, out: str) -> DataFrame:
    """The report on a directory of Parquet files, also stored as JSON with its splits and files.
    Footers are read once."""
    with scratch(spark):
        info = report.parquet_file_info(spark, path)
        totals = report.dataset_report(spark, path, info)
        writers.write_report_json(totals, f"{out}/report")
        writers.export_jsonl(report.split_report(spark, path, info), f"{out}/splits")
        writers.export_jsonl(info, f"{out}/files")
        writers.export_jsonl(report.first_file_sample(spark, path), f"{out}/sample")
        return spark.createDataFrame(totals.collect(), totals.schema)
