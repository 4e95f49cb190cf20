"""Queries for the loading and exploration operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataset.operators import explore, project
from strataset.plans import project_queries as proj, semantic_queries as sem, views
from strataset.plans.registry import query


@query("element_distribution", f"""
    WITH {views.CORPUS_LINES}
    SELECT {sem._KIND} AS element_type, count(*) AS records
    FROM corpus_lines WHERE {sem._NOT_BLANK} GROUP BY 1 ORDER BY 2 DESC, 1""")
def element_distribution(spark, sf_dir):
    return explore.element_distribution(sem.records(spark, sf_dir, "parsing"))


@query("file_complexity", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, count(*) AS records FROM corpus_lines WHERE {sem._NOT_BLANK} GROUP BY 1""")
def file_complexity(spark, sf_dir):
    return explore.file_complexity(sem.records(spark, sf_dir, "parsing"))


@query("longest_functions", f"""
    WITH {views.CORPUS_LINES}
    SELECT {sem._ELEMENT_NAME} AS element_name, file_path, line_no AS line,
           CAST(length(line) AS INTEGER) AS complexity
    FROM corpus_lines WHERE {sem._KIND} = 'function'
    ORDER BY length(line) DESC, file_path, line_no LIMIT 5""")
def longest_functions(spark, sf_dir):
    return explore.longest_functions(sem.records(spark, sf_dir, "parsing"))


@query("type_patterns", f"""
    WITH {views.CORPUS_LINES}
    SELECT {sem._TYPE} AS inferred_type, count(*) AS records
    FROM corpus_lines WHERE {sem._IN_TYPES} GROUP BY 1""")
def type_patterns(spark, sf_dir):
    return explore.type_patterns(sem.records(spark, sf_dir, "type_inference"))


@query("record_count", f"""
    WITH {views.CORPUS_LINES}
    SELECT count(*) AS records FROM corpus_lines WHERE {sem._IN_NAMES}""")
def record_count(spark, sf_dir):
    return explore.record_count(sem.records(spark, sf_dir), "name_resolution")


def _projects(spark, sf_dir):
    return project.unify_project_records(
        project.dependency_records(proj.counts(spark, sf_dir)),
        project.source_records(proj.metrics(spark, sf_dir), "project"),
        timestamp=0,
    )


_PROJECTS = f"""{views.PKGS}, {views.DECL_DEPS}, {views.RESOLVE_EDGES}, {proj._COUNTS},
{views.CORPUS_LINES}, {proj._METRICS},
totals AS (
  SELECT (SELECT count(*) FROM counts) + (SELECT count(*) FROM metrics) AS projects,
         (SELECT CAST(sum(total_dependencies) AS BIGINT) FROM counts) AS total_dependencies,
         (SELECT CAST(sum(lines_of_code) AS BIGINT) FROM metrics) AS lines_of_code)"""


@query("project_totals", f"WITH {_PROJECTS} SELECT * FROM totals")
def project_totals(spark, sf_dir):
    return explore.project_totals(_projects(spark, sf_dir))


@query("dataset_summary", f"""
    WITH {_PROJECTS}, {sem._PHASED}, {views.IR},
    elements AS (
      SELECT phase, CASE WHEN phase = 'type_inference' THEN 'variable_or_return'
                         ELSE {sem._KIND} END AS element_type FROM phased)
    SELECT concat('semantic_', phase) AS section, 'records' AS metric,
           CAST(count(*) AS DOUBLE) AS value FROM phased GROUP BY phase
    UNION ALL SELECT concat('semantic_', phase), 'files', count(DISTINCT file_path)
              FROM phased GROUP BY phase
    UNION ALL SELECT concat('semantic_', phase), concat('elements.', element_type), count(*)
              FROM elements GROUP BY phase, element_type
    UNION ALL SELECT 'project', 'projects', projects FROM totals
    UNION ALL SELECT 'project', 'total_dependencies', total_dependencies FROM totals
    UNION ALL SELECT 'project', 'lines_of_code', lines_of_code FROM totals
    UNION ALL SELECT concat('ir_', optimization_level), 'records', count(*) FROM ir GROUP BY 1
    UNION ALL SELECT concat('ir_', optimization_level), 'avg_instructions',
                     round(avg(ir_instruction_count), 6) FROM ir GROUP BY 1
    UNION ALL SELECT concat('ir_', optimization_level), 'avg_complexity',
                     round(avg(complexity_score), 6) FROM ir GROUP BY 1""")
def dataset_summary(spark, sf_dir):
    summary = explore.dataset_summary(
        sem.records(spark, sf_dir), _projects(spark, sf_dir), views.ir(spark, sf_dir)
    )
    return summary.withColumn("value", F.round("value", 6))
