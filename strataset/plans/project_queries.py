"""Queries for the project and IR operators."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from strataset.functions.asof import as_of
from strataset.functions.text import repo_key
from strataset.operators import graph, ir as ir_ops, project as ops, versions as version_ops
from strataset.plans import views
from strataset.plans.registry import query, table
from strataset.schemas import IR_LEVELS
from strataset.session import hold
from strataset.sources.manifests import scan_manifests as parse

LEVELS = ",".join(IR_LEVELS)


def manifests(spark, sf_dir):
    return parse(views.manifest_files(spark, sf_dir))


def scripts(spark, sf_dir):
    return ops.build_scripts(views.script_files(spark, sf_dir))


@query("scan_manifests", f"""
    WITH {views.MANIFESTS}
    SELECT project_path, project_dir, has_package, has_workspace, name, version, description,
           authors, license, members, features, targets,
           NOT has_package AND NOT has_workspace AS unusable
    FROM manifests""")
def scan_manifests(spark, sf_dir):
    return manifests(spark, sf_dir).select(
        "project_path", "project_dir", "has_package", "has_workspace", "name", "version",
        "description", "authors", "license", "members", "features", "targets",
        F.col("problem").isNotNull().alias("unusable"),
    )


@query("package_metadata", f"""
    WITH {views.MANIFESTS}
    SELECT concat(name, ':', coalesce(version, '0.0.0'), ':project_metadata') AS id, project_path,
           name AS project_name, coalesce(version, '0.0.0') AS project_version, description,
           authors, license, has_build_script
    FROM manifests WHERE has_package AND NOT has_workspace""")
def package_metadata(spark, sf_dir):
    return ops.package_metadata(manifests(spark, sf_dir), scripts(spark, sf_dir)).select(
        "id", "project_path", "project_name", "project_version", "description", "authors",
        "license", "has_build_script",
    )


@query("workspace_metadata", f"""
    WITH {views.MANIFESTS}
    SELECT concat(project_dir, ':workspace:project_metadata') AS id, project_path,
           project_dir AS project_name, 'workspace' AS project_version,
           'Cargo workspace with 2 members' AS description, members AS keywords,
           members AS dependency_data, has_build_script
    FROM manifests WHERE has_workspace""")
def workspace_metadata(spark, sf_dir):
    return ops.workspace_metadata(manifests(spark, sf_dir), scripts(spark, sf_dir)).drop("phase")


@query("build_config", f"""
    WITH {views.MANIFESTS}
    SELECT concat(project_dir, ':build_analysis') AS id, project_path, project_dir AS project_name,
           features, targets, has_build_script, script_lines AS build_script_complexity
    FROM manifests""")
def build_config(spark, sf_dir):
    return ops.build_config(manifests(spark, sf_dir), scripts(spark, sf_dir)).drop(
        "phase", "project_version"
    )


def counts(spark, sf_dir):
    return ops.dependency_counts(
        views.pkgs(spark, sf_dir), views.decl_deps(spark, sf_dir),
        views.resolve_edges(spark, sf_dir),
    )


def detail(spark, sf_dir):
    return ops.dependency_detail(
        views.decl_deps(spark, sf_dir), views.resolve_edges(spark, sf_dir)
    )


_COUNTS = """declared AS (
  SELECT pkg_id, count(*) AS n, count(*) FILTER (WHERE kind = 'dev') AS dev,
         count(*) FILTER (WHERE kind = 'build') AS build FROM decl_deps GROUP BY pkg_id),
resolved AS (SELECT pkg_id, count(*) AS n FROM resolve_edges GROUP BY pkg_id),
counts AS (
  SELECT p.pkg_id, p.name, p.version, coalesce(d.n, 0) AS direct_dependencies,
         coalesce(d.dev, 0) AS dev_dependencies, coalesce(d.build, 0) AS build_dependencies,
         coalesce(r.n, 0) AS total_dependencies
  FROM pkgs p LEFT JOIN declared d USING (pkg_id) LEFT JOIN resolved r USING (pkg_id))"""
_DETAIL = """ranked AS (
  SELECT pkg_id, dep_pkg_name AS name, dep_version,
         row_number() OVER (PARTITION BY pkg_id, dep_pkg_name
                            ORDER BY edge_ord, dep_pkg_id, dep_version) AS rank
  FROM resolve_edges),
detail AS (
  SELECT d.pkg_id, d.dep_ord, d.dep_name AS name, d.version_req, r.dep_version AS resolved_version,
         d.optional, d.default_features, coalesce(d.source, 'path') AS source,
         d.kind = 'dev' AS is_dev, d.kind = 'build' AS is_build
  FROM decl_deps d LEFT JOIN ranked r
    ON d.pkg_id = r.pkg_id AND d.dep_name = r.name AND r.rank = 1)"""


@query("dependency_counts", f"""
    WITH {views.PKGS}, {views.DECL_DEPS}, {views.RESOLVE_EDGES}, {_COUNTS}
    SELECT * FROM counts""")
def dependency_counts(spark, sf_dir):
    return counts(spark, sf_dir).drop("repository")


@query("dependency_detail", f"""
    WITH {views.DECL_DEPS}, {views.RESOLVE_EDGES}, {_DETAIL}
    SELECT *, CAST(CASE WHEN dep_ord % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS feature_count
    FROM detail""")
def dependency_detail(spark, sf_dir):
    return detail(spark, sf_dir).withColumn("feature_count", F.size("features")).drop("features")


@query("dependency_json", f"""
    WITH {views.DECL_DEPS}, {views.RESOLVE_EDGES}, {_DETAIL}
    SELECT *, CAST(CASE WHEN dep_ord % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS feature_count
    FROM detail""")
def dependency_json(spark, sf_dir):
    """Every field of every dependency, read back from its JSON."""
    found = detail(spark, sf_dir)
    entry = T.StructType([f for f in found.schema.fields if f.name not in ("pkg_id", "dep_ord")])
    rows = ops.dependency_json(found).select(
        "pkg_id", "dep_ord", F.from_json("dependency_data", entry).alias("d")
    )
    return rows.select("pkg_id", "dep_ord", "d.*").withColumn(
        "feature_count", F.coalesce(F.size("features"), F.lit(0))
    ).drop("features")


def metrics(spark, sf_dir):
    project = F.substring_index("file_path", "/", 2)
    return ops.source_metrics(
        views.corpus_files(spark, sf_dir).withColumn("project", project), "project"
    )


_METRICS = """metrics AS (
  SELECT regexp_extract(f.file_path, '^[^/]*/[^/]*') AS project,
         CAST(sum(coalesce(l.n, 0)) AS BIGINT) AS lines_of_code, count(*) AS source_file_count,
         count(*) FILTER (WHERE contains(f.file_path, '/tests/')) AS test_file_count,
         count(*) FILTER (WHERE contains(f.file_path, '/examples/')) AS example_file_count,
         count(*) FILTER (WHERE contains(f.file_path, '/benches/')) AS benchmark_file_count
  FROM corpus_files f
  LEFT JOIN (SELECT file_path, count(*) AS n FROM corpus_lines GROUP BY 1) l USING (file_path)
  GROUP BY 1)"""


@query("source_metrics", f"""
    WITH {views.CORPUS_LINES}, {_METRICS} SELECT * FROM metrics""")
def source_metrics(spark, sf_dir):
    return metrics(spark, sf_dir)


_FOLDERS = """folders AS (
  SELECT DISTINCT regexp_extract(file_path, '^[^/]*') AS folder FROM corpus_files
  UNION SELECT DISTINCT regexp_extract(file_path, '^[^/]*/[^/]*') FROM corpus_files
        WHERE length(file_path) % 2 = 0)"""


@query("with_project", f"""
    WITH {views.CORPUS_LINES}, {_FOLDERS}, found AS (
      SELECT f.file_path, max_by(d.folder, length(d.folder)) AS project
      FROM corpus_files f JOIN folders d ON starts_with(f.file_path, concat(d.folder, '/'))
      GROUP BY f.file_path)
    SELECT f.file_path, coalesce(n.project, '.') AS project
    FROM corpus_files f LEFT JOIN found n USING (file_path)""")
def with_project(spark, sf_dir):
    """Each file of the corpus and the nearest of some folders above it."""
    paths = views.corpus_files(spark, sf_dir).select("file_path")
    folders = paths.select(F.substring_index("file_path", "/", 1).alias("project_path")).union(
        paths.filter(F.length("file_path") % 2 == 0).select(F.substring_index("file_path", "/", 2))
    )
    return ops.with_project(paths, folders, ".")


def enriched(spark, sf_dir):
    return ops.ecosystem_enrich(
        views.pkgs(spark, sf_dir), views.registry(spark, sf_dir), views.repos(spark, sf_dir)
    )


@query("ecosystem_enrich", f"""
    WITH {views.PKGS}, {views.REGISTRY}, {views.REPOS},
    keyed AS (
      SELECT *, string_split(rtrim(repository, '/'), '/') AS a,
             contains(repository, 'github.com') AS hosted FROM pkgs),
    named AS (
      SELECT pkg_id, name, version, CASE WHEN hosted THEN a[len(a) - 1] END AS owner,
             CASE WHEN hosted THEN regexp_replace(a[len(a)], '(\\.git)+$', '') END AS repo
      FROM keyed)
    SELECT n.pkg_id, n.name, n.version, n.owner, n.repo, g.downloads AS download_count,
           r.stars AS github_stars, r.forks AS github_forks, r.issues AS github_issues,
           CAST(epoch(CAST(r.updated_at AS TIMESTAMPTZ)) AS BIGINT) AS last_updated
    FROM named n LEFT JOIN registry g ON n.name = g.name
    LEFT JOIN repos r ON n.owner = r.owner AND n.repo = r.repo""")
def ecosystem_enrich(spark, sf_dir):
    return enriched(spark, sf_dir).drop("repository")


@query("repo_key", """
    SELECT page_id, url,
           CASE WHEN contains(url, 'example.org') THEN a[len(a) - 1] END AS owner,
           CASE WHEN contains(url, 'example.org') THEN a[len(a)] END AS repo
    FROM (SELECT page_id, url, string_split(rtrim(url, '/'), '/') AS a FROM pages)""")
def page_repo_key(spark, sf_dir):
    key = repo_key(F.col("url"), host="example.org")
    return table(spark, sf_dir, "pages").select("page_id", "url", key.alias("k")).select(
        "page_id", "url", F.col("k.owner").alias("owner"), F.col("k.repo").alias("repo")
    )


def history(spark, sf_dir):
    return ops.version_history(views.commits(spark, sf_dir), views.AS_OF)


_HISTORY = f"""history AS (
  SELECT project, count(*) AS commit_count,
         count(DISTINCT coalesce(author, 'unknown')) AS contributor_count, min(ts) AS first_commit,
         CAST(floor(epoch(TIMESTAMP '{views.AS_OF}') - floor(epoch(min(ts)))) AS BIGINT) // 86400
           AS project_age_days
  FROM commits GROUP BY project)"""


@query("version_history", f"""
    WITH {views.COMMITS}, {_HISTORY}
    SELECT project, commit_count, contributor_count, project_age_days,
           strftime(first_commit, '%Y-%m-%d %H:%M:%S') AS first_commit
    FROM history""")
def version_history(spark, sf_dir):
    return history(spark, sf_dir).withColumn(
        "first_commit", F.date_format("first_commit", "yyyy-MM-dd HH:mm:ss")
    )


def project_records(spark, sf_dir):
    # Three phases read the manifests; held, they are parsed once.
    found, build = hold(manifests(spark, sf_dir), "manifests"), scripts(spark, sf_dir)
    return ops.unify_project_records(
        ops.package_metadata(found, build),
        ops.workspace_metadata(found, build),
        ops.dependency_records(counts(spark, sf_dir)),
        ops.source_records(metrics(spark, sf_dir), "project"),
        ops.build_config(found, build),
        ops.ecosystem_records(enriched(spark, sf_dir)),
        ops.history_records(history(spark, sf_dir)),
        timestamp=0,
    )


PROJECT_RECORDS = f"""{views.MANIFESTS}, {views.PKGS}, {views.DECL_DEPS}, {views.RESOLVE_EDGES},
{_COUNTS}, {views.CORPUS_LINES}, {_METRICS}, {views.COMMITS}, {_HISTORY}, {views.REGISTRY},
project_records AS (
  SELECT 'project_metadata' AS phase, count(*) AS records, 0 AS lines_of_code,
         0 AS total_dependencies, 0 AS commit_count, 0 AS download_count,
         count(*) FILTER (WHERE has_build_script) AS with_build_script
  FROM manifests WHERE has_package OR has_workspace
  UNION ALL SELECT 'dependency_analysis', count(*), 0, sum(total_dependencies), 0, 0, 0 FROM counts
  UNION ALL SELECT 'source_code_analysis', count(*), sum(lines_of_code), 0, 0, 0, 0 FROM metrics
  UNION ALL SELECT 'build_analysis', count(*), 0, 0, 0, 0,
                   count(*) FILTER (WHERE has_build_script) FROM manifests
  UNION ALL SELECT 'ecosystem_analysis', count(*), 0, 0, 0, sum(coalesce(r.downloads, 0)), 0
            FROM pkgs LEFT JOIN registry r USING (name)
  UNION ALL SELECT 'version_history', count(*), 0, 0, sum(commit_count), 0, 0 FROM history)"""
_RECORD_SUMS = """SELECT phase, records, CAST(lines_of_code AS BIGINT) AS lines_of_code,
       CAST(total_dependencies AS BIGINT) AS total_dependencies,
       CAST(commit_count AS BIGINT) AS commit_count,
       CAST(download_count AS BIGINT) AS download_count, with_build_script
FROM project_records"""


def record_sums(records):
    return records.groupBy("phase").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("lines_of_code").alias("lines_of_code"),
        F.sum("total_dependencies").alias("total_dependencies"),
        F.sum(F.coalesce("commit_count", F.lit(0))).alias("commit_count"),
        F.sum(F.coalesce("download_count", F.lit(0))).alias("download_count"),
        F.count_if("has_build_script").alias("with_build_script"),
    )


@query("unify_project_records", f"WITH {PROJECT_RECORDS} {_RECORD_SUMS}")
def unify_project_records(spark, sf_dir):
    return record_sums(project_records(spark, sf_dir))


@query("ir_grid", """
    WITH grid AS (
      SELECT s.source_file, l.level, l.i
      FROM (SELECT DISTINCT concat(lower(p_type), '/', p_name, '.rs') AS source_file FROM part) s,
           (VALUES ('O0', 0), ('O1', 1), ('O2', 2), ('O3', 3)) AS l(level, i))
    SELECT concat('ir_gen:', source_file, ':', level) AS id, source_file,
           'ir_generation' AS phase, level AS optimization_level,
           CAST(i + 1 AS BIGINT) AS processing_order
    FROM grid""")
def ir_grid(spark, sf_dir):
    sources = table(spark, sf_dir, "part").select(
        F.concat(F.lower("p_type"), F.lit("/"), "p_name", F.lit(".rs")).alias("source_file")
    ).distinct()
    return ir_ops.ir_grid(sources, LEVELS)


@query("ir_projection", f"""
    WITH {views.IR}
    SELECT id, source_file, construct_name, phase, processing_order, rust_source, llvm_ir,
           optimization_level, target_architecture, extractor_version FROM ir""")
def ir_projection(spark, sf_dir):
    return ir_ops.ir_projection(views.ir(spark, sf_dir))


@query("optimization_compare", f"""
    WITH {views.IR}, pairs AS (
      SELECT a.construct_name,
             CASE WHEN a.ir_instruction_count <> 0
                  THEN (a.ir_instruction_count - b.ir_instruction_count)
                       / CAST(a.ir_instruction_count AS DOUBLE) END AS reduction
      FROM ir a JOIN ir b ON a.construct_name = b.construct_name
      WHERE a.optimization_level = 'O0' AND b.optimization_level = 'O2')
    SELECT construct_name, round(reduction, 9) AS instruction_reduction
    FROM pairs ORDER BY reduction DESC NULLS LAST, construct_name LIMIT 10""")
def optimization_compare(spark, sf_dir):
    return ir_ops.optimization_compare(views.ir(spark, sf_dir)).withColumn(
        "instruction_reduction", F.round("instruction_reduction", 9)
    )


@query("level_summary", f"""
    WITH {views.IR}
    SELECT optimization_level, count(*) AS records,
           round(avg(ir_instruction_count), 6) AS avg_instructions,
           round(avg(complexity_score), 6) AS avg_complexity
    FROM ir GROUP BY 1""")
def level_summary(spark, sf_dir):
    summary = ir_ops.level_summary(views.ir(spark, sf_dir))
    return summary.withColumns({
        "avg_instructions": F.round("avg_instructions", 6),
        "avg_complexity": F.round("avg_complexity", 6),
    })


_NONE = "[-1, 0, 0, 0]"
_CARET = """CASE WHEN a > 0 THEN [a + 1, 0, 0, 1000] WHEN b > 0 THEN [0, b + 1, 0, 1000]
  ELSE [0, 0, c + 1, 1000] END"""


@query("resolve_versions", f"""
    WITH {views.VERSIONS}, {views.REQUIREMENTS},
    spans AS (
      SELECT DISTINCT dep_name, version_req, form, a, b, c,
        CASE WHEN form IN (0, 5) THEN [a, b, c, 1000] WHEN form IN (1, 4) THEN [a, b, 0, 1000]
             WHEN form = 2 THEN [a, 0, 0, 1000] WHEN form IN (3, 8) THEN [0, 0, 0, 0]
             WHEN form = 6 THEN [a, b, c, 2] WHEN form = 7 THEN [a, b + 1, 0, 1000] ELSE {_NONE} END AS low,
        CASE WHEN form IN (0, 6) THEN {_CARET} WHEN form IN (1, 8) THEN [a, b + 1, 0, 1000]
             WHEN form IN (2, 4) THEN [a + 1, 0, 0, 1000] WHEN form IN (3, 7) THEN [99, 0, 0, 0]
             WHEN form = 5 THEN [a, b, c, 1001] ELSE {_NONE} END AS high
      FROM requirements),
    best AS (
      SELECT s.dep_name, s.version_req, v.version, row_number() OVER (
        PARTITION BY s.dep_name, s.version_req ORDER BY [major, minor, patch, pre] DESC, v.version DESC) AS rank
      FROM spans s JOIN versions v ON v.name = s.dep_name AND [major, minor, patch, pre] >= low
        AND [major, minor, patch, pre] < high
        AND (pre = 1000 OR (form = 6 AND major = a AND minor = b AND patch = c)))
    SELECT r.pkg_id, r.dep_ord, r.dep_name, r.version_req, b.version AS resolved_version
    FROM requirements r LEFT JOIN best b
      ON r.dep_name = b.dep_name AND r.version_req = b.version_req AND b.rank = 1""")
def resolve_versions(spark, sf_dir):
    decl = views.requirements(spark, sf_dir).select("pkg_id", "dep_ord", "dep_name", "version_req")
    return version_ops.resolve_versions(decl, views.versions(spark, sf_dir))


@query("dependency_graph", f"""
    WITH RECURSIVE {views.GRAPH}, steps AS (SELECT DISTINCT package, dependency FROM graph),
    reach USING KEY (package, dependency) AS (
      SELECT package, dependency, 1 AS depth FROM steps
      UNION (SELECT r.package, s.dependency, min(r.depth + 1) AS depth
             FROM reach r JOIN steps s ON r.dependency = s.package
             LEFT JOIN recurring.reach k ON k.package = r.package AND k.dependency = s.dependency
             WHERE k.depth IS NULL GROUP BY r.package, s.dependency)),
    needs AS (
      SELECT package, count(*) FILTER (package <> dependency AND depth = 1) AS direct,
             count(*) FILTER (package <> dependency) AS transitive,
             max(depth) FILTER (package <> dependency) AS depth, bool_or(package = dependency) AS in_cycle
      FROM reach GROUP BY package),
    needed AS (SELECT dependency AS package, count(*) AS n FROM reach WHERE package <> dependency GROUP BY dependency)
    SELECT CAST(p_partkey AS VARCHAR) AS package, coalesce(direct, 0) AS direct, coalesce(transitive, 0) AS transitive,
           coalesce(n, 0) AS dependents, coalesce(depth, 0) AS depth, coalesce(in_cycle, false) AS in_cycle
    FROM part LEFT JOIN needs ON needs.package = CAST(p_partkey AS VARCHAR)
    LEFT JOIN needed ON needed.package = CAST(p_partkey AS VARCHAR)""")
def dependency_graph(spark, sf_dir):
    packages = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("package"))
    return graph.transitive_counts(packages, views.graph_edges(spark, sf_dir))


@query("snapshot_at_commit", f"""
    WITH {views.COMMITS}, snapshots AS (
      SELECT project, taken_at, max({{'stars': stars, 'issues': issues}}) AS s
      FROM (SELECT {', '.join(views._SNAPSHOT_FIELDS)} FROM events WHERE event_type = 'purchase')
      GROUP BY project, taken_at)
    SELECT c.project, c.sha, c.ts, s.taken_at, s.s.stars AS stars, s.s.issues AS issues
    FROM commits c ASOF LEFT JOIN snapshots s ON c.project = s.project AND c.ts >= s.taken_at""")
def snapshot_at_commit(spark, sf_dir):
    """The snapshot of its project that was the latest one at each commit."""
    commits = views.commits(spark, sf_dir).select("project", "sha", "ts")
    found = as_of(commits, views.snapshots(spark, sf_dir), "project", "ts", "taken_at")
    return found.select("project", "sha", "ts", "fact.taken_at", "fact.stars", "fact.issues")
