import json

import pytest
from pyspark.sql import functions as F

from strataset.operators import explore, ir, project
from strataset.schemas import PROJECT_RECORD
from strataset.sources.manifests import scan_manifests

MANIFESTS = [
    ("r/a/Cargo.toml", '[package]\nname = "a"\nauthors = ["x", "é"]\n[features]\nz = []\nb = ["z"]'),
    ("r/w/Cargo.toml", '[package]\nname = "w"\n[workspace]\nmembers = ["m", "n", "o"]'),
    ("r/b/Cargo.toml", '[package]\nname = "b"\nversion.workspace = true\n[[bin]]\nname = "x"'),
    ("r/l/Cargo.toml", '[package]\nname = "l"\nversion = "1.2.3"\n[lib]\npath = "l.rs"'),
    ("r/n/Cargo.toml", '[dependencies]\nq = "1"'),
    ("r/bad/Cargo.toml", "not toml ="),
]


def manifests(spark):
    return scan_manifests(spark.createDataFrame(MANIFESTS, "path string, content string"))


def scripts(spark):
    files = [("r/a/build.rs", "fn main() {\n}\n"), ("r/a/src/build.rs.txt", "x")]
    return project.build_scripts(spark.createDataFrame(files, "path string, content string"))


def test_packages(spark):
    found = {r.project_name: r for r in project.package_metadata(manifests(spark), scripts(spark)).collect()}
    assert set(found) == {"a", "b", "l"}
    assert found["a"].project_version == found["b"].project_version == "0.0.0"
    assert found["a"].authors == '["x","é"]' and found["a"].has_build_script
    assert found["l"].id == "l:1.2.3:project_metadata" and not found["l"].has_build_script


def test_workspace_wins_over_package(spark):
    (row,) = project.workspace_metadata(manifests(spark)).collect()
    assert (row.project_name, row.project_version) == ("w", "workspace")
    assert row.description == "Cargo workspace with 3 members"
    assert row.keywords == row.dependency_data == '["m","n","o"]'


def test_build_config(spark):
    found = {r.project_name: r for r in project.build_config(manifests(spark), scripts(spark)).collect()}
    assert "bad" not in found and "n" in found
    assert found["a"].features == '{"b":["z"],"z":[]}'
    assert found["a"].build_script_complexity == 2
    assert found["b"].targets is None
    assert found["l"].targets == '{"path":"l.rs"}'


def test_unusable_manifests_say_why(spark):
    problems = {r.project_dir: r.problem for r in manifests(spark).collect() if r.problem}
    assert problems["n"] == "no package or workspace section"
    assert problems["bad"].startswith("not TOML")


def dependencies(spark):
    pkgs = spark.createDataFrame(
        [(1, "root", "0.1"), (2, "serde", "1.0"), (3, "serde", "2.0"), (4, "lone", "0.2")],
        "pkg_id long, name string, version string",
    )
    decl = spark.createDataFrame(
        [(1, 1, "serde", "normal", "^1", False, True, [], None),
         (1, 2, "missing", "dev", "*", True, False, ["f"], "registry"),
         (1, 3, "serde", "build", "^2", False, True, [], "registry")],
        "pkg_id long, dep_ord int, dep_name string, kind string, version_req string, "
        "optional boolean, default_features boolean, features array<string>, source string",
    )
    edges = spark.createDataFrame(
        [(1, 2, 2), (1, 1, 3)], "pkg_id long, edge_ord int, dep_pkg_id long"
    )
    return pkgs, decl, edges


def test_dependencies(spark):
    pkgs, decl, edges = dependencies(spark)
    counts = {r.pkg_id: r for r in project.dependency_counts(pkgs, decl, edges).collect()}
    assert (counts[1].direct_dependencies, counts[1].dev_dependencies,
            counts[1].build_dependencies, counts[1].total_dependencies) == (3, 1, 1, 2)
    assert counts[4].direct_dependencies == counts[4].total_dependencies == 0
    detail = project.dependency_detail(decl, edges, pkgs)
    found = {r.dep_ord: r for r in detail.collect()}
    assert [found[i].resolved_version for i in (1, 2, 3)] == ["2.0", None, "2.0"]
    assert [found[i].source for i in (1, 2, 3)] == ["path", "registry", "registry"]
    assert found[2].is_dev and found[3].is_build


def test_dependency_rows_keep_every_entry(spark):
    pkgs, decl, edges = dependencies(spark)
    rows = project.dependency_json(project.dependency_detail(decl, edges, pkgs)).orderBy("dep_ord").collect()
    assert [json.loads(r.dependency_data)["name"] for r in rows] == ["serde", "missing", "serde"]


def test_a_package_is_one_record_however_many_dependencies(spark):
    pkgs, decl, edges = dependencies(spark)
    many = spark.range(5000).select(*[
        {"pkg_id": F.lit(4).cast(decl.schema["pkg_id"].dataType), "dep_ord": F.col("id").cast(decl.schema["dep_ord"].dataType),
         "dep_name": F.concat(F.lit("d"), "id"), "kind": F.lit("normal")}.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
        for f in decl.schema.fields
    ])
    counts = project.dependency_counts(pkgs, decl.unionByName(many), edges)
    records = project.unify_project_records(project.dependency_records(counts)).collect()
    assert len(records) == 4
    assert {r.project_name: r.direct_dependencies for r in records}["lone"] == 5000
    totals = explore.project_totals(spark.createDataFrame(records, PROJECT_RECORD)).first()
    assert (totals.projects, totals.total_dependencies) == (4, 2)


def test_tool_versions_are_written(spark):
    pkgs, decl, edges = dependencies(spark)
    counts = project.dependency_counts(pkgs, decl, edges)
    versions = {"extractor_version": "2", "cargo_version": "1.80", "rust_version": "1.81"}
    (row,) = project.unify_project_records(project.dependency_records(counts), versions=versions).limit(1).collect()
    assert (row.extractor_version, row.cargo_version, row.rust_version) == ("2", "1.80", "1.81")
    with pytest.raises(ValueError):
        project.unify_project_records(project.dependency_records(counts), versions={"other": "1"})


def test_nearest_project(spark):
    files = spark.createDataFrame([("r/a.rs",), ("r/m/src/x.rs",), ("r/m/n/y.rs",), ("q/z.rs",), ("top.rs",)], "file_path string")
    folders = spark.createDataFrame([("r",), ("r/m",), ("r/m/n",), ("r/m",)], "project_path string")
    got = {r.file_path: r.project for r in project.with_project(files, folders, "root").collect()}
    assert got == {"r/a.rs": "r", "r/m/src/x.rs": "r/m", "r/m/n/y.rs": "r/m/n", "q/z.rs": "root", "top.rs": "root"}


def test_packages_without_a_repository_are_not_joined(spark):
    pkgs = spark.createDataFrame([("a", None), ("b", "https://github.com/o/r"), ("c", "https://elsewhere/x/y")], "name string, repository string")
    registry = spark.createDataFrame([("a", 1), ("b", 2)], "name string, downloads long")
    repos = spark.createDataFrame([("o", "r", 5, 6, 7, "1970-01-01T00:00:05Z")], "owner string, repo string, stars long, forks long, issues long, updated_at string")
    got = {r.name: (r.download_count, r.github_stars) for r in project.ecosystem_enrich(pkgs, registry, repos).collect()}
    assert got == {"a": (1, None), "b": (2, 5), "c": (None, None)}


def test_unified_records_are_complete(spark):
    pkgs, decl, edges = dependencies(spark)
    records = project.unify_project_records(
        project.package_metadata(manifests(spark)),
        project.dependency_records(project.dependency_counts(pkgs, decl, edges)),
        timestamp=5,
    )
    assert records.schema.names == PROJECT_RECORD.names
    for row in project.project_order(records).collect():
        for field in PROJECT_RECORD.fields:
            assert field.nullable or row[field.name] is not None, field.name
    lone = [r for r in records.collect() if r.id == "lone:0.2:dependency_analysis"]
    assert lone[0].dependency_data is None and lone[0].has_build_script is False


def test_source_metrics_take_the_first_kind_of_path(spark):
    files = spark.createDataFrame(
        [("p/src/a.rs", "a\nb\n", "p"), ("p/tests/examples/t.rs", "x", "p"),
         ("p/examples/benches/e.rs", "", "p"), ("p/benches/b.rs", "1", "p")],
        "file_path string, content string, project string",
    )
    (row,) = project.source_metrics(files, "project").collect()
    assert tuple(row) == ("p", 4, 4, 1, 1, 1)


def test_version_history(spark):
    commits = spark.sql(
        "SELECT * FROM VALUES ('p', 1, NULL, TIMESTAMP_NTZ'2024-01-01 12:00:00'),"
        " ('p', 2, 'unknown', TIMESTAMP_NTZ'2024-01-02 00:00:00'),"
        " ('p', 3, 'u', TIMESTAMP_NTZ'2024-01-01 11:59:59') AS t(project, sha, author, ts)"
    )
    (row,) = project.version_history(commits, "2024-01-11 12:00:00").collect()
    assert (row.commit_count, row.contributor_count, row.project_age_days) == (3, 2, 10)
    (row,) = project.version_history(commits, "2024-01-11 11:59:58").collect()
    assert row.project_age_days == 9


def test_ecosystem_keeps_packages_without_snapshot(spark):
    pkgs = spark.createDataFrame(
        [("a", "1", "https://github.com/o/r.git"), ("b", "1", None), ("c", "1", "https://x.org/o/r")],
        "name string, version string, repository string",
    )
    registry = spark.createDataFrame([("a", 7)], "name string, downloads long")
    repos = spark.createDataFrame(
        [("o", "r", 1, 2, 3, "1970-01-02T00:00:00Z")],
        "owner string, repo string, stars long, forks long, issues long, updated_at string",
    )
    found = {r.name: r for r in project.ecosystem_enrich(pkgs, registry, repos).collect()}
    assert (found["a"].download_count, found["a"].github_stars, found["a"].last_updated) == (7, 1, 86400)
    assert found["b"].download_count is found["b"].github_stars is found["c"].github_stars is None


IR = "construct_name string, optimization_level string, ir_instruction_count int, complexity_score int"


def test_reduction_without_instructions_is_null(spark):
    records = spark.createDataFrame(
        [("a", "O0", 0, 1), ("a", "O2", 5, 1), ("b", "O0", 10, 1), ("b", "O2", 4, 1)], IR
    )
    found = [tuple(r) for r in ir.optimization_compare(records).collect()]
    assert found == [("b", 0.6), ("a", None)]


def test_reduction_equals_all_pairs(spark):
    import random

    random.seed(1)
    data = [
        (random.choice("ab"), random.choice(["O0", "O2"]), random.randint(0, 30), 1)
        for _ in range(200)
    ]
    pairs = [
        (a[0], (a[2] - b[2]) / a[2])
        for a in data for b in data
        if a[0] == b[0] and a[1] == "O0" and b[1] == "O2" and a[2]
    ]
    pairs.sort(key=lambda p: (-p[1], p[0]))
    found = ir.optimization_compare(spark.createDataFrame(data, IR), k=10).collect()
    assert [tuple(r) for r in found] == pairs[:10]


def test_grid_order(spark):
    grid = ir.ir_grid(
        spark.createDataFrame([("s",)], "source_file string"), "O0,O2", ("p", "q")
    ).orderBy("processing_order").collect()
    assert [(r.optimization_level, r.phase) for r in grid] == [
        ("O0", "p"), ("O0", "q"), ("O2", "p"), ("O2", "q")
    ]
    assert grid[0].id == "ir_gen:s:O0"
