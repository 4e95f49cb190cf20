import json

import pyarrow as pa
import pyarrow.parquet as pq

from strataset.plans import jobs
from strataset.sources.files import load_phase
from tests.test_storage import put


def test_semantic_dataset(spark, tmp_path):
    put(tmp_path / "src" / "a" / "b.rs", "fn f() {\n    let x = 1;\n}\n")
    put(tmp_path / "src" / "a-b.rs", "// fn g(\n\nstruct S {")
    out = str(tmp_path / "out")
    jobs.semantic_dataset(spark, str(tmp_path / "src"), out)
    rows = sorted(spark.read.parquet(out).collect(), key=lambda r: r.processing_order)
    assert [r.processing_order for r in rows] == list(range(1, 10))
    assert [(r.phase, r.file_path.rsplit("src/")[1], r.line) for r in rows] == [
        ("parsing", "a/b.rs", 1), ("parsing", "a/b.rs", 2), ("parsing", "a/b.rs", 3),
        ("parsing", "a-b.rs", 1), ("parsing", "a-b.rs", 3),
        ("name_resolution", "a/b.rs", 1), ("name_resolution", "a-b.rs", 1),
        ("name_resolution", "a-b.rs", 3), ("type_inference", "a/b.rs", 2),
    ]
    last = load_phase(spark, out, "parsing").filter("line = 3 AND file_path LIKE '%a-b.rs'").first()
    assert (last.context_before, last.context_after, last.element_name) == ("", None, "S")


def test_project_dataset(spark, tmp_path):
    root = tmp_path / "projects"
    put(root / "p1" / "Cargo.toml",
        '[package]\nname = "p1"\nversion = "1.0.0"\nrepository = "https://github.com/o/p1"')
    put(root / "p1" / "build.rs", "fn main() {}\n")
    put(root / "p1" / "src" / "lib.rs", "a\nb\n")
    put(root / "p1" / "tests" / "t.rs", "c")
    put(root / "p2" / "Cargo.toml", '[workspace]\nmembers = ["m"]')
    put(root / "p2" / "src" / "projects" / "x.rs", "d")
    registry = spark.createDataFrame([("p1", 9)], "name string, downloads long")
    repos = spark.createDataFrame(
        [("o", "p1", 1, 2, 3, "1970-01-01T00:00:05Z")],
        "owner string, repo string, stars long, forks long, issues long, updated_at string",
    )
    commits = spark.sql(
        "SELECT 'p1' AS project, 1L AS sha, 'u' AS author, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts"
    )
    out = str(tmp_path / "out")
    jobs.project_dataset(
        spark, str(root), out, registry=registry, repos=repos, commits=commits,
        as_of="2024-01-03 00:00:00",
    )
    rows = spark.read.parquet(out).collect()
    assert sorted(r.processing_order for r in rows) == list(range(1, len(rows) + 1))
    found = {(r.phase, r.project_name): r for r in rows}
    assert set(found) == {
        ("project_metadata", "p1"), ("project_metadata", "p2"), ("source_code_analysis", "p1"),
        ("source_code_analysis", "p2"), ("build_analysis", "p1"), ("build_analysis", "p2"),
        ("ecosystem_analysis", "p1"), ("ecosystem_analysis", ""), ("version_history", "p1"),
    }
    p1 = found["source_code_analysis", "p1"]
    assert (p1.lines_of_code, p1.source_file_count, p1.test_file_count) == (4, 3, 1)
    assert p1.project_path == str(root / "p1") and p1.has_build_script
    assert found["ecosystem_analysis", ""].project_version == "unknown"
    assert found["ecosystem_analysis", "p1"].project_path == str(root / "p1")
    assert found["source_code_analysis", "p2"].source_file_count == 1
    assert found["build_analysis", "p1"].build_script_complexity == 1
    assert found["ecosystem_analysis", "p1"].github_stars == 1
    assert found["version_history", "p1"].project_age_days == 2


def test_a_directory_with_a_manifest_is_one_project(spark, tmp_path):
    root = tmp_path / "crate"
    put(root / "Cargo.toml", '[package]\nname = "crate"\nversion = "1.0.0"')
    for name in ("src/lib.rs", "tests/t.rs", "examples/e.rs"):
        put(root / name, "a\nb\n")
    put(root / "build.rs", "fn main() {}\n")
    jobs.project_dataset(spark, str(root), str(tmp_path / "out"), versions={"cargo_version": "1.80"})
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    (source,) = [r for r in rows if r.phase == "source_code_analysis"]
    assert (source.project_path, source.project_name, source.lines_of_code) == (str(root), "crate", 7)
    assert (source.source_file_count, source.test_file_count, source.example_file_count) == (4, 1, 1)
    assert {r.cargo_version for r in rows} == {"1.80"}


def test_lines_of_a_workspace_go_to_its_members(spark, tmp_path):
    root = tmp_path / "ws"
    put(root / "Cargo.toml", '[workspace]\nmembers = ["m1", "m2"]')
    put(root / "tool.rs", "x\n")
    for member, text in (("m1", "a\n"), ("m2", "a\nb\n")):
        put(root / member / "Cargo.toml", f'[package]\nname = "{member}"')
        put(root / member / "src" / "lib.rs", text)
    jobs.project_dataset(spark, str(root), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).filter("phase = 'source_code_analysis'").collect()
    assert {r.project_path: r.lines_of_code for r in rows} == {
        str(root): 1, str(root / "m1"): 1, str(root / "m2"): 2,
    }


def test_ir_dataset(spark, tmp_path):
    compiled = spark.createDataFrame(
        [("a.rs", lv, f"f{k}", "fn", f"define {lv}", "x86_64", "1") for lv in ("O0", "O2") for k in range(3)],
        "source_file string, optimization_level string, construct_name string, rust_source string, llvm_ir string, "
        "target_architecture string, extractor_version string",
    )
    jobs.ir_dataset(spark, compiled, str(tmp_path / "ir"))
    rows = load_phase(spark, str(tmp_path / "ir"), "ir_generation", "O2").collect()
    assert len(rows) == 3 and {r.processing_order for r in rows} == {3}
    assert {r.id for r in rows} == {"ir_gen:a.rs:O2"}


def test_term_dataset(spark, tmp_path):
    full = {
        "count": 3, "category": "c", "significance": "s", "vibe": "v", "action_suggestion": "a",
    }
    for group, name in (("a", "t1"), ("a", "t2"), ("7", "t3")):
        put(tmp_path / "in" / "terms" / group / f"{name}.json", json.dumps({**full, "term": name}))
    out = tmp_path / "out"
    put(tmp_path / "in" / "terms" / "7" / "bad.json", "{")
    counts = jobs.term_dataset(spark, str(tmp_path / "in"), str(out), "demo").collect()
    assert {r.problem: r.documents for r in counts} == {None: 3, "not a term document": 1}
    rows = {r.id: (r.split, r.semantic_names) for r in spark.read.parquet(f"{out}/data").collect()}
    assert rows == {"t1": ("train", []), "t2": ("train", []), "t3": ("validation", [])}
    (text,) = [f.read_text() for f in (out / "dataset_info").glob("part-*") if f.stat().st_size]
    info = json.loads(text)
    assert info["dataset_size"] == 600 and info["splits"]["train"]["num_examples"] == 2
    assert info["splits"]["test"]["num_bytes"] == 0


def test_validation_report(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    pq.write_table(pa.table({"id": [1], "text": ["x"]}), data / "train-0.parquet")
    totals = jobs.validation_report(spark, str(data), str(tmp_path / "out")).first()
    assert (totals.dataset_name, totals.total_rows, totals.statistics) == ("data", 1, True)
    (text,) = [f.read_text() for f in (tmp_path / "out" / "report").glob("part-*") if f.stat().st_size]
    assert json.loads(text)["schema_consistency"] is True
    assert spark.read.json(str(tmp_path / "out" / "splits")).first().split_name == "train"
