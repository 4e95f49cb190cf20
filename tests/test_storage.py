import decimal
import gzip
import json
import os
import pathlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strataset import session
from strataset.operators import maintenance, report, semantic, terms as term_ops, validate
from strataset.schemas import IR_RECORD, RAW_TERM, SEMANTIC_RECORD
from strataset.sinks import writers
from strataset.sources import files as readers
from strataset.streaming.batches import stream_phase_batches


def put(path: pathlib.Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_source_files(spark, tmp_path):
    root = tmp_path / "my src"
    put(root / "a.rs", "x\ny")
    put(root / "sub" / "é+b.rs", "z")
    put(root / "sub" / "target.rs", "kept")
    put(root / "target" / "c.rs", "skipped")
    put(root / "sub" / "target" / "deep" / "d.rs", "skipped")
    put(root / ".git" / "e.rs", "skipped")
    put(root / "readme.md", "skipped")
    found = {r.file_path: r.content for r in readers.scan_source_files(spark, str(root)).collect()}
    assert found == {
        f"{root}/a.rs": "x\ny", f"{root}/sub/é+b.rs": "z", f"{root}/sub/target.rs": "kept"
    }


def test_skipping_starts_below_the_root(spark, tmp_path):
    root = tmp_path / "target" / "src"
    put(root / "a.rs", "x")
    assert readers.scan_source_files(spark, str(root)).count() == 1


def test_term_documents(spark, tmp_path):
    full = {
        "term": "x", "count": 3, "category": "c", "significance": "s", "vibe": "v",
        "action_suggestion": "a",
    }
    put(tmp_path / "terms" / "é" / "t1.json", json.dumps(full, indent=2))
    put(tmp_path / "terms" / "+" / "t2.json", json.dumps({**full, "semantic_names": ["n"]}))
    put(tmp_path / "terms" / "a" / "bad.json", "{oops")
    put(tmp_path / "terms" / "a" / "wide.json", json.dumps({**full, "prime_factor": 2**64 - 1, "count": 2**63}))
    put(tmp_path / "terms" / "a" / "part.json", json.dumps({"term": "x"}))
    found = {r.id: r for r in readers.scan_term_json(spark, str(tmp_path)).collect()}
    assert {i: r.problem for i, r in found.items()} == {
        "t1": None, "t2": None, "bad": "not a term document", "wide": None,
        "part": "without count, category, significance, vibe, action_suggestion",
    }
    assert found["wide"].prime_factor == -1 and found["wide"]["count"] == -(1 << 63)
    usable = term_ops.term_records(readers.scan_term_json(spark, str(tmp_path)))
    assert {r.id for r in usable.collect()} == {"t1", "t2", "wide"}
    totals = term_ops.group_stats(readers.scan_term_json(spark, str(tmp_path)))
    assert totals.filter("character_group IS NULL").first().terms == 5
    assert found["t1"].character_group == "é" and found["t1"].semantic_names is None
    assert found["t2"].character_group == "+" and found["t2"].semantic_names == ["n"]
    assert set(RAW_TERM.names) < set(found["t1"].asDict())


def test_split_dataset(spark, tmp_path):
    unsigned = pa.table({"n": pa.array([1, 2], pa.uint64()), "m": pa.array([1, 2], pa.uint32())})
    pq.write_table(unsigned, tmp_path / "train-00000-of-00001.parquet")
    pq.write_table(unsigned.slice(0, 1), tmp_path / "data.parquet")
    (tmp_path / "sub").mkdir()
    pq.write_table(unsigned, tmp_path / "sub" / "x.parquet")
    df = readers.scan_split_dataset(spark, str(tmp_path))
    assert dict(df.dtypes)["n"] == dict(df.dtypes)["m"] == "bigint"
    counts = {r.split_name: r["count"] for r in df.groupBy("split_name").count().collect()}
    assert counts == {"train": 2, "data.parquet": 1}


def test_unsigned_numbers_wrap_and_decimals_stay(spark, tmp_path):
    table = pa.table({
        "u": pa.array([2**64 - 1, 2**63, 5, None], pa.uint64()),
        "d": pa.array([decimal.Decimal(10**19), None, decimal.Decimal(1), decimal.Decimal(-1)], pa.decimal128(20, 0)),
    })
    pq.write_table(table, tmp_path / "train-0.parquet")
    df = readers.scan_split_dataset(spark, str(tmp_path))
    assert dict(df.dtypes)["u"] == "bigint" and dict(df.dtypes)["d"] == "decimal(20,0)"
    assert [r.u for r in df.collect()] == [-1, -(1 << 63), 5, None]
    assert df.first().d == 10**19
    (tmp_path / "flat" / "parsing-O1-phase").mkdir(parents=True)
    pq.write_table(table, tmp_path / "flat" / "parsing-O1-phase" / "x.parquet")
    assert readers.load_phase(spark, str(tmp_path / "flat"), "parsing", "O1", flat=True).first().u == -1


def test_footers_of_the_flat_layout(spark, tmp_path):
    for folder, n in (("parsing-phase", 3), ("ir_generation-O2-phase", 2), ("other", 1)):
        (tmp_path / folder).mkdir()
        pq.write_table(pa.table({"a": list(range(n))}), tmp_path / folder / "data.parquet")
    found = readers.read_footer_stats(spark, str(tmp_path), flat=True).collect()
    assert {(r.phase, r.optimization_level, r.num_rows) for r in found} == {
        ("parsing", None, 3), ("ir_generation", "O2", 2),
    }
    expected = spark.createDataFrame([("parsing",), ("typing",)], "phase string")
    state = validate.phase_completeness(expected, readers.read_footer_stats(spark, str(tmp_path), ["phase"], flat=True))
    assert {r.phase: (r.found, r.num_rows) for r in state.collect()} == {"parsing": (True, 3), "typing": (False, 0)}


def test_files_without_columns_are_compared_too(spark):
    info = spark.createDataFrame(
        [("a", 1, [("x", "int64")]), ("b", 0, []), ("c", 2, [("x", "int64"), ("y", "string")])],
        "file_name string, num_columns int, fields array<struct<name string, type string>>",
    )
    found = {r.file_name: (r.matching, r.consistent) for r in report.schema_consistency(info).collect()}
    assert found == {"a": (1, True), "b": (0, False), "c": (1, False)}
    empty = report.schema_consistency(info.withColumn("file_name", F.translate("file_name", "abc", "bac")))
    assert {r.file_name: (r.matching, r.consistent) for r in empty.collect()} == {
        "a": (0, True), "b": (0, False), "c": (0, False),
    }


def test_sample_has_the_first_rows_of_the_first_file(spark, tmp_path):
    table = pa.table({"m": [[("k", 1)]] * 9, "a.b": list(range(9, 0, -1)), "l": [[1]] * 9, "n": [None] * 9},
                     schema=pa.schema([("m", pa.map_(pa.string(), pa.int64())), ("a.b", pa.int64()), ("l", pa.list_(pa.int64())), ("n", pa.string())]))
    pq.write_table(table, tmp_path / "b.parquet")
    pq.write_table(table, tmp_path / "a.parquet", row_group_size=2)
    rows = sorted(report.first_file_sample(spark, str(tmp_path)).collect(), key=lambda r: r.row)
    assert [r.record["a.b"] for r in rows] == ["9", "8", "7", "6", "5"]


def test_phase_json_is_reported(spark, tmp_path):
    data = records(spark, 3)
    good = [json.loads(t) for t in data.filter("phase = 'parsing'").toJSON().collect()]
    put(tmp_path / "parsing-phase" / "data.json", json.dumps(good))
    put(tmp_path / "hover-phase" / "data.json", "[{oops")
    found = validate.phase_files_check(spark, str(tmp_path), ["parsing", "hover", "typing"], flat=True).collect()
    assert {r.phase: (r.state, r.records > 0) for r in found} == {
        "parsing": ("valid", True), "hover": ("invalid", True), "typing": ("missing", False),
    }
    out = str(tmp_path / "lines")
    writers.write_grouped_json(data, "phase", out)
    assert validate.phase_files_check(spark, out, ["parsing"]).first().state == "valid"
    assert validate.phase_files_check(spark, str(tmp_path / "none"), ["parsing"]).first().state == "missing"


@pytest.fixture
def dataset(tmp_path):
    good = pa.table({"id": pa.array([1, 2]), "text": ["a", "b"]})
    pq.write_table(good, tmp_path / "train-0.parquet")
    pq.write_table(good.slice(0, 0), tmp_path / "train-1.parquet")
    return tmp_path, good


def test_report_on_a_consistent_dataset(spark, dataset):
    path, _ = dataset
    info = {r.file_name: r for r in report.parquet_file_info(spark, str(path)).collect()}
    assert info["train-1.parquet"].num_rows == 0 and info["train-0.parquet"].columns == ["id", "text"]
    row = report.dataset_report(spark, str(path)).first()
    assert (row.total_files, row.total_rows, row.splits, row.schema_consistency) == (2, 2, 1, True)
    assert row.total_size_bytes == sum(f.stat().st_size for f in path.glob("*.parquet"))
    stats = {r.file_name: r.num_rows for r in readers.read_footer_stats(spark, str(path)).collect()}
    assert stats == {"train-0.parquet": 2, "train-1.parquet": 0}
    (split,) = report.split_report(spark, str(path)).collect()
    assert (split.split_name, split.num_files, split.num_rows) == ("train", 2, 2)
    assert [r.record["text"] for r in report.first_file_sample(spark, str(path)).collect()] == ["a", "b"]


@pytest.mark.parametrize("change", ["order", "type", "more", "fewer"])
def test_inconsistent_schemas(spark, dataset, change):
    path, good = dataset
    other = {
        "order": good.select(["text", "id"]),
        "type": good.set_column(0, "id", pa.array([1, 2], pa.int32())),
        "more": good.append_column("x", pa.array([1, 2])),
        "fewer": good.select(["id"]),
    }[change]
    pq.write_table(other, path / "train-2.parquet")
    found = {
        r.file_name: r.consistent
        for r in report.schema_consistency(report.parquet_file_info(spark, str(path))).collect()
    }
    assert found == {"train-0.parquet": True, "train-1.parquet": True, "train-2.parquet": False}
    assert report.dataset_report(spark, str(path)).first().schema_consistency is False


def records(spark, n=400):
    files = spark.range(n).select(
        F.format_string("f%d.rs", "id").alias("file_path"),
        F.concat(F.lit("fn f() {\n let x = 1;\n}\n// "), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40))
        .alias("content"),
    )
    return semantic.run_phases(
        semantic.explode_lines(files, context=True),
        "parsing,name_resolution,type_inference,hover",
        semantic.RunInfo(timestamp=7),
    )


def test_phase_files_are_bounded(spark, tmp_path):
    out = str(tmp_path / "out")
    data = records(spark)
    writers.write_phase_parquet(data, out, max_mb=0.05)
    back = spark.read.parquet(out)
    assert back.count() == data.count()
    assert back.select("phase").distinct().count() == 3
    sizes = [f.stat().st_size for f in pathlib.Path(out).rglob("phase=parsing/*.parquet")]
    assert len(sizes) > 5 and max(sizes) <= 0.05 * 1024 * 1024
    loaded = readers.load_phase(spark, out, "name_resolution")
    assert loaded.count() == 400
    assert "PartitionFilters: [isnotnull(phase" in loaded._jdf.queryExecution().toString()


def test_flat_layout(spark, tmp_path):
    for folder, n in (("parsing-phase", 2), ("ir_generation-O2-phase", 3)):
        (tmp_path / folder).mkdir()
        table = pa.table({"n": pa.array(range(n), pa.uint64())})
        pq.write_table(table, tmp_path / folder / "data.parquet")
    semantic_rows = readers.load_phase(spark, str(tmp_path), "parsing", flat=True)
    assert semantic_rows.count() == 2 and semantic_rows.dtypes == [("n", "bigint")]
    assert readers.load_phase(spark, str(tmp_path), "ir_generation", "O2", flat=True).count() == 3


def test_split_files_hold_at_most_the_limit(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(250).select("id", F.when(F.col("id") < 230, "train").otherwise("test").alias("split"))
    writers.write_split_parquet(rows, out, rows=100)
    counts = [r["count"] for r in spark.read.parquet(out).groupBy("_metadata.file_path").count().collect()]
    assert sum(counts) == 250 and max(counts) <= 100


def test_chunk_plan(spark):
    rows = spark.range(25).select("id", F.when(F.col("id") < 21, "train").otherwise("test").alias("split"))
    plan = writers.chunk_plan(rows, "split", [F.col("id")], rows=10).orderBy("id").collect()
    assert [r.chunk for r in plan] == [0] * 10 + [1] * 10 + [2] + [0] * 4
    assert plan[20].file_name == "train-00002-of-00003.parquet"
    assert plan[24].file_name == "test-00000-of-00001.parquet"


def test_json_writers(spark, tmp_path):
    data = records(spark, 5)
    out = str(tmp_path / "grouped")
    writers.write_grouped_json(data, "phase", out)
    back = readers.scan_phase_json(spark, out)
    assert back.exceptAll(data).isEmpty() and data.exceptAll(back).isEmpty()
    put(tmp_path / "flat" / "parsing-phase" / "data.json",
        json.dumps([json.loads(t) for t in data.filter("phase = 'parsing'").toJSON().collect()], indent=2))
    flat = readers.scan_phase_json(spark, str(tmp_path / "flat"), flat=True)
    assert flat.select(*SEMANTIC_RECORD.names).count() == 20
    rows = spark.createDataFrame([(1, None), (2, "x")], "i int, s string")
    assert writers.export_jsonl(rows, str(tmp_path / "lines")) == 2
    lines = [t for f in (tmp_path / "lines").glob("part-*") for t in f.read_text().splitlines()]
    assert sorted(lines) == ['{"i":1,"s":null}', '{"i":2,"s":"x"}']
    writers.write_report_json(rows.filter("i = 1"), str(tmp_path / "report"))
    (document,) = [f.read_text() for f in (tmp_path / "report").glob("part-*") if f.stat().st_size]
    assert json.loads(document) == {"i": 1, "s": None}
    writers.write_report_json(spark.range(5), str(tmp_path / "many"))
    text = "".join(f.read_text() for f in (tmp_path / "many").glob("part-*"))
    assert text.count('"id"') == 5


def test_files_of_a_phase_stay_below_the_limit(spark, tmp_path):
    out = str(tmp_path / "phases")
    data = records(spark, 2000)
    writers.write_phase_parquet(data, out, max_mb=0.05)
    sizes = [f.stat().st_size for f in (tmp_path / "phases").rglob("*.parquet")]
    assert len(sizes) > 3 and max(sizes) < 0.05 * 1024 * 1024
    assert spark.read.parquet(out).count() == data.count()


def test_project_and_ir_files_are_few(spark, tmp_path):
    ir = spark.range(0, 400, 1, 16).select(*[
        (F.concat(F.lit("O"), F.col("id") % 4) if f.name == "optimization_level"
         else F.lit("ir_generation") if f.name == "phase" else F.col("id").cast("string")).cast(f.dataType).alias(f.name)
        for f in IR_RECORD.fields
    ])
    writers.write_ir_parquet(ir, str(tmp_path / "ir"))
    assert len(list((tmp_path / "ir").rglob("*.parquet"))) <= 8
    assert spark.read.parquet(str(tmp_path / "ir")).count() == 400


def test_stream_takes_bounded_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = records(spark, 40).filter("phase = 'parsing'")
    data.repartition(5).write.parquet(source)

    def run():
        query = stream_phase_batches(
            spark, source, SEMANTIC_RECORD, 2, str(tmp_path / "check"), out,
            lambda df: df.select("id", "line"),
        )
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    batches = run()
    assert len(batches) == 3 and sum(batches) == 160
    assert spark.read.parquet(out).count() == 160
    # A restart reads only what is new.
    data.limit(7).coalesce(1).write.mode("append").parquet(source)
    assert sum(run()) == 7
    assert spark.read.parquet(out).count() == 167


def test_changed_files(spark):
    seen = maintenance.with_hash(spark.createDataFrame(
        [("a", "1"), ("b", "2")], "file_path string, content string"
    )).drop("content")
    files = spark.createDataFrame(
        [("a", "1"), ("b", "3"), ("c", "1")], "file_path string, content string"
    )
    found = maintenance.incremental_extract(files, seen).collect()
    assert sorted(r.file_path for r in found) == ["b", "c"]


def test_dedup_keeps_the_first(spark):
    rows = [(3, "x", None), (1, "x", None), (2, "x", "y"), (4, None, None), (5, None, None), (6, "x", "null")]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    kept = maintenance.dedup_records(df, ["a", "b"], ["i"]).collect()
    assert sorted(r.i for r in kept) == [1, 2, 4, 6]


def test_dedup_tells_microseconds_and_other_types_apart(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001', X'00', map('a', 1), 0.1D),"
        " (2, TIMESTAMP_NTZ'2024-01-01 00:00:00.000002', X'00', map('a', 1), 0.1D),"
        " (3, TIMESTAMP_NTZ'2024-01-01 00:00:00.000002', X'01', map('a', 1), 0.1D),"
        " (4, TIMESTAMP_NTZ'2024-01-01 00:00:00.000002', X'01', map('a', 2), 0.1D),"
        " (5, TIMESTAMP_NTZ'2024-01-01 00:00:00.000002', X'01', map('a', 2), 0.1D) AS t(i, `t.s`, b, m, d)"
    )
    kept = maintenance.dedup_records(df, ["t.s", "b", "m", "d"], ["i"]).collect()
    assert sorted(r.i for r in kept) == [1, 2, 3, 4]
    stamps = df.select("i", F.col("`t.s`").cast("timestamp").alias("t"))
    assert maintenance.dedup_records(stamps, ["t"], ["i"]).count() == 2


def test_jobs_leave_nothing_behind(spark, tmp_path):
    put(tmp_path / "src" / "b.rs", "fn f() {}\n")
    before = set(os.listdir(session.shared_dir(spark)))
    with session.scratch(spark):
        session.hold(spark.range(3), "x")
        assert len(os.listdir(session.shared_dir(spark))) == len(before) + 1
    assert set(os.listdir(session.shared_dir(spark))) == before


def test_completeness(spark):
    files = spark.createDataFrame([("a",), ("b",)], "file_path string")
    done = spark.createDataFrame([("a", "p"), ("a", "p"), ("b", "q")], "file_path string, phase string")
    found = maintenance.completeness_check(files, ["p", "q"], done).collect()
    assert sorted(tuple(r) for r in found) == [("a", "q"), ("b", "p")]


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_grouped_json_is_small_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "JSON_ROWS", 700)
    out = tmp_path / "grouped"
    data = records(spark, 2000)
    writers.write_grouped_json(data, "phase", str(out))
    files = [f for f in out.rglob("part-*") if f.stat().st_size]
    texts = [gzip.decompress(f.read_bytes()).decode() for f in files]
    lines = [json.loads(line) for t in texts for line in t.splitlines()]
    assert len(lines) == data.count() > 2000 and all(set(x) == set(data.columns) - {"phase"} for x in lines)
    assert max(len(t.splitlines()) for t in texts) <= 700
    assert 5 * sum(f.stat().st_size for f in files) < sum(len(t.encode()) for t in texts)
    back = readers.scan_phase_json(spark, str(out))
    assert back.exceptAll(data).isEmpty() and data.exceptAll(back).isEmpty()
