"""What a task holds, and how many batches and jobs there are, does not grow with the tables."""

import json
import os

import pyarrow.parquet as pq
import pytest

from strataset.operators import semantic
from strataset.plans import views
from strataset.session import open_together, spread
from strataset.sinks import compact, writers
from strataset.sources import files, planned
from strataset.streaming import dedup
from strataset.streaming.batches import batch_files


def parts(spark, tmp_path, n=45_000):
    """All parts in one file of one row group."""
    made = spark.range(0, n, 1, 1).selectExpr(
        "id p_partkey", "concat('n', id) p_name", "concat('Brand#', id % 25) p_brand", "cast(id % 50 + 1 as int) p_size"
    )
    made.write.parquet(str(tmp_path / "part.parquet"))


def test_files_made_of_narrow_rows_are_spread_over_tasks(spark, tmp_path):
    parts(spark, tmp_path)
    found = views.code_files(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= 3
    assert found.select("file_path").distinct().count() == 45_000
    assert spread(spark.range(10)).count() == 10


def test_lines_are_counted_without_a_sort(spark, tmp_path, monkeypatch):
    parts(spark, tmp_path, 50)
    spark.createDataFrame([(1, "en", "s", "fn a\n")], "doc_id long, lang string, source string, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    plans, hold = {}, semantic.hold
    monkeypatch.setattr(semantic, "hold", lambda df, label: (plans.setdefault(label, df._jdf.queryExecution().sparkPlan().toString()), hold(df, label))[1])
    records = semantic.ordered_records(views.located_files(spark, str(tmp_path)), ["parsing"])
    above = plans["file-counts"].split("Generate")[0].splitlines()
    nearest = max(i for i, line in enumerate(above) if "Aggregate" in line)
    assert "HashAggregate" in above[nearest] and not any("Sort" in line for line in above[nearest:])
    numbers = [r.processing_order for r in records.select("processing_order").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_splits_of_attached_rows_are_bounded_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(planned, "_SPLIT_ROWS", 100)
    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 1).write.parquet(path)
    places = planned.locate(spark, path).select(planned.FILE, planned.ROW, (planned.F.col("id") * 2).alias("twice"))
    found = planned.attach(spark, path, ["id"], places)
    assert found.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, found.collect())) == [(i, 2 * i) for i in range(1000)]


@pytest.mark.parametrize("kinds", [3, 30])
def test_folders_are_written_together(spark, tmp_path, monkeypatch, kinds):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    monkeypatch.setattr(writers, "open_together", lambda s: (seen.append(1), open_together(s))[1])
    rows = spark.range(0, 600, 1, 2).selectExpr("id", f"concat('p', id % {kinds}) phase")
    before = spark.conf.get(name)
    writers.write_grouped_json(rows, "phase", str(tmp_path / "json"))
    writers.write_phase_parquet(rows, str(tmp_path / "parquet"))
    assert len(seen) == 2 and spark.conf.get(name) == before
    with open_together(spark):
        assert int(spark.conf.get(name)) > 0
    assert spark.read.json(str(tmp_path / "json")).count() == 600
    assert spark.read.parquet(str(tmp_path / "parquet")).groupBy("phase").count().count() == kinds


def test_batches_take_more_files_of_a_larger_folder(spark, tmp_path):
    path = str(tmp_path / "in")
    assert batch_files(spark, path, 3) == 3
    spark.range(0, 100, 1, 1).write.option("maxRecordsPerFile", 2).parquet(path)
    assert batch_files(spark, path, 3, 5) == 10 and batch_files(spark, path, 30, 5) == 30


def test_keys_of_a_bucket_have_firsts_of_their_own(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(dedup, "_BUCKETS", 2)
    schema, log = "k long, n long", str(tmp_path / "log")
    for low in (50, 0):
        spark.range(0, 400, 1, 2).selectExpr("id % 40 AS k", f"id + {low} AS n").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        dedup.start_dedup(stream, ["k"], ["n"], log, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(dedup.current_records(spark.read.parquet(log))) == sorted(((i, i) for i in range(40)), key=str)
    state = spark.read.format("statestore").option("stateVarName", "best").load(str(tmp_path / "checkpoint"))
    assert state.count() == 2


def test_terms_are_listed_by_tasks(spark, tmp_path):
    full = dict(term="x", count=1, category="c", significance="s", vibe="v", action_suggestion="a")
    for group, name, text in [
        ("a", "one", json.dumps(full)), ("a", "two", json.dumps([full, full])), ("a", "blank", " \n"), ("a", "cut", "{"),
        ("b", "pretty", json.dumps(full, indent=1)), ("b", "_hidden", json.dumps(full)), ("b", "%41 x", json.dumps(full)),
    ]:
        os.makedirs(tmp_path / "terms" / group, exist_ok=True)
        (tmp_path / "terms" / group / f"{name}.json").write_text(text)
    (tmp_path / "terms" / "b" / "broken.json").write_bytes(b'{"term": "\xff"}')
    found = files.scan_term_json(spark, str(tmp_path))
    assert not any("terms" in f for f in found.inputFiles())
    got = sorted((r.character_group, r.id, r.problem is None) for r in found.collect())
    assert got == [("a", "cut", False), ("a", "one", True), ("a", "two", True), ("a", "two", True),
                   ("b", "%41 x", True), ("b", "broken", False), ("b", "pretty", True)]


def test_many_bins_are_packed_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compact, "_TRIAL", 3)
    monkeypatch.setattr(compact, "_JOB", 5)
    written, out = [], str(tmp_path / "out")
    kept = compact.plan_bins
    monkeypatch.setattr(compact, "plan_bins", lambda f, t: (written.append(len(f)), kept(f, t))[1])
    df = spark.range(0, 20_000, 1, 4).selectExpr("id", "sha2(cast(id as string), 256) AS text", "concat('p', id % 2) AS phase")
    compact.write_packed_parquet(df, out, max_mb=0.05)
    found = [f"{d}/{f}" for d, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert len(found) > 10 and max(map(os.path.getsize, found)) <= 0.05 * 1024 * 1024
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in found) == 20_000
    assert spark.read.parquet(out).select("id").distinct().count() == 20_000


def test_near_copies_meet_by_fingerprints(spark):
    from strataset.llm import similar

    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join([*words, "end"]), " ".join(f"v{i}" for i in range(100))]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    classes = rows.selectExpr("id AS rep")
    assert {(r.a, r.b) for r in similar._fingerprint_pairs(classes, rows).collect()} <= {(0, 1)}
    same = spark.createDataFrame([(5, texts[0]), (7, texts[0])], "id long, text string")
    assert [(r.a, r.b) for r in similar._fingerprint_pairs(same.selectExpr("id AS rep"), same).collect()] == [(5, 7)]
