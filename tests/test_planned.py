"""Columns attached to rows and files where they lie."""

import random

import pytest
from pyspark.sql import functions as F

from strataset.operators import semantic
from strataset.sinks import writers
from strataset.sources import files, planned

PHASES = ["parsing", "name_resolution", "type_inference"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def dataset(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(5000).select(
        "id", F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("text"),
        F.when(F.col("id") % 3 == 0, F.array("id")).alias("list"), (F.col("id") / 7).alias("x"),
        F.timestamp_seconds("id").alias("ts"),
    )
    rows.repartition(3).write.option("parquet.block.size", 20_000).parquet(path)
    return path


def test_attached_equals_a_join(spark, dataset, small_splits, rows):
    located = planned.locate(spark, dataset)
    places = located.filter("id % 4 <> 1").select(planned.FILE, planned.ROW, (F.col("id") * 10).alias("n"))
    found = planned.attach(spark, dataset, ["text", "id", "list", "x", "ts"], places)
    assert found.columns == ["text", "id", "list", "x", "ts", "n"] and found.rdd.getNumPartitions() > 5
    expected = spark.read.parquet(dataset).filter("id % 4 <> 1").selectExpr("text", "id", "list", "x", "ts", "id * 10 AS n")
    assert rows(found) == rows(expected)
    assert "Exchange" not in plan_of(found)


def test_few_and_no_places(spark, dataset, small_splits, rows):
    located = planned.locate(spark, dataset)
    one = located.filter("id = 4321").select(planned.FILE, planned.ROW, F.lit("x").alias("mark"))
    assert [tuple(r) for r in planned.attach(spark, dataset, ["id"], one).collect()] == [(4321, "x")]
    assert planned.attach(spark, dataset, ["id"], one.limit(0)).count() == 0
    with pytest.raises(ValueError):
        planned.attach(spark, dataset, ["id"], one.withColumnRenamed("mark", "id"))


@pytest.fixture
def tree(tmp_path):
    pick = random.Random(3)
    lines = ["fn f(x: i32) {", "", "let a: String = b;", "struct S {", "}", "   ", "use x::y;"]
    for i in range(60):
        folder = tmp_path / "src" / pick.choice(["a", "a-b", "b/c", "target", ".hidden"])
        folder.mkdir(parents=True, exist_ok=True)
        text = "\n".join(pick.choices(lines, k=pick.randrange(40)))
        (folder / f"m{i}.rs").write_bytes(text.encode() + (b"\xff\xfe" if i == 7 else b""))
    (tmp_path / "src" / "a" / "note.txt").write_text("fn no() {")
    return str(tmp_path / "src")


def test_files_come_in_order_and_in_splits(spark, tree, small_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    listed = planned.list_texts(spark, tree, "*.rs", ["target"])
    found = planned.planned_texts(spark, listed.withColumn("extra", F.length("uri")))
    expected = {r.file_path: r.content for r in files.scan_source_files(spark, tree).collect()}
    got = found.collect()
    assert [r.file_path for r in got] == sorted(expected, key=lambda p: p.split("/"))
    assert all(r.content == expected[r.file_path] for r in got if not r.file_path.endswith("/m7.rs"))
    assert found.rdd.getNumPartitions() > 3 and "Exchange" not in plan_of(found)
    assert planned.planned_texts(spark, listed.limit(0)).count() == 0


@pytest.mark.parametrize("mode", ["phase_first", "file_first"])
def test_numbering_exchanges_no_content(spark, tree, small_splits, mode):
    order = ["processing_order"]
    plain = files.scan_source_files(spark, tree)
    run = semantic.RunInfo(timestamp=1)
    by_path = semantic.ordered_records(plain, PHASES, run, mode).orderBy(order).collect()
    planned_records = semantic.ordered_records(semantic.TreeFiles(spark, tree), PHASES, run, mode)
    assert planned_records.orderBy(order).collect() == by_path and by_path
    assert [r.processing_order for r in by_path] == list(range(1, len(by_path) + 1))
    assert "Exchange" in plan_of(semantic.ordered_records(plain, PHASES, run, mode))
    assert "Exchange" not in plan_of(planned_records) and "Join" not in plan_of(planned_records)


def test_rows_of_tables_are_numbered_where_they_lie(spark, tmp_path, small_splits):
    content = "concat('fn a', id, '(', chr(10), 'let b = ', id % 3, ';', chr(10), chr(10))"
    spark.range(300).repartition(3).write.parquet(str(tmp_path / "t"))
    source = semantic.LocatedFiles(spark, str(tmp_path / "t"), ["id"], "concat('p/', id)", content)
    found = semantic.ordered_records([source, source], PHASES[:2], semantic.RunInfo(timestamp=1))
    assert "Exchange" not in plan_of(found)
    assert sorted(r[0] for r in found.select("processing_order").collect()) == list(range(1, 1801))


def test_chunks_keep_other_columns_in_place(spark, small_splits, rows):
    df = spark.range(2500).selectExpr("id", "CASE WHEN id % 5 = 0 THEN NULL ELSE id % 2 END AS split", "repeat('x', 200) AS text")
    found = writers.chunk_plan(df, "split", [F.col("id")], rows=300)
    got = found.select("id", "split", "chunk", "chunks", F.length("text")).collect()
    for split in (None, 0, 1):
        own = sorted(r.id for r in got if r.split == split)
        assert {r.id: r.chunk for r in got if r.split == split} == {i: k // 300 for k, i in enumerate(own)}
        assert {r.chunks for r in got if r.split == split} == {-(-len(own) // 300)}
    assert "Exchange" not in plan_of(found)
    with pytest.raises(ValueError):
        writers.chunk_plan(df.withColumn("chunk", F.lit(1)), "split", [F.col("id")])
