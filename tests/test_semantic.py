import json
import random

import pytest
from pyspark.sql import functions as F

from strataset.functions.numbering import dense_position
from strataset.functions.text import (
    classify_element, element_name, inferred_type, is_blank, repo_key, variable_name,
)
from strataset.operators import semantic
from strataset.schemas import SEMANTIC_RECORD


def apply(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, line string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("line")).alias("x")).collect()]


def lines_of(spark, text, context=True):
    files = spark.createDataFrame([("a.rs", text)], "file_path string, content string")
    return semantic.explode_lines(files, context=context).orderBy("line_no").collect()


@pytest.mark.parametrize("context", [False, True])
def test_lines_end_at_lf_or_crlf(spark, context):
    assert [r.line for r in lines_of(spark, "a\r\n\r\nb\n", context)] == ["a", "", "b"]
    assert lines_of(spark, "", context) == []
    assert [r.line for r in lines_of(spark, "a\rb\n\n", context)] == ["a\rb", ""]
    assert [r.line_no for r in lines_of(spark, "x\ny", context)] == [1, 2]


def test_line_count_agrees_with_lines(spark):
    texts = ["", "\n", "a", "a\n", "a\r\nb", "a\n\n\nb\n", "é\nü"]
    counted = apply(spark, semantic.line_count, texts)
    assert counted == [len(lines_of(spark, t, False)) for t in texts]


def test_context_is_the_raw_neighbour(spark):
    last = lines_of(spark, "a\n\nb")[-1]
    assert (last.context_before, last.context_after) == ("", None)


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_context_across_blocks(spark, block):
    data = [(f, n, f"{f}{n}") for f in "xy" for n in range(1, 8)]
    lines = spark.createDataFrame(data, "file_path string, line_no long, line string")
    got = {
        (r.file_path, r.line_no): (r.context_before, r.context_after)
        for r in semantic.line_context(lines, block).collect()
    }
    assert len(got) == len(data)
    for f, n, _ in data:
        assert got[f, n] == (f"{f}{n - 1}" if n > 1 else None, f"{f}{n + 1}" if n < 7 else None)


def test_blank_is_unicode_white_space(spark):
    assert apply(spark, is_blank, [" 　", " \t", "", "x "]) == [True] * 3 + [False]


def test_element_type_is_the_first_rule(spark):
    texts = ["// see fn x", "struct A; enum B", "enum E", "impl A", "let x", "use a", "fnord"]
    assert apply(spark, classify_element, texts) == [
        "function", "struct", "enum", "impl", "variable", "import", "other"
    ]


def test_names(spark):
    texts = ["fn broken struct Foo {", "fn id<T>(x: T)", "struct Foo;", "fn  a (x)", "x"]
    assert apply(spark, element_name, texts) == ["Foo", "id<T>", None, "a", None]
    texts = ["let mut count: i32 = 0;", "let x: u8;", "-> u8", "let y"]
    assert apply(spark, variable_name, texts) == ["mut count: i32", "x", None, None]
    assert apply(spark, inferred_type, ["let s: String = i32::MAX", "-> bool", "x"]) == [
        "String", "bool", "unknown"
    ]


def expected_name(line):
    for mark, end in (("fn ", "("), ("struct ", " ")):
        if mark in line:
            tail = line.split(mark, 1)[1]
            if end in tail:
                return tail.split(end, 1)[0].strip()
    return None


def test_names_on_random_lines(spark):
    random.seed(7)
    pieces = ["fn ", "struct ", "(", " ", "{", "a", "é", "let ", "=", ":", "\r", "fn", "<T>"]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 9))) for _ in range(2000)]
    assert apply(spark, element_name, texts) == [expected_name(t) for t in texts]


def test_payload_counts_bytes(spark):
    files = spark.createDataFrame([("a.rs", "fn é() {}")], "file_path string, content string")
    record = semantic.parsing_records(semantic.explode_lines(files, context=True)).first()
    assert json.loads(record.syntax_data) == {
        "tokens": [{"kind": "keyword", "text": "fn", "start": 0, "end": 10}],
        "ast_node_type": "function",
    }
    assert record.id == "a.rs:1:parsing"


def test_phases(spark):
    files = spark.createDataFrame(
        [("a.rs", "fn f() -> i32 {\n\n let x = 1;")], "file_path string, content string"
    )
    lines = semantic.explode_lines(files, context=True)
    together = semantic.run_phases(lines, "parsing, name_resolution ,type_inference,hover")
    assert together.schema.names == SEMANTIC_RECORD.names
    apart = (
        semantic.parsing_records(lines)
        .unionByName(semantic.name_resolution_records(lines))
        .unionByName(semantic.type_inference_records(lines))
    ).drop("timestamp")
    together = together.drop("timestamp")
    assert together.count() == 5
    assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()
    with pytest.raises(ValueError, match="nope"):
        semantic.run_phases(lines, "parsing,nope")
    empty = semantic.run_phases(lines, "hover")
    assert empty.isEmpty() and empty.schema.names == SEMANTIC_RECORD.names


def test_processing_order_sorts_paths_by_component(spark):
    files = spark.createDataFrame(
        [("a-b", "x\ny"), ("a/b", "fn z(")], "file_path string, content string"
    )
    records = semantic.run_phases(semantic.explode_lines(files), "parsing,name_resolution")

    def sequence(mode):
        ordered = semantic.processing_order(records, mode).orderBy("processing_order").collect()
        assert [r.processing_order for r in ordered] == list(range(1, 5))
        return [(r.phase, r.file_path, r.line) for r in ordered]

    a = [("parsing", "a/b", 1), ("parsing", "a-b", 1), ("parsing", "a-b", 2)]
    b = ("name_resolution", "a/b", 1)
    assert sequence("phase_first") == [*a, b]
    assert sequence("file_first") == [a[0], b, *a[1:]]


def test_dense_position_with_a_hot_group_and_nulls(spark):
    data = [("hot", i) for i in range(900)] + [(None, i) for i in range(50)] + [("z", 1)]
    random.seed(3)
    random.shuffle(data)
    df = spark.createDataFrame(data, "g string, v int").repartition(5)
    placed = dense_position(df, [F.col("v")], within=["g"]).collect()
    assert len(placed) == len(data)
    assert all(r.position == (1 if r.g == "z" else r.v + 1) for r in placed)
    overall = dense_position(df, [F.col("g"), F.col("v")]).collect()
    assert sorted(r.position for r in overall) == list(range(1, len(data) + 1))
    assert dense_position(df.limit(0), [F.col("v")]).isEmpty()


def test_repo_key(spark):
    urls = [
        "https://github.com/o/r.git/", "https://github.com/o/r", "https://gitlab.com/o/r",
        "https://github.com/o/r.git.git//", None,
    ]
    found = apply(spark, repo_key, urls)
    assert [tuple(f) if f else None for f in found] == [("o", "r"), ("o", "r"), None, ("o", "r"), None]
