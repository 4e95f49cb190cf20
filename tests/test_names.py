"""Columns of any name come through the operators that keep other columns."""

import pytest
from pyspark.sql import functions as F

from strataset.functions.names import unused
from strataset.operators import maintenance, project, semantic, terms, versions

NAMES = ["_key0", "_key1", "_rank", "_salt", "_split", "_lines", "_pos", "_block", "_rim", "_key", "_raw", "_name", "_req",
         "_part", "_stamp", "_own", "_g0", "_carry", "name", "key", "fact", "row", "span"]


def with_names(df):
    extra = {n: F.concat(F.lit(f"{n} of "), F.col(df.columns[0]).cast("string")) for n in NAMES if n not in df.columns}
    return df.withColumns(extra), list(extra)


def lines(spark, context=False):
    files = spark.createDataFrame([("a.rs", "x\ny"), ("b.rs", "z\n")], "file_path string, content string")
    return semantic.explode_lines(with_names(files)[0], context=context)


CASES = {
    "dedup_records": lambda s: (maintenance.dedup_records(with_names(s.range(5).selectExpr("id", "id % 2 AS k"))[0], ["k"], ["id"]), "id", 2),
    "sample_per_group": lambda s: (terms.sample_per_group(with_names(s.range(9).selectExpr("cast(id as string) AS id", "'g' AS character_group"))[0], 3), "id", 3),
    "explode_lines": lambda s: (lines(s), "file_path", 3),
    "explode_lines_context": lambda s: (lines(s, True), "file_path", 3),
    "line_context": lambda s: (semantic.line_context(lines(s), block=1), "file_path", 3),
    "ecosystem_enrich": lambda s: (project.ecosystem_enrich(
        with_names(s.createDataFrame([("https://github.com/o/r", "n")], "repository string, name string"))[0],
        s.createDataFrame([("n", 1)], "name string, downloads long"),
        s.createDataFrame([("o", "r", 1, 2, 3, None)], "owner string, repo string, stars int, forks int, issues int, updated_at string"),
    ), "repository", 1),
    "resolve_versions": lambda s: (versions.resolve_versions(
        with_names(s.createDataFrame([(1, "a", "^1")], "id int, dep_name string, version_req string"))[0],
        s.createDataFrame([("a", "1.2.0")], "name string, version string")), "id", 1),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_other_columns_are_kept(spark, case):
    df, first, n = CASES[case](spark)
    rows = df.collect()
    assert len(rows) == n
    for name in NAMES:
        if case == "ecosystem_enrich" and name == "name":
            continue
        assert all(r[name] == f"{name} of {r[first]}" for r in rows), name


def test_made_columns_replace_their_namesakes(spark):
    files = spark.createDataFrame([("a.rs", "x\ny", "old", 7, "b")], "file_path string, content string, line string, line_no int, context_before string")
    found = semantic.explode_lines(files, context=True)
    assert [(r.line_no, r.line, r.context_before) for r in found.collect()] == [(1, "x", None), (2, "y", "x")]
    assert len(found.columns) == len(set(found.columns))
    plain = semantic.explode_lines(files)
    assert [(r.line, r.context_before) for r in plain.collect()] == [("x", "b"), ("y", "b")]
    assert [r.context_before for r in semantic.line_context(plain).orderBy("line_no").collect()] == [None, "x"]


def test_unused_names():
    assert unused(["a", "_X", "_x_"], "_x", "b", "b") == ["_x__", "b", "b_"]
