"""Line deltas: a dataset that is brought up to date equals one that is made anew."""

import glob
import os
import random

import pytest

from strataset.operators import deltas, semantic
from strataset.session import hold

PHASES = ["parsing", "name_resolution", "type_inference"]
RUN = semantic.RunInfo(timestamp=1)
LINES = ["fn f(x: i32) {", "", "let a: String = b;", "struct S {", "}", "   ", "use x::y;", "enum E {"]


def frame(spark, files):
    return spark.createDataFrame([(p, c, "x", 1) for p, c in files.items()], "file_path string, content string, lines string, _raw int")


def whole(files):
    return semantic.phase_records(semantic.explode_lines(files.select("file_path", "content"), context=True), PHASES, RUN)


def as_rows(df):
    names = [c for c in df.columns if c != "bucket"]
    return sorted((tuple(r) for r in df.select(*sorted(names)).collect()), key=repr)


def edited(pick, files):
    out = dict(files)
    for path in pick.sample(sorted(files), 6):
        lines = out[path].split("\n")
        at = pick.randrange(len(lines) + 1)
        kind = pick.randrange(4)
        if kind == 0:
            lines.insert(at, pick.choice(LINES))
        elif kind == 1 and lines:
            lines.pop(min(at, len(lines) - 1))
        elif kind == 2:
            lines = []
        else:
            lines[min(at, len(lines) - 1)] = "let z = 1;"
        out[path] = "\n".join(lines)
    for path in pick.sample(sorted(out), 2):
        del out[path]
    out[f"src/new{pick.randrange(10**6)}.rs"] = "fn n() {\nlet b = 2;"
    return out


def test_delta_equals_a_whole_run(spark, tmp_path):
    pick, path = random.Random(11), str(tmp_path / "records")
    files = {f"src/m{i}.rs": "\n".join(pick.choices(LINES, k=pick.randrange(1, 12))) + pick.choice(["", "\n"]) for i in range(30)}
    deltas.write_bucketed(whole(frame(spark, files)), path, buckets=16)
    for _ in range(3):
        state = hold(deltas.file_state(frame(spark, files)), "state")
        files = edited(pick, files)
        now = frame(spark, files)
        delta = hold(deltas.line_delta(now, state), "delta")
        made = deltas.delta_records(now, delta, PHASES, RUN)
        assert made.count() < whole(now).count()
        deltas.apply_delta(spark, path, delta, made, buckets=16)
        assert as_rows(spark.read.parquet(path)) == as_rows(whole(now))


def test_only_named_lines_are_made_and_only_their_buckets_written(spark, tmp_path):
    path = str(tmp_path / "records")
    files = {f"src/m{i}.rs": "fn a() {\nlet b = 1;\n}\nlet c = 2;\nlet d = 3;" for i in range(40)}
    deltas.write_bucketed(whole(frame(spark, files)), path, buckets=16)
    stamps = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/phase=*/bucket=*/*.parquet")}
    state = deltas.file_state(frame(spark, files))
    files["src/m3.rs"] = files["src/m3.rs"].replace("let d = 3;", "let d = 4;")
    now = frame(spark, files)
    delta = deltas.line_delta(now, state)
    assert [tuple(r) for r in delta.collect()] == [("src/m3.rs", "changed", [4, 5])]
    made = deltas.delta_records(now, delta, PHASES, RUN)
    assert made.count() == 4
    deltas.apply_delta(spark, path, delta, made, buckets=16)
    left = [p for p, t in stamps.items() if os.path.exists(p) and os.stat(p).st_mtime_ns == t]
    assert 3 <= len(stamps) - len(left) <= 6  # one bucket of each phase
    assert as_rows(spark.read.parquet(path)) == as_rows(whole(now))


@pytest.mark.parametrize("rest", [0, 1])
def test_deleted_files_and_no_changes(spark, tmp_path, rest):
    path = str(tmp_path / "records")
    files = {"a.rs": "fn a() {", "b.rs": "let b = 1;", "c.rs": ""}
    before = frame(spark, files)
    deltas.write_bucketed(whole(before), path, buckets=4)
    state = deltas.file_state(before)
    assert deltas.line_delta(before, state).count() == 0
    assert deltas.line_delta(before.limit(0), state.limit(0)).count() == 0
    now = before.filter("file_path = 'b.rs'") if rest else before.limit(0)
    delta = deltas.line_delta(now, state)
    assert {r.file_path: (r.change, r.lines) for r in delta.collect()} == {
        p: ("deleted", None) for p in files if not rest or p != "b.rs"}
    deltas.apply_delta(spark, path, delta, deltas.delta_records(now, delta, PHASES, RUN), buckets=4)
    assert sorted(r.file_path for r in spark.read.parquet(path).collect()) == ["b.rs", "b.rs"] * rest
