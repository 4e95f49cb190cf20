"""The trigram index finds the rows a scan finds, and reads less."""

import random

import pytest
from pyspark.sql import functions as F

from strataset.operators import substrings

SCHEMA = "id long, `a.text` string, file string, block int"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("sub strings"))
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abÀé😀%_ ") for _ in range(rng.randrange(30))), "f", i) for i in range(900)]
    rows += [(900 + i, text, None, None) for i, text in enumerate([None, "", "ab", "ABC", "the needle İn a haystack", "x" * 70_000 + "END"])]
    rows += [(2000 + i, "hot abc", "g", 1) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartitionByRange(6, "id").write.parquet(f"{base}/data")
    substrings.write_index(spark, f"{base}/data", df.schema, "a.text", f"{base}/index")
    return base, df


def search(spark, stored, needle):
    base, df = stored
    return substrings.search(spark, f"{base}/data", df.schema, "a.text", f"{base}/index", needle)


@pytest.mark.parametrize("needle", [
    "abc", "ABC", "hot abc", "ab", "", "%", "_%_", "àé", "À é", "😀😀😀", "a😀b", "needle i", "NEEDLE İN", "xend", "x" * 60_000, "not there", "bca",
])
def test_same_rows_as_a_scan(spark, stored, rows, needle):
    scan = stored[1].filter(F.lower(F.col("`a.text`")).contains(F.lower(F.lit(needle))))
    assert rows(search(spark, stored, needle)) == rows(scan)


def test_grams(spark):
    assert [sorted(substrings._grams(t)) for t in ("", "ab", "abc", "abcabcd", "a😀é")] == [
        [], [], ["abc"], ["abc", "bca", "bcd", "cab"], ["a😀é"]]
    assert substrings.needle_grams(spark, "ABcd") == ["abc", "bcd"]


def test_parts_of_lists_meet(spark, stored, monkeypatch, tmp_path, rows):
    base, df = stored
    monkeypatch.setattr(substrings, "_HELD", 50)
    substrings.write_index(spark, f"{base}/data", df.schema, "a.text", str(tmp_path / "index"))
    assert rows(substrings.read_index(spark, str(tmp_path / "index"))) == rows(substrings.read_index(spark, f"{base}/index"))


def test_random_needles(spark, stored, rows):
    rng, (base, df) = random.Random(6), stored
    texts = [r[0] for r in df.select("`a.text`").collect() if r[0]]
    for _ in range(12):
        text = rng.choice(texts)
        start = rng.randrange(len(text))
        needle = text[start:start + rng.randrange(1, 9)]
        scan = df.filter(F.lower(F.col("`a.text`")).contains(F.lower(F.lit(needle))))
        assert rows(search(spark, stored, needle)) == rows(scan), needle


def test_few_files_and_blocks_are_touched(spark, stored):
    base, df = stored
    assert len(search(spark, stored, "haystack").inputFiles()) == 1
    assert search(spark, stored, "no such text").count() == 0
    index = substrings.read_index(spark, f"{base}/index")
    assert index.count() > index.filter(F.col("gram").isin(substrings.needle_grams(spark, "haystack"))).count()
    found = substrings.candidate_rows(index, "haystack")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan and "CartesianProduct" not in plan


def test_lists_are_bounded_and_sorted(spark, stored, monkeypatch, tmp_path):
    monkeypatch.setattr(substrings, "BLOCK", 64)
    base, df = stored
    substrings.write_index(spark, f"{base}/data", df.schema, "a.text", str(tmp_path / "index"))
    index = substrings.read_index(spark, str(tmp_path / "index"))
    assert index.select(F.max(F.size("deltas"))).first()[0] <= 64
    assert index.filter("gram = 'hot'").count() >= 500 // 64
    assert index.filter("exists(slice(deltas, 2, 99999), d -> d <= 0)").isEmpty()


def test_empty_dataset(spark, stored, tmp_path):
    df = stored[1].limit(0)
    df.write.parquet(str(tmp_path / "data"))
    substrings.write_index(spark, str(tmp_path / "data"), df.schema, "a.text", str(tmp_path / "index"))
    for needle in ("abc", "a"):
        assert substrings.search(spark, str(tmp_path / "data"), df.schema, "a.text", str(tmp_path / "index"), needle).count() == 0
