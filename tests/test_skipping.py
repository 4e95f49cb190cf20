"""Files are left out only if they hold no row that is asked for."""

import datetime as dt
import random

import pytest

from strataset.operators import skipping

SCHEMA = "id long, `s.name` string, day date, at timestamp, small short, raw binary"
COLUMNS = ["id", "s.name", "day", "at", "small", "raw"]


def made(rng, i):
    return (
        i, rng.choice([None, "", "é", "z" * 80 + str(i), f"name {i % 97}"]), rng.choice([None, dt.date(1960, 1, 1) + dt.timedelta(i)]),
        dt.datetime(1969, 12, 31) + dt.timedelta(seconds=i * 977, microseconds=i), rng.choice([None, i % 50 - 25]), bytes([i % 256, 255 - i % 256]),
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("skip these"))
    rng = random.Random(4)
    df = spark.createDataFrame([made(rng, i) for i in range(1200)] + [(None,) * 6], SCHEMA)
    df.repartitionByRange(12, "id").write.parquet(f"{base}/data")
    skipping.write_bounds(spark, f"{base}/data", df.schema, COLUMNS, f"{base}/bounds")
    skipping.write_blooms(spark, f"{base}/data", df.schema, COLUMNS[:3], f"{base}/blooms")
    return base, df


def where(spark, stored, conditions, blooms=True):
    base, df = stored
    return skipping.read_where(
        spark, f"{base}/data", df.schema, conditions, f"{base}/bounds", f"{base}/blooms" if blooms else None
    )


def plain(df, conditions):
    names = {n: i for i, n in enumerate(COLUMNS)}
    test = {"=": lambda a, b: a == b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}
    return [r for r in df.collect() if all(
        r[names[c]] is not None and v is not None and test[s](bytes(r[names[c]]) if c == "raw" else r[names[c]], v) for c, s, v in conditions)]


def test_random_conditions(spark, stored):
    rng, (base, df) = random.Random(9), stored
    for _ in range(14):
        row, conditions = made(rng, rng.randrange(-20, 1300)), []
        for name in rng.sample(COLUMNS, rng.choice([1, 1, 2])):
            conditions.append((name, rng.choice(["=", "=", "<", "<=", ">", ">="]), row[COLUMNS.index(name)]))
        found = where(spark, stored, conditions, rng.random() < 0.7)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, plain(df, conditions))), conditions


def test_every_value_is_found(spark, stored):
    base, df = stored
    for i in range(0, 1200, 149):
        assert where(spark, stored, [("id", "=", i)]).count() == 1
    assert where(spark, stored, [("s.name", "=", "z" * 80 + "no")]).count() == 0


def test_fewer_files_are_read(spark, stored):
    base, df = stored

    def files(conditions, blooms):
        return skipping.files_for(spark, f"{base}/data", df.schema, conditions, f"{base}/bounds", blooms and f"{base}/blooms").count()

    assert files([], None) == 12
    assert files([("id", "=", 700)], None) == 1
    assert files([("id", ">=", 300), ("id", "<", 500)], None) <= 3
    absent = [("s.name", "=", "name 9x")]
    assert files(absent, None) >= 11 and files(absent, True) <= 1
    assert len(where(spark, stored, [("id", "=", 700)]).inputFiles()) == 1


def test_new_and_rewritten_files_are_read(spark, tmp_path):
    schema = spark.range(1).schema
    data = str(tmp_path / "data")
    spark.range(0, 10, 1, 1).write.parquet(data)
    skipping.write_bounds(spark, data, schema, ["id"], str(tmp_path / "bounds"))
    skipping.write_blooms(spark, data, schema, ["id"], str(tmp_path / "blooms"))

    def count(value):
        return skipping.read_where(spark, data, schema, [("id", "=", value)], str(tmp_path / "bounds"), str(tmp_path / "blooms")).count()

    assert (count(5), count(70)) == (1, 0)
    spark.range(50, 100, 1, 1).write.mode("append").parquet(data)
    assert (count(5), count(70)) == (1, 1)
    spark.range(200, 300, 1, 1).write.mode("overwrite").parquet(data)
    assert (count(5), count(250)) == (0, 1)


def test_large_file_has_several_parts_and_rare_false_hits(spark, tmp_path):
    df = spark.range(0, 40_000, 2, 1)
    df.write.parquet(str(tmp_path / "data"))
    skipping.write_blooms(spark, str(tmp_path / "data"), df.schema, ["id"], str(tmp_path / "blooms"))
    blooms = spark.read.parquet(str(tmp_path / "blooms"))
    assert blooms.count() == 8  # 20,000 values of 12 bits
    hits = sum(skipping._bloom_misses(blooms, df.schema, ("id", "=", i)).isEmpty() for i in range(1, 60, 2))
    assert hits <= 3
    assert all(skipping._bloom_misses(blooms, df.schema, ("id", "=", i)).isEmpty() for i in range(0, 40_000, 4_321 * 2))


def test_empty_and_null(spark, stored, tmp_path):
    base, df = stored
    assert where(spark, stored, [("id", "=", None)]).count() == 0
    empty = df.limit(0)
    empty.write.parquet(str(tmp_path / "data"))
    skipping.write_bounds(spark, str(tmp_path / "data"), df.schema, COLUMNS, str(tmp_path / "bounds"))
    assert skipping.read_where(spark, str(tmp_path / "data"), df.schema, [("id", "=", 1)], str(tmp_path / "bounds")).count() == 0
    skipping.write_bounds(spark, f"{base}/data", df.schema, ["day"], str(tmp_path / "b1"))
    assert skipping.read_where(spark, f"{base}/data", df.schema, [("id", "=", 1)], str(tmp_path / "b1")).count() == 1
    with pytest.raises(TypeError):
        skipping.write_bounds(spark, base, spark.sql("SELECT 1.5D AS x").schema, ["x"], str(tmp_path / "b2"))
