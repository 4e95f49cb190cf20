"""Packed files: full, within the limit, and with the rows they came from."""

import os
import random
from statistics import mean

import pytest

from strataset.sinks import compact

SCHEMA = "id long, text string, parts array<string>, at timestamp, k string, kind string"


def data(spark, n=6000, seed=1):
    rng = random.Random(seed)
    kinds = ["a", "a", "a", "b", None, "c=d/e f%"]
    rows = [(i, "".join(rng.choices("abcdefgh ", k=rng.randrange(300))), [str(i)], None, f"k{i % 2}", rng.choice(kinds)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


def sizes(path):
    return [os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


@pytest.mark.parametrize("limit", [0.05, 0.2])
def test_files_are_full_and_within_the_limit(spark, tmp_path, rows, limit):
    df, out = data(spark).drop("k"), str(tmp_path / "out")
    compact.write_packed_parquet(df, out, ["kind"], limit)
    found = sizes(out)
    assert max(found) <= limit * 1024 * 1024
    by_kind = {d: [os.path.getsize(f"{out}/{d}/{f}") for f in os.listdir(f"{out}/{d}") if f.endswith(".parquet")]
               for d in os.listdir(out) if d.startswith("kind=")}
    assert len(by_kind) == 4
    full = [s for files in by_kind.values() for s in sorted(files)[1:]]  # without the last of each kind
    assert mean(full) >= 0.7 * limit * 1024 * 1024 and len(full) >= 2
    assert rows(spark.read.parquet(out).select(df.columns)) == rows(df)


def test_compressible_rows_are_packed_again(spark, tmp_path, rows):
    """Equal texts in many small files take far less room together."""
    df, out = spark.range(0, 30_000, 1, 30).selectExpr("id", "repeat('same words ', 40) AS text", "'p' AS phase"), str(tmp_path / "out")
    compact.write_packed_parquet(df, out, max_mb=0.02)
    found = sizes(out)
    assert max(found) <= 0.02 * 1024 * 1024 and mean(sorted(found)[1:]) >= 0.7 * 0.02 * 1024 * 1024
    assert spark.read.parquet(out).select("id").distinct().count() == 30_000


def test_two_keys_and_large_rows(spark, tmp_path, rows):
    df, out = data(spark, 40), str(tmp_path / "out")
    compact.write_packed_parquet(df, out, ["k", "kind"], 0.000001)  # no row fits: a file each
    assert len(sizes(out)) == 40
    assert rows(spark.read.parquet(out).select(df.columns)) == rows(df)


def test_empty(spark, tmp_path):
    out = str(tmp_path / "out")
    compact.write_packed_parquet(data(spark, 3).limit(0), out, ["kind"])
    assert sizes(out) == [] or spark.read.schema(SCHEMA).parquet(out).count() == 0


def test_bins_cover_every_row_once():
    rng = random.Random(3)
    for _ in range(200):
        files = [((rng.choice("ab"),), f"f{i}", rng.randrange(0, 50), rng.randrange(0, 5000)) for i in range(rng.randrange(12))]
        target = rng.choice([1, 100, 1000, 9000])
        bins, weight = compact.plan_bins(files, target), {f[1]: max(f[3], 1) / max(f[2], 1) for f in files}
        seen = [(p, i) for _, pieces in bins for p, a, b in pieces for i in range(a, b)]
        assert sorted(seen) == sorted((f[1], i) for f in files for i in range(f[2]))
        for values, pieces in bins:
            n = sum(b - a for _, a, b in pieces)
            assert n == 1 or sum(weight[p] * (b - a) for p, a, b in pieces) <= target + 1e-6
            assert {f[0] for f in files if f[1] in {p for p, _, _ in pieces}} == {values}
