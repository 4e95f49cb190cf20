import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataset.llm import queries, sharding

SCHEMA = "doc_id long, text string, shard int, slot string, _bucket2 int"


def rows_of(spark, docs, **options):
    return sharding.shards(docs, **options).collect()


def test_counts_slots_and_order(spark):
    rows = [(i, f"text {i % 50}", 1, "x", 2) for i in range(1003)] + [(None, None, 1, "x", 2)] * 5 + [(1, "", 1, "x", 2), (2, "z" * 300_000, 1, "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, bucket string, position int")
    got = rows_of(spark, docs, bucket_bytes=2000)
    assert {(r.bucket, r.position) for r in got} == {('x', 2)}
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((r[0], r[1]) for r in rows), key=str)
    count = [sum(r.shard == s for r in got) for s in range(16)]
    assert max(count) - min(count) <= 1 and sum(count) == len(rows)
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
    again = rows_of(spark, docs.repartition(7), bucket_bytes=2000)
    key = lambda r: (str(r.doc_id), r.text or "", r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    other = rows_of(spark, docs, bucket_bytes=2000, seed=12)
    assert sorted(map(key, got)) != sorted(map(key, other))
    # Neighbours in the input are not neighbours in the output.
    place = {r.doc_id: r.shard for r in got}
    assert 0.02 < np.mean([place[i] == place[i + 1] for i in range(10, 1000)]) < 0.12


def test_small_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(3)], "doc_id long, text string")
    assert len({(r.shard, r.slot) for r in rows_of(spark, docs)}) == 3
    assert all(r.slot == 0 for r in rows_of(spark, docs))
    assert rows_of(spark, docs.limit(0)) == []


def test_orders_are_uniform():
    seen = {}
    for seed in range(6000):
        key = tuple(sharding.fisher_yates(3, [seed, 1]).tolist())
        seen[key] = seen.get(key, 0) + 1
    assert len(seen) == 6 and min(seen.values()) > 880 and max(seen.values()) < 1120
    assert sorted(sharding.fisher_yates(1000, [1, 2])) == list(range(1000))


def test_query(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.QUERIES["op2_sharding"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        raw = (r.text or "").encode()
        assert got[r.doc_id].size == len(raw) + 1 and got[r.doc_id].text_crc32 == zlib.crc32(raw)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sharding.write_shards(sharding.shards(docs), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 16
