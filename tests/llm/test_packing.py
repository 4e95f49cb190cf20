import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataset.llm import packing, queries
from strataset.llm.tokens import ByteBpe

SCHEMA = "doc_id long, text string, start int, length string, ids int"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def corpus():
    rng = random.Random(5)
    texts = [None, "", " ", "x", "<|endoftext|>", "a<|endoftext|>b <|endoftext", "naïve  😀\r\n\t\n x\x00y"]
    texts += [" ".join(rng.choice(["the", "Ünd", "12", "don't", "\n", "zzqx", "😀"]) for _ in range(rng.choice([3, 90, 600, 4000]))) for _ in range(60)]
    texts += ["same text"] * 40 + ["long " * 60_000]
    return texts


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(PATH), ByteBpe(PATH)
    for text in corpus():
        want = library.encode(text or "", add_special_tokens=False).ids
        got = own.encode(text or "")
        assert got.tolist() == want
        assert own.n_bytes[got].sum() == len((text or "").encode())


def check(rows, texts):
    library = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
        assert sum(r.length for r in own) == len(ids) and {r.doc_tokens for r in own} == {len(ids)}
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
        assert sum(r.length for r in own) <= 1024
    return sum(r.length for r in rows) / (1024 * len(by_seq))


def test_every_id_is_in_one_place(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], SCHEMA)
    assert check(packing.packed_documents(docs).collect(), texts) > 0.9


def test_query_packs_the_table_tightly(spark):
    sf = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    assert check(queries.QUERIES["op8_packing"](spark, sf).collect(), texts) > 0.97


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b", 1, "x", 2)] * 3 + [(7, "c", 1, "x", 2)] * 3, SCHEMA)
    got = packing.packed_documents(docs).collect()
    assert len(got) == 6 and len({r.sequence_id for r in got}) == 1
    assert sorted(r.offset for r in got) == [0, 2, 4, 6, 9, 12] or sum(r.length for r in got) == 15
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(corpus())], SCHEMA)
    found = packing.pieces(docs)
    whole = packing.sequences(packing.pack(found)).agg(
        F.min(F.length("ids")), F.max(F.length("ids")), F.sum("n_tokens")
    ).first()
    assert tuple(whole) == (4096, 4096, found.agg(F.sum("length")).first()[0])


@pytest.mark.parametrize("seed", range(6))
def test_plan_meets_the_demand_exactly(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 10 ** (seed + 1), 32) * (rng.random(32) < 0.6)
    total = np.zeros(32, np.int64)
    n = 0
    for pattern, times in packing.plan(demand, 32):
        assert (pattern * np.arange(1, 33)).sum() <= 32 and times > 0
        total += pattern * times
        n += times
    assert (total == demand).all()
    # The relaxed program's own bound: no plan of any kind needs fewer sequences than `least`.
    columns, amount, worth = packing.relaxed(demand, 32)
    least = worth @ demand
    assert packing.best_pattern(worth, 32)[0] <= 1 + 1e-6
    assert amount.sum() == pytest.approx(least)
    assert n <= least + 33


def test_knapsack_equals_search():
    rng = np.random.default_rng(1)
    for _ in range(20):
        worth = rng.random(6)
        best = 0

        def search(free, value, b):
            nonlocal best
            best = max(best, value)
            for k in range(b, 6):
                if k + 1 <= free:
                    search(free - k - 1, value + worth[k], k)

        search(10, 0, 0)
        value, pattern = packing.best_pattern(worth, 10)
        assert value == pytest.approx(best) and (pattern @ worth) == pytest.approx(best)
        assert pattern @ np.arange(1, 7) <= 10


def test_the_pipeline_gives_the_packed_ids(spark):
    import corpus_pipeline

    texts = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    packed = corpus_pipeline.pack_tokens(spark, docs, "")
    rows = packed.collect()
    assert check(rows, texts) > 0.9
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    whole = {r.sequence_id: r.ids for r in packing.sequences(spark.createDataFrame(rows, packed.schema)).collect()}
    assert all(whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids for r in rows)
    twice = docs.filter("doc_id < 7").union(docs.filter("doc_id < 7"))
    assert corpus_pipeline.pack_tokens(spark, twice, "").count() == 14
