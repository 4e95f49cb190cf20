import random
import re

import numpy as np
import pytest
import xxhash

from strataset.llm import simhash
from strataset.llm.components import components
from tests.llm.brute import closure

SCHEMA = "doc_id long, text string, id long, fp long, shard string"


def plain(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or (
        [" ".join(found)] if found else []
    )
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def corpus():
    rng = random.Random(3)
    vocab = [f"W{i}é" for i in range(300)]
    texts = [None, "", " \n\t", "one", "ONE", "a b c", "a b c d e f"]
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randint(5, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(vocab)
            texts.append("\n".join(near))
    texts += [texts[-1]] * 20
    return texts


def test_fingerprint_equals_definition(monkeypatch):
    monkeypatch.setattr(simhash, "_SEGMENT", 64)
    for text in corpus():
        assert simhash.fingerprint(text) == plain(text)
    assert simhash.fingerprint("x " * 500_000) == plain("x " * 500_000)


def test_components_equal_all_pairs(spark):
    texts = corpus()
    docs = spark.createDataFrame(
        [(i, t, 1, 2, "s") for i, t in enumerate(texts)] + [(3, texts[3], 1, 2, "s"), (None, "zzz yyy", 1, 2, "s"), (None, "", 1, 2, "s")],
        SCHEMA,
    )
    got = simhash.near_duplicates(docs).collect()
    prints = [plain(t) for t in texts]
    want = closure(
        range(len(texts)),
        [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4],
    )
    assert len(got) == len(texts) + 3
    for row in got:
        if row["id"] is not None:
            assert row["fp"] & (1 << 64) - 1 == prints[row["id"]]
            assert row["component"] == want[row["id"]]
    lone = {r["fp"]: r["component"] for r in got if r["id"] is None}
    assert lone[0] == 0 and lone[np.array([plain("zzz yyy")], np.uint64).view(np.int64)[0]] is None


@pytest.mark.parametrize("seed", range(3))
def test_forest_joins_what_is_within_the_radius(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    values, shard = [], []
    for s, b in enumerate(base):
        own = {int(b)}
        for _ in range(150):
            own.add(int(b) ^ sum(1 << x for x in {*rng.integers(0, 64, rng.integers(1, 9)).tolist()}))
        values += sorted(own)
        shard += [s] * len(own)
    values, shard = np.array(values, np.uint64), np.array(shard)
    a, b = simhash.Forest(shard, values).links(4)
    n = len(values)
    want = closure(range(n), [
        (i, j) for i in range(n) for j in range(i)
        if shard[i] == shard[j] and int(values[i] ^ values[j]).bit_count() <= 4
    ])
    assert closure(range(n), zip(a.tolist(), b.tolist())) == want


def test_empty_table_and_chain_of_links(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    chain = spark.range(1, 60).selectExpr("id a", "id - 1 b").union(spark.createDataFrame([(100, 90), (90, 90), (None, 4)], "a long, b long"))
    got = {r.node: r.component for r in components(chain).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 90: 90, 100: 90}
