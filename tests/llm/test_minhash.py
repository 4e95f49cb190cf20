import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from strataset.llm import minhash, queries

SCHEMA = "doc_id long, text string, row string, key int, own string"


def shingles(text, n=5):
    import re

    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_edits_order_and_likeness(spark):
    rng = random.Random(1)
    vocab = [f"wörd{i}" for i in range(500)]
    texts = {i * 7: " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 6, 40, 300, 1500]))) for i in range(60)}
    texts[7 * 60] = texts[7 * 59] + " and one more"
    texts[7 * 61] = None
    texts[7 * 62] = "x" * 100_000
    rows = list(texts.items())
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "c", 1, "d") for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in minhash.fingerprints(docs).collect()}
    order = sorted(texts)
    near = []
    for here, after in zip(order, order[1:] + order[:1]):
        a, b = texts[here] or "", texts[after] or ""
        n = len(a) // 4
        edited = a[: len(a) - n] + b[:n]
        r = got[here]
        assert r.n_chars == len(a)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        near += [abs(r.near_edited - jaccard(a, edited)), abs(r.near_next - jaccard(a, b))]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert max(near) < 0.2 and np.mean(near) < 0.03


def test_ties_repeats_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", "c", 1, "d")] * 3 + [(1, "other text", "c", 1, "d"), (None, "a b c d e f", "c", 1, "d"), (None, None, "c", 1, "d"), (9, "", "c", 1, "d")], SCHEMA
    )
    got = minhash.fingerprints(docs).collect()
    assert len(got) == 7
    same = {r.fingerprint for r in got if r.n_chars == 11}
    assert len(same) == 1 and len(next(iter(same))) == 256
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"-" * 256}
    one = minhash.fingerprints(docs.filter("doc_id = 9")).collect()
    assert [(r.near_edited, r.near_next) for r in one] == [(1.0, 1.0)]
    assert minhash.fingerprints(docs.limit(0)).collect() == []


def test_signature_equals_definition(spark):
    """Smallest hash per bin, probes in the stated order, low-order bits packed in bin order."""
    texts = ["a b c d e f g h", " ".join(map(str, range(200))), "one", "x y z w v"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    i = F.col("id").cast("int")
    asked = [minhash._probe(i, F.lit(t)) for t in range(12)] + [minhash._probe_after(i, F.lit(t)) for t in range(128)]
    probes_of = {r[0]: r[1] for r in spark.range(128).select("id", F.array(*asked)).collect()}
    assert all(set(p[12:]) == set(range(128)) for p in probes_of.values())
    got = {r.id: r.own for r in minhash.signatures(df, "t", "own").collect()}
    words = df.select("id", F.transform(F.split("t", " "), lambda w: F.xxhash64(w)).alias("h"))
    for r in words.collect():
        runs = [r.h[i : i + 5] for i in range(len(r.h) - 4)]
        if runs:
            hashed = [x[0] for x in spark.createDataFrame(runs, "a long, b long, c long, d long, e long").select(F.xxhash64("a", "b", "c", "d", "e")).collect()]
        else:
            hashed = [spark.createDataFrame([(r.h,)], "h array<long>").select(F.xxhash64("h")).first()[0]]
        bins = {}
        for h in hashed:
            bins[(h >> 57) + 64] = min(h, bins.get((h >> 57) + 64, h))
        for b in range(128):
            probes = probes_of[b]
            value = bins.get(b, next((bins[p] for p in probes if p in bins), None))
            assert (got[r.id][b // 8] >> 8 * (7 - b % 8)) & 255 == value & 255


def test_query_runs_no_python(spark):
    plan = queries.QUERIES["op6_minhash_fingerprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
