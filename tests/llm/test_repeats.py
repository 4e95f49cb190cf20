import hashlib
import random

import numpy as np
import pytest

from strataset.llm import queries, repeats

SCHEMA = "doc_id long, text string, kept string, n_bytes int, chunk string, __row int"


def brute(rows, depth=50):
    """(bytes kept, n_removed, n_spans) per row; rows are (id or None, text)."""
    first = {}
    raws = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        for a in range(len(raw) - depth + 1):
            w = raw[a : a + depth]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for a in range(len(raw) - depth + 1):
            if first[raw[a : a + depth]] < i:
                gone[a : a + depth] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]]), int(gone.sum()), spans))
    return out


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [make(rng.choice([30, 49, 50, 51, 60, 120, 400, 3000])) for _ in range(14)]
    texts = [None, "", "short", "a" * 49, "a" * 50, "a" * 51, "a" * 500, "ab" * 300, "ab" * 100]
    for _ in range(70):
        texts.append("".join(rng.choice([make(rng.randint(0, 90)), rng.choice(shared)]) for _ in range(rng.randint(1, 8))))
    texts += [texts[-1]] * 5 + [texts[-2][:-1] + "Z"] * 2 + [make(70) * 3]
    rng.shuffle(texts)
    return texts


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 3, "x", 4) for i, t in rows], SCHEMA)
    got = repeats.remove_repeats(docs).collect()
    want = sorted(((i, t, k.hex(), n, s) for (i, t), (k, n, s) in zip(rows, brute(rows))), key=str)
    assert sorted(((r.doc_id, r.text, bytes(r.kept).hex(), r.n_removed, r.n_spans) for r in got), key=str) == want
    assert all(r.n_bytes == len((r.text or "").encode()) and r.chunk == "x" for r in got)


@pytest.mark.parametrize(("seed", "settings"), [
    (1, {}),
    (2, {"_PART": 2000, "_RUNS": 4000, "_DIGITS": 5000}),
    (3, {"_PART": 900, "_RUNS": 3000, "_HOT": 0}),
    (4, {"_PART": 1500, "_BLOCK": 64, "_LONGEST_RUN": 3, "_HOT": 2}),
])
def test_equals_brute_force(spark, monkeypatch, seed, settings):
    for name, value in settings.items():
        monkeypatch.setattr(repeats, name, value)
    rows = list(enumerate(corpus(seed)))
    random.Random(seed).shuffle(rows)
    rows += [(None, rows[3][1]), (None, rows[3][1]), (5, rows[6][1]), (5, rows[6][1])]
    check(spark, rows)


def test_sorting_by_digits_equals_comparing_windows():
    rng = np.random.default_rng(0)
    for depth in (19, 24, 50):
        raw = rng.integers(97, 99, 4000).astype(np.uint8)
        raw[1000:1200] = raw[:200]
        raw[3000:3300] = raw[100:400]
        at, ids = np.arange(4000 - depth), rng.integers(0, 9, 4000 - depth)
        got = repeats.repeated_windows(raw, at, ids, depth)
        least = {}
        for a, i in zip(at.tolist(), ids.tolist()):
            w = raw[a : a + depth].tobytes()
            least[w] = min(i, least.get(w, i))
        assert got.tolist() == [i > least[raw[a : a + depth].tobytes()] for a, i in zip(at.tolist(), ids.tolist())]


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op4_suffix_dedup"](spark, sf).collect()}
    for (i, t), (kept, n, spans) in zip(rows, brute(rows)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len((t or "").encode()), n, spans, hashlib.sha256(kept).hexdigest())


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
