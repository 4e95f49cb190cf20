import duckdb
import numpy as np
import pytest

from strataset.llm import embeddings, queries
from tests.llm.brute import closure

SCHEMA = "vec_id long, embedding array<float>, id long, vec string, rep int"


def brute(rows, threshold=0.95):
    usable = []
    for i, v in rows:
        if v and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.append((i, np.array(v, np.float32).astype(float)))
    links = []
    for x, (i, a) in enumerate(usable):
        for j, b in usable[:x]:
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                links.append((i, j))
    counts = {i: 0 for i, _ in rows}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return counts, closure([i for i, _ in rows if i is not None], links)


def cloud(seed, groups=12, size=25, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        out += [centre + rng.standard_normal(dim) * 0.1 * rng.random() for _ in range(rng.integers(1, size))]
    return [x.astype(np.float32).tolist() for x in out]


def test_links_and_components_equal_all_pairs(spark):
    vecs = cloud(1)
    vecs += [vecs[0]] * 30 + [[2 * x for x in vecs[0]], [0.0] * 32, [], None, [None] * 32, [float("nan")] * 32,
             [float("inf")] + [0.0] * 31, [1e38] * 32, [1e-38] * 32, [1.0], [2.0], [-1.0]]
    rows = list(enumerate(vecs))
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows + [(None, vecs[0])]], SCHEMA)
    got = {r["id"]: (r["n_links"], r["component"]) for r in embeddings.near_duplicates(df).collect()}
    counts, comp = brute(rows)
    assert got.pop(None) == (0, None)
    found = sum(n for n, _ in got.values())
    assert found >= 0.97 * sum(counts.values())
    assert all(n <= counts[i] for i, (n, _) in got.items())
    assert {i: c for i, (_, c) in got.items()} == comp


def test_blocks_of_a_hot_bucket_give_the_same(spark, monkeypatch):
    vecs = cloud(2, groups=2, size=150, dim=8)
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in enumerate(vecs)], SCHEMA)
    whole = sorted(map(tuple, embeddings.near_duplicates(df).collect()))
    monkeypatch.setattr(embeddings, "_BLOCK", 7)
    assert sorted(map(tuple, embeddings.near_duplicates(df).collect())) == whole
    assert sum(r[1] for r in whole) > 1000


def test_estimates_are_unbiased_within_their_bounds():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned, signs, factor = embeddings.codes(x, 1)
    guess, bound = embeddings.estimate(turned, signs, factor, 3.0)
    error = guess - x @ x.T
    np.fill_diagonal(error, 0)
    assert abs(error.mean()) < 2e-3
    assert (np.abs(error) <= bound).mean() > 0.99


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    counts, comp = brute(rows)
    got = embeddings.near_duplicates(df).collect()
    assert sum(r.n_links for r in got) >= 0.99 * sum(counts.values())
    assert {r.id: r.component for r in got} == comp


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = sorted(con.execute(queries.ORACLES["op5_embedding_near_dedup"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op5_embedding_near_dedup"](spark, "/root/testdata/sf0.01").collect())) == want


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("rows", [10, 10**5, 10**10])
def test_tables_reach_the_recall(rows):
    bits, tables = embeddings.plan_tables(rows, 0.95, 0.99, 16)
    p = (1 - np.arccos(0.95) / np.pi) ** bits
    assert 1 - (1 - p) ** tables >= 0.99


def planted(pairs=3000, dim=64, low=0.9502, high=0.97):
    """Pairs of unit vectors of a cosine between `low` and `high`, unlike all others."""
    rng = np.random.default_rng(11)
    a, b = rng.standard_normal((2, pairs, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = rng.uniform(low, high, (pairs, 1))
    return np.stack([a, c * a + np.sqrt(1 - c * c) * b], 1).reshape(-1, dim)


def test_no_planted_pair_is_missed(spark):
    vecs = planted()
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in enumerate(vecs.astype(np.float32).tolist())], SCHEMA)
    got = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(df).collect()}
    missed = [i for i in range(0, len(vecs), 2) if got[i] != (1, i) or got[i + 1] != (1, i)]
    assert missed == []
