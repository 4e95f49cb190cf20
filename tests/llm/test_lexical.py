import math
import random
import re
from collections import Counter

from strataset.llm import lexical

DOCS = "doc_id long, text string, m string, spread int, item long"
ITEMS = "item_id long, text string, doc_id int"


def plain(docs, items, k):
    """Every document scored for every item."""

    def terms(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            scored.append((-score, i is None, i or 0))
        best = sorted(s for s in scored if s[0] < 0)[:k]
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", 7, 3) for i, t in docs], DOCS),
            spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS))


def test_small_cases_equal_brute_force(spark, rows):
    docs = [(1, "a b c"), (2, "A a a b"), (3, None), (4, ""), (5, "--- ,"), (None, "b c d é"), (7, "É é 12 ÄÖ"), (7, "a b c"),
            (7, "a b c"), (8, "K z\x00y"), (9, "a " * 5000 + "rare"), (10, "a b c")]
    items = [(1, "a B rare"), (1, "é"), (None, "c"), (4, None), (5, "unknown words"), (6, "..."), (7, "a a a K 12")]
    for k in (2, 50):
        assert rows(lexical.search(*frames(spark, docs, items), k=k)) == plain(docs, items, k)


def test_random_tables_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(lexical, "_BLOCK", 7)
    monkeypatch.setattr(lexical, "_BOUNDS", 1)
    monkeypatch.setattr(lexical, "_BATCH", 12)  # several passes
    pick = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(pick.choices(words, weights=range(1, 61), k=pick.choice([3, 3, 3, 8, 40])))) for i in range(400)]
    docs += [(1000 + i, "w3 w59 w58") for i in range(300)]  # a hot stratum of equal texts
    items = [(i, " ".join(pick.choices(words, k=5))) for i in range(9)]
    assert rows(lexical.search(*frames(spark, docs, items), k=10)) == plain(docs, items, 10)


def test_bounds_hold_and_strata_are_skipped(spark, monkeypatch):
    q = lexical.Queries(["x", "y"], lexical.np.array([500, 900]), lexical.np.array([0]), lexical.np.array([0, 2]),
                        lexical.np.array([0, 1]))
    made = []
    plain_scores = lexical.Stratum.scores

    def counting(self, item, queries):
        found = plain_scores(self, item, queries)
        made.append(self)
        assert not len(found[1]) or found[1].max() <= self.bounds[item]
        return found

    monkeypatch.setattr(lexical.Stratum, "scores", counting)
    pa, np = lexical.pa, lexical.np
    n = 200
    table = pa.table({"m": np.arange(50, 50 + n), "doc_id": np.arange(n), "terms": pa.array([[0, 1]] * n, pa.list_(pa.int32())),
                      "tfs": pa.array([[1, 2]] * n, pa.list_(pa.int64()))})
    best = lexical.Best(1, 5)
    strata = lexical._strata(table, q)
    for s in strata:
        if s.bounds[0] < best.least(0):
            break
        best.add(0, s.ids[s.scores(0, q)[0]], s.scores(0, q)[1])
    assert best.ids[0][:, 1].tolist() == [0, 1, 2, 3, 4] and len(made) < 20


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a")], [(1, "a")])
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    # One document with a term everywhere: its weight is floor(1000 ln(4/3)).
    assert [tuple(r) for r in lexical.search(docs, items).collect()] == [(1, 1, 1, 287 * (10**9 // 3000))]
