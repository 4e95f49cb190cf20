import itertools
import math
import random

import numpy as np
import pytest

from strataset.llm import language, queries

SCHEMA = "doc_id long, text string, lang string, score string"


def test_forward_sums_all_segmentations():
    ids = {p: i for i, p in enumerate(["▁a", "▁ab", "a", "b", "ab", "ba", "▁b", "bab"])}
    rng = np.random.default_rng(0)
    log_p = np.log(rng.dirichlet(np.ones(len(ids) + 1), 3).T)
    words = ["a", "ab", "abba", "bab", "xab", "axb", "b" * 30]
    got = language.Lattice(words, ids).log_likelihood(log_p)
    for w, word in enumerate(words[:-1]):
        for k in range(3):
            total = 0.0
            n = len(word)
            for cuts in itertools.product([0, 1], repeat=n - 1):
                parts, at = [], 0
                for i, c in enumerate((*cuts, 1)):
                    if c:
                        parts.append(("▁" if at == 0 else "") + word[at : i + 1])
                        at = i + 1
                ps = []
                for p in parts:
                    bare = p.lstrip("▁")
                    ps.append(ids.get(p, len(ids) if len(bare) == 1 else None))
                if None not in ps:
                    total += math.exp(sum(log_p[i, k] for i in ps))
            assert got[w, k] == pytest.approx(math.log(total))


def test_expected_counts_are_the_gradient():
    ids = {p: i for i, p in enumerate(["▁a", "▁ab", "a", "b", "ab", "ba", "▁b"])}
    p = np.random.default_rng(1).dirichlet(np.ones(len(ids) + 1))
    lattice, counts = language.Lattice(["abba", "ab", "bxa"], ids), np.array([2.0, 1, 3])
    got = lattice.expected(p, counts)
    for i in range(len(p)):
        up = np.log(p)[:, None].copy()
        up[i] += 1e-6
        change = (lattice.log_likelihood(up) - lattice.log_likelihood(np.log(p)[:, None]))[:, 0] @ counts / 1e-6
        assert got[i] == pytest.approx(change, abs=1e-4)


def test_undetermined_texts_and_other_cases(spark):
    rng = random.Random(1)
    make = lambda parts: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(40))
    rows = [(i, make(["the", "ing", "er"]), "en", "x") for i in range(40)] + [(100 + i, make(["eau", "que", "é"]), "fr", "x") for i in range(40)]
    rows += [(300, None, "en", "x"), (301, "", "en", "x"), (302, "12 %& 3", "fr", "x"), (303, "The Eringer " * 20_000, None, "x"), (None, "eauque éque", None, "x"), (None, "eauque éque", None, "x"), (304, "z" * 500, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(df, per_language=30)
    assert model[0] == ["en", "fr"]
    got = language.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r[0]: (r[0], r.lang_pred, r.score) for r in got}
    assert all(by[i][1] == "en" for i in range(40)) and all(by[100 + i][1] == "fr" for i in range(40))
    assert {by[i][1:] for i in (300, 301, 302)} == {("und", 0.0)}
    assert by[303][1] == "en" and by[None][1] == "fr" and 0 <= by[304][2] <= 1
    assert language.predict(df.limit(0), model).collect() == []
    none = language.fit(df.filter("lang = 'xx'"))
    assert {r.lang_pred for r in language.predict(df, none).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op9_language_id"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_numbers_are_no_letters(spark):
    assert language.words_of("m² ① ½ Ⅷ x²y 3 Été") == ["m", "x", "y", "été"]
    df = spark.createDataFrame([(1, "² ①", "en", "x"), (2, "the", "en", "x")], SCHEMA)
    got = {r.doc_id: r.lang_pred for r in language.predict(df, language.fit(df)).collect()}
    assert got == {1: "und", 2: "en"}


def test_long_words_are_summed_whole(monkeypatch):
    ids = {p: i for i, p in enumerate(["▁a", "▁ab", "a", "b", "ab", "ba", "▁b", "bab"])}
    log_p = np.log(np.random.default_rng(3).dirichlet(np.ones(len(ids) + 1), 3).T)
    words = ["a", "ab", "xab", "axb", "b" * 30, "abxba" * 40, "ba" * 3000]
    whole = language.Lattice(words, ids).log_likelihood(log_p)
    for word, expected in zip(words, whole):
        assert language.long_likelihood(word, ids, log_p) == pytest.approx(expected)
    assert np.isfinite(whole).all() and (np.diff(whole[-1]) != 0).any()
    monkeypatch.setattr(language, "_PLACES", 100)
    again = np.empty_like(whole)
    for at, lattice in language.lattices(words, ids):
        again[at] = lattice.log_likelihood(log_p)
    assert again == pytest.approx(whole)
    counts = language.Lattice(["ab" * 2000], ids).expected(np.exp(log_p[:, 0]), np.ones(1))
    assert sum(len(p.strip("▁")) * counts[i] for p, i in ids.items()) + counts[-1] == pytest.approx(4000)
    assert language.words_of("x" * 100 + " y") == ["x" * 100, "y"]


def plain_probabilities(word, ids, p):
    """The sum over all segmentations of a word, and how often each piece is used in it."""
    total, used = 0.0, np.zeros(len(p))
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate((*cuts, 1)):
            if c:
                parts.append(("▁" if at == 0 else "") + word[at : i + 1])
                at = i + 1
        ps = [ids.get(x, len(ids) if len(x.lstrip("▁")) == 1 else None) for x in parts]
        if None not in ps:
            weight = math.prod(p[i] for i in ps)
            total += weight
            for i in ps:
                used[i] += weight
    return total, used


def test_fit_and_predict_equal_brute_force(spark, monkeypatch):
    ids = {p: i for i, p in enumerate(["▁a", "▁ab", "a", "b", "ab", "ba", "▁b", "c", "▁c"])}
    monkeypatch.setattr(language, "vocabulary", lambda path: ids)
    texts = {"x": ["ab abba ca", "aab ab"], "y": ["bb cbc b", "cab bz", "c c c"], "z": ["abc"]}
    rows = [(i, t, lang, "s") for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    df = spark.createDataFrame(rows, SCHEMA)
    langs, log_p, path = language.fit(df, rounds=2, background=0.1)
    p = np.full((len(ids) + 1, 3), 1 / (len(ids) + 1))
    for _ in range(2):
        counts = np.zeros_like(p)
        for k, lang in enumerate(sorted(texts)):
            for word in " ".join(texts[lang]).split():
                total, used = plain_probabilities(word, ids, p[:, k])
                counts[:, k] += used / total
        own = counts[:-1] / counts[:-1].sum(0)
        common = 0.9 * own.mean(1, keepdims=True) + 0.1 / len(ids)
        q = 0.9 * own + 0.1 * common
        p = np.vstack([q, np.full((1, 3), q.min())])
    assert langs == ["x", "y", "z"] and np.exp(log_p) == pytest.approx(p)
    asked = ["ab", "cb b", "zz", "abab ca", "q", ""]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(asked)], SCHEMA)
    language._SCORERS.clear()
    scorer = language.Scorer(log_p, ids)
    got, n = scorer.score(asked)
    for i, t in enumerate(asked):
        want = sum((np.log([plain_probabilities(w, ids, p[:, k])[0] for k in range(3)]) for w in t.split()), np.zeros(3))
        assert got[i] == pytest.approx(want)
    assert docs.count() == len(asked)


def test_unknown_scripts_are_nobodys(spark):
    rng = random.Random(5)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    rows = [(i, make(["the", "ing"], 80), "en", "x") for i in range(30)] + [(100 + i, make(["eau", "que"], 5), "fr", "x") for i in range(6)]
    df = spark.createDataFrame(rows + [(200, "字" * 400, None, "x"), (201, "жизнь", None, "x")], SCHEMA)
    got = {r.doc_id: r.score for r in language.predict(df, language.fit(df)).filter("doc_id >= 200").collect()}
    assert got[200] == pytest.approx(0.5, abs=0.2) and got[201] == pytest.approx(0.5, abs=0.3)


def test_the_sample_is_exact(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 10 = 0 THEN 'b' ELSE 'a' END AS lang", "cast(id as string) AS text", "xxhash64(id) AS pick")
    for n in (1, 40, 5000):
        got = {(r.lang, r.pick) for r in language._sample(rows, n).collect()}
        every = sorted((r.lang, r.pick) for r in rows.collect())
        want = {x for lang in "ab" for x in [e for e in every if e[0] == lang][:n]}
        assert got == want
