import random

import corpus_pipeline
import __spark_entry__ as contract
from tests.llm.brute import closure
from tests.llm.test_packing import check
from tests.llm.test_repeats import brute
from tests.llm.test_similar import alike, shingles

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(9)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    shared = make(["the", "ing", "er"], 60)
    rows = []
    for i in range(80):
        lang, parts = rng.choice([("en", ["the", "ing", "er", "wh"]), ("fr", ["eau", "que", "é", "le"])])
        text = make(parts, rng.randint(5, 200))
        if i % 9 == 0:
            text += " " + shared + " " + make(parts, 20)
        rows.append((i, text, lang, "s", len(text)))
    rows += [(100 + i, rows[i][1], "en", "s", 1) for i in range(10)]
    rows += [(120 + i, rows[i][1] + " tail", "en", "s", 1) for i in range(10, 40)]
    rows += [(200, None, "en", "s", 0), (201, "", None, "s", 0), (202, "123 %", "en", "s", 5), (203, "le que", "fr", None, 6)]
    rng.shuffle(rows)
    return rows


def text_of(raw):
    return raw.decode("utf-8", "ignore")


def test_stages_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    first = STAGES["language"](spark, docs, "").collect()
    assert {r.doc_id for r in first} == {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    docs = spark.createDataFrame(first, SCHEMA)
    second = STAGES["near_duplicates"](spark, docs, "").collect()
    sets = {r.doc_id: shingles(r.text) for r in first}
    ids = sorted(sets)
    joined = closure(ids, [(a, b) for a in ids for b in ids if a < b and alike(sets[a], sets[b])])
    assert len(set(joined.values())) < len(ids) - 20
    assert sorted(r.doc_id for r in second) == sorted(set(joined.values()))
    docs = spark.createDataFrame(second, SCHEMA)
    third = STAGES["repeated_passages"](spark, docs, "").collect()
    want = {r.doc_id: k for r, (k, _, _) in zip(second, brute([(r.doc_id, r.text) for r in second]))}
    assert {r.doc_id: r.text for r in third} == {i: text_of(k) for i, k in want.items() if text_of(k)}
    assert all(r.n_chars == len(r.text) for r in third if r.text != next(s.text for s in second if s.doc_id == r.doc_id))
    texts = {r.doc_id: r.text for r in third}
    packed = STAGES["packing"](spark, spark.createDataFrame(third, SCHEMA), "").collect()
    assert {r.doc_id for r in packed} == set(texts)
    again = {i: k for k, i in enumerate(sorted(texts))}
    from types import SimpleNamespace

    moved = [SimpleNamespace(**{**r.asDict(), "doc_id": again[r.doc_id]}) for r in packed]
    assert check(moved, [texts[i] for i in sorted(texts)]) > 0.8


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "le que eau", "fr", "s", 1)] * 3 + [(4, "le que eau", "fr", "s", 1)] * 3 + [(None, "other words here", None, None, None)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = STAGES["near_duplicates"](spark, docs, "").collect()
    assert sorted(map(str, (r.doc_id for r in kept))) == ["4", "None"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").collect() == []
        assert stage(spark, docs, "").count() > 0


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]


def test_run_is_registered(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(got) > 100 and {r.doc_id for r in got} <= set(range(200))


def linked_by_bits_only():
    """Texts of which some have a few repeated lines in common, that weigh in their fingerprints but count
    once in their sets; and, of one set, texts whose repeats differ, which are linked to unlike others."""
    rng = random.Random(5)
    make = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    line, a, b = make(41), make(60), make(60)
    texts = [make(80) for _ in range(5)]
    texts += [" ".join([line] * 400 + [a]), " ".join([line] * 400 + [b])]  # alike by bits, not by sets
    c = make(50)
    texts += [c + " x" * 8, c + " x" * 4000, make(50) + " x" * 4000]  # two of one set, the last one like the second
    return texts


def test_near_copies_by_fingerprint_go_as_those_by_shingles(spark):
    # Links of op3 join as well, between the texts of all rows and not only between those that stand for a set.
    from strataset.llm import simhash

    texts = linked_by_bits_only()
    sets = [shingles(t) for t in texts]
    bits = [simhash.fingerprint(t) for t in texts]
    n = range(len(texts))
    by_sets = [(i, j) for i in n for j in range(i) if alike(sets[i], sets[j])]
    by_bits = [(i, j) for i in n for j in range(i) if (bits[i] ^ bits[j]).bit_count() <= 4]
    want = closure(n, by_sets + by_bits)
    assert set(by_bits) == {(6, 5), (9, 8)} and by_sets == [(8, 7)] and sets[7] == sets[8]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in STAGES["near_duplicates"](spark, docs, "").collect()) == sorted(set(want.values()))
