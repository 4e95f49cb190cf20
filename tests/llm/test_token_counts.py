import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataset.llm import token_counts

SCHEMA = "doc_id long, text string, section string, spans int"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(text):
    """Sections and their tokens, by the library's own offsets."""
    text = text or ""
    starts, at = [], 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            starts.append(at)
        at += len(line) + 1
    starts = starts or [0]
    starts[0] = 0
    found = LIBRARY.encode(text, add_special_tokens=False)
    counts, seen = [0] * len(starts), 0
    raw_at = np.cumsum([0] + [len(c.encode()) for c in text])
    from strataset.llm.tokens import byte_bpe

    sizes = byte_bpe(public_tokenizers.path("byte_bpe_50k.json")).n_bytes
    for i in found.ids:
        char = int(np.searchsorted(raw_at, seen, "right")) - 1
        counts[max(k for k, s in enumerate(starts) if s <= char)] += 1
        seen += int(sizes[i])
    return [(k, a, b, n) for k, (a, b, n) in enumerate(zip(starts, [*starts[1:], len(text)], counts))]


def corpus():
    rng = random.Random(2)
    parts = ["word", "Über", "\n", "\n\n", " \n ", "  ", "😀😀", "x.\n\ny", "\r\n", "日本"]
    return [None, "", "\n", " \n \n", "one\ntwo", "\n\nlead", "tail\n\n"] + [
        "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 300))) for _ in range(80)
    ]


def test_lines_equal_the_librarys_offsets(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a\nb", "x", 1)] * 2, SCHEMA)
    got = {}
    for r in token_counts.section_tokens(df).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.char_start, r.char_end, r.n_tokens))
        assert r.n_tokens >= 0
    assert len(got.pop(None)) == 4
    for i, text in enumerate(texts):
        assert sorted(got[i]) == plain(text), repr(text)


def test_fields_and_rules(spark):
    rows = [("user", "hello there"), (None, "x y z"), ("é", None), ("", "")]
    df = spark.createDataFrame(rows, "role string, body string").withColumn("doc_id", F.monotonically_increasing_id())
    text, spans = token_counts.field_spans(F.col("role"), F.col("body"), separator="")
    df = df.withColumn("text", text)
    for rule in ("start", "most"):
        got = token_counts.section_tokens(df, spans=spans, rule=rule).collect()
        for doc in {r.doc_id for r in got}:
            own = [r for r in got if r.doc_id == doc]
            assert sum(r.n_tokens for r in own) == own[0].doc_tokens
    gap = df.select("doc_id", F.lit("ab cd ef").alias("text"))
    one = token_counts.section_tokens(gap, spans=F.array(F.struct(F.lit(3).alias("a"), F.lit(5).alias("b"))), rule="most")
    assert {(r.section, r.n_tokens) for r in one.collect()} == {(0, 1), (None, len(LIBRARY.encode("ab cd ef").ids) - 1)}


def test_attribution_equals_plain_search():
    rng = np.random.default_rng(4)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 5, 30))
        starts = np.r_[0, ends[:-1]]
        cuts = np.unique(rng.integers(0, ends[-1], 8))
        spans = np.stack([cuts[:-1], np.minimum(cuts[1:], cuts[:-1] + rng.integers(1, 9, len(cuts) - 1))], 1)
        if not len(spans):
            continue
        for rule in ("start", "most"):
            got = token_counts.attribute(starts, ends, spans, rule)
            for t in range(30):
                if rule == "start":
                    want = [k for k, (a, b) in enumerate(spans) if a <= starts[t] < b]
                else:
                    share = [(min(ends[t], b) - max(starts[t], a), -k) for k, (a, b) in enumerate(spans)]
                    want = [-k for s, k in [max(share)] if s > 0]
                assert got[t] == (want[0] if want else -1)


def test_empty_table(spark):
    assert token_counts.section_tokens(spark.createDataFrame([], SCHEMA)).collect() == []
