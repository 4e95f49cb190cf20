import json
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strataset.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "Hello, WORLD's  ends\n\tit'll 1234", "aaaa aaaaaaaaa aaa!!!???", "Straße İstanbul ΣΑΣ Σ naïve é",
         "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "日本語のテキスト 한국어 😀👍", "՘Ᲊ͸ x y\x1cz",
         "x" * 3000, "ab" * 2000, "\x00\x7f\xa0　"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_table_equals_the_library(spark, library):
    own = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = TEXTS + own
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a", "x", 1)] * 2,
                               "doc_id long, text string, ids string, decoded int")
    coded = bpe.encode(df)
    found = coded.collect()
    assert len(found) == len(texts) + 2
    for r in found:
        assert (r.ids, r.decoded) == expected(library, "a" if r.doc_id is None else texts[r.doc_id])
    back = {r.doc_id: r.decoded for r in bpe.decode(coded).collect()}
    assert all(back[r.doc_id] == r.decoded for r in found)
    assert bpe.encode(df.limit(0)).count() == 0


def test_every_character_equals_the_library(library):
    coder = bpe.WordBpe(PATH)
    chars = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}B " for c in chars[k : k + 64]) for k in range(0, len(chars), 64)]
    offsets, ids = coder.encode(texts)
    whole = library.encode_batch(texts, add_special_tokens=False)
    for i, found in enumerate(whole):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == found.ids, texts[i]


def test_random_texts_equal_the_library(library):
    coder, pick = bpe.WordBpe(PATH), random.Random(5)
    alphabet = "aabcdehilnorst  '..,!?019ñéß\n\t日€"
    texts = ["".join(pick.choices(alphabet, k=pick.randrange(200))) for _ in range(3000)]
    offsets, ids = coder.encode(texts)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


def test_merges_that_form_a_pair_of_lower_rank(tmp_path, library):
    # (ab, c) ranks before (a, b): what is merged at one place decides the next.
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    single = [t for t in spec["model"]["vocab"] if len(t.replace("</w>", "")) == 1]
    extra = ["ab", "abc", "abc</w>", "ca", "cab", "bc", "ab</w>"]
    merges = [["ab", "c"], ["ab", "c</w>"], ["b", "c"], ["a", "b"], ["c", "a"], ["ca", "b"], ["a", "b</w>"]]
    spec["model"]["vocab"] = {t: i for i, t in enumerate(single + extra)}
    spec["model"]["merges"] = merges
    for t in spec["added_tokens"]:
        t["id"] = len(single) + len(extra) + (t["content"] == "<|endoftext|>")
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    small, coder, pick = Tokenizer.from_file(str(path)), bpe.WordBpe(str(path)), random.Random(1)
    assert coder._alone.any()
    texts = ["".join(pick.choices("abc", k=pick.randrange(1, 30))) for _ in range(500)]
    offsets, ids = coder.encode(texts)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == small.encode(t, add_special_tokens=False).ids


def test_cache_is_cleared(monkeypatch, library):
    monkeypatch.setattr(bpe, "_CACHED", 5)
    coder = bpe.WordBpe(PATH)
    for text in ["one two three four", "five six seven", "one nine <|endoftext|>"]:
        offsets, ids = coder.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(coder._slot) < 12


def test_long_word(library):
    word = "".join(random.Random(2).choices("abcdefghij", k=50_000))
    start = time.perf_counter()
    _, ids = bpe.WordBpe(PATH).encode([word])
    assert ids.tolist() == library.encode(word, add_special_tokens=False).ids
    assert time.perf_counter() - start < 60
    assert np.issubdtype(ids.dtype, np.integer)
