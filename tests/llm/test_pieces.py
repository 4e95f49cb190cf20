import struct

import public_tokenizers
import sentencepiece

from strataset.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, n_ids int"
TEXTS = [None, "", " ", "  a   b ", "▁x", "a▁▁b", "\x00\t\n\r", "日本語 😀 <s> </s> <unk> <0x41>", "Straße naïve", "x" * 5000,
         "the the the\nthe", "tail  "]


def numbers(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def varint(n):
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_ids_and_texts_equal_the_reference_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = TEXTS + own
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a", "x", 1)] * 2, SCHEMA)
    rows = pieces.encode(df).collect()
    assert len(rows) == len(texts) + 2 and all(r.parity for r in rows)
    for r in rows:
        text = "a" if r.doc_id is None else texts[r.doc_id] or ""
        assert numbers(r.ids) == library.encode(text) and r.n_ids == len(r.ids) // 4
        assert r.decoded == library.decode(library.encode(text))


def test_words_and_whole_texts_agree():
    coder = pieces.Pieces(PATH)
    for text in TEXTS[1:]:
        assert numbers(coder.encode([text])[0][0]) == coder.whole.encode(text, add_special_tokens=False).ids
        assert coder.decode(coder.encode([text])[0][0]) == coder.whole.decode(coder.whole.encode(text).ids, skip_special_tokens=False)


def test_unigram_model_with_collapsed_spaces(tmp_path):
    scored = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁the", -2.0, 1), ("▁th", -3.0, 1), ("e", -4.0, 1),
              ("▁", -5.0, 1), ("t", -5.5, 1), ("h", -5.6, 1), ("he", -3.5, 1), ("re", -3.7, 1), ("r", -6.0, 1)]
    scored += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    raw = b"".join(message((1, message((1, p.encode()), (2, s), (3, t)))) for p, s, t in scored)
    raw += message((2, message((3, 1), (35, 1)))) + message((3, message((3, 1), (4, 1), (5, 1))))
    path = tmp_path / "small.model"
    path.write_bytes(raw)
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    coder = pieces.Pieces(str(path), reference=True)
    assert coder.model.kind == 1 and coder.model.byte_fallback
    for text in ["the there", "  the   re ", "", "thé h", "e r e t h", "the x the"]:
        (ids,), (same,) = coder.encode([text])
        assert numbers(ids) == library.encode(text) and same
        assert coder.decode(ids) == library.decode(library.encode(text))


def test_empty_table(spark):
    assert pieces.encode(spark.createDataFrame([], SCHEMA)).collect() == []
