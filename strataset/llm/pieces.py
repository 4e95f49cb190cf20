"""SentencePiece models on the `tokenizers` library: encoding and decoding of whole columns."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
_CACHED = 300_000  # words whose ids a worker keeps at most; then it starts anew


# ---- the model file ------------------------------------------------------------------------------


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out
            shift += 7

    while at < len(raw):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        elif wire in (1, 5):
            n = 8 if wire == 1 else 4
            yield key >> 3, raw[at : at + n]
            at += n
        elif wire == 2:
            n = number()
            yield key >> 3, raw[at : at + n]
            at += n
        else:
            raise ValueError(f"wire type {wire} in a model file")


@dataclass
class Model:
    """What a model file says; field numbers are those of the public schema."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = 1  # 1 unigram, 2 BPE
    byte_fallback: bool = False
    unknown_surface: str = " ⁇ "
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, raw: bytes) -> Model:
        out = cls()
        for number, value in _fields(raw):
            if number == 1:
                piece = {n: v for n, v in _fields(value)}
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = {n: v for n, v in _fields(value)}
                out.kind = trainer.get(3, 1)
                out.suffix = bool(trainer.get(24, 0))
                out.byte_fallback = bool(trainer.get(35, 0))
                if 44 in trainer:
                    out.unknown_surface = trainer[44].decode()
            elif number == 3:
                rules = {n: v for n, v in _fields(value)}
                out.charsmap = rules.get(2, b"")
                out.dummy_prefix, out.collapse, out.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        return out


# ---- the backend ---------------------------------------------------------------------------------


def backend(model: Model):
    """A `tokenizers.Tokenizer` that encodes and decodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.suffix or not model.escape:
        raise ValueError("models with suffix marks or unescaped spaces are not supported")
    unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == 1:
        # Pieces that are never produced get a score that no path takes.
        scored = [(p, s if t in (NORMAL, USER) else -1e9) for p, s, t in model.pieces]
        core = models.Unigram(scored, unknown, model.byte_fallback)
    elif model.kind == 2:
        ids = {p: i for i, (p, _, t) in enumerate(model.pieces)}
        usable = {p: s for p, s, t in model.pieces if t in (NORMAL, USER)}
        merges = sorted(
            (-score, ids[p[:k]], ids[p[k:]], p[:k], p[k:])
            for p, score in usable.items()
            for k in range(1, len(p))
            if p[:k] in usable and p[k:] in usable
        )
        core = models.BPE(
            ids, [(a, b) for *_, a, b in merges], unk_token=model.pieces[unknown][0],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models are supported")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.collapse:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(back)
    return out


class Pieces:
    """Encodes and decodes texts; ids of words are kept while they last.

    Merges and segmentations never cross the place before a mark unless a piece has a mark after
    another character, so ids of a text are those of its words. Words that are new in a batch go to
    the backend together, which encodes them in several threads. With `reference`, each new word is
    also encoded by the sentencepiece library, and the words on which they differ are remembered.
    """

    def __init__(self, path: str, reference: bool = False) -> None:
        with open(path, "rb") as f:
            self.model = Model.parse(f.read())
        self.whole = backend(self.model)
        self._words = backend(self.model)
        self._words.normalizer = None
        crossing = any(MARK in p.lstrip(MARK) for p, _, t in self.model.pieces if t in (NORMAL, USER))
        self._cut = re.compile(r"(?s).+" if crossing else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self._ids: dict[str, bytes] = {}
        self._other: set[str] = set()
        self._bytes = [self._surface(p, t) for p, _, t in self.model.pieces]
        # Only replacing spaces, as most models without a table do, needs no pass through the library.
        self._plain = not self.model.charsmap and not self.model.collapse and self.model.dummy_prefix
        self._reference = None
        if reference:
            import sentencepiece

            self._reference = sentencepiece.SentencePieceProcessor(model_file=path)

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (self.model.unknown_surface if kind == UNKNOWN else piece.replace(MARK, " ")).encode()

    def normalised(self, text: str) -> str:
        if not text:
            return ""
        if self._plain:
            return MARK + text.replace(" ", MARK)
        return self.whole.normalizer.normalize_str(text)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Per text its ids, as little-endian 32-bit numbers, and whether the reference agrees."""
        words = [self._cut.findall(self.normalised(t)) for t in texts]
        if len(self._ids) > _CACHED:
            self._ids.clear()
            self._other.clear()
        known = self._ids
        new = list({w: None for ws in words for w in ws if w not in known})
        for a in range(0, len(new), 50_000):
            part = new[a : a + 50_000]
            for word, found in zip(part, self._words.encode_batch_fast(part, add_special_tokens=False)):
                known[word] = struct.pack(f"<{len(found.ids)}I", *found.ids)
            if self._reference is not None:
                plain = [w.replace(MARK, " ")[1:] if w.startswith(MARK) else None for w in part]
                for word, text in zip(part, plain):
                    if text is not None and not self._agrees(word, text):
                        self._other.add(word)
        get, other = known.__getitem__, self._other
        return [b"".join(map(get, ws)) for ws in words], [
            not other or other.isdisjoint(ws) for ws in words
        ]

    def _agrees(self, word: str, text: str) -> bool:
        # A lone mark is a space in a text; the library would drop an empty text.
        got = list(struct.unpack(f"<{len(self._ids[word]) // 4}I", self._ids[word]))
        return not text or self._reference.encode(text) == got

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        surface = self._bytes
        raw = b"".join([surface[i] for i in memoryview(ids).cast("I")])
        if self.model.dummy_prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(2)
def pieces_of(path: str, threads: int, reference: bool) -> Pieces:
    """One encoder per Python worker, with as many threads as a task may use."""
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    return Pieces(path, reference)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    threads: int = 2, verify: bool = True,
) -> DataFrame:
    """(doc_id, ids, n_ids, decoded, parity): ids as little-endian 32-bit numbers, the text decoded
    from them, and whether the sentencepiece library gives the same ids (null without `verify`).

    Null and empty texts have no ids and decode to an empty text. One scan, no shuffle.
    """
    path = path or public_tokenizers.path(MODEL)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces_of(path, threads, verify)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                ids, same = coder.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([coder.decode(x) for x in ids], pa.string()),
                     pa.array(same if verify else [None] * len(ids), pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "decoded", "parity"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        make, "doc_id long, ids binary, n_ids long, decoded string, parity boolean"
    )
