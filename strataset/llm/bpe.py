"""Byte-pair encoding with word ends, by rounds of merges over one flat array of symbols."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from strataset.llm.tokens import _byte_letters

VOCABULARY = "word_bpe_49k.json"
_CACHED = 200_000  # stretches whose ids a worker keeps
_CHUNK = 1 << 22  # characters of text that are encoded together
_NONE = np.iinfo(np.int32).max

# Characters on whose class and case all Unicode versions agree; other texts are cut into words by
# the library's own normaliser and splitter.
_SETTLED = regex.compile(r"[\x00-\x1b\x20-ԯ‐-‧ぁ-ゖァ-ヺ一-龥가-힣]*")


class WordBpe:
    """Encoder and decoder read from a `tokenizers` file of byte-level BPE with a word-end suffix.

    The lowest-rank pair of a word is merged wherever it occurs before the next pair is looked for.
    That equals merging one place at a time if no merge can form a pair of lower rank than its own;
    pairs for which that does not hold are merged at their first place only.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        plain = not any(model[k] for k in ("unk_token", "dropout", "continuing_subword_prefix", "ignore_merges"))
        kept = all(
            t["special"] and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"])
            for t in spec["added_tokens"]
        )
        if model["type"] != "BPE" or not plain or not kept or spec["post_processor"] or spec["decoder"]:
            raise ValueError("only plain byte-level BPE with special added tokens is supported")
        vocab = model["vocab"]
        self._library = Tokenizer.from_file(path)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._cut = regex.compile(split)
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._specials = re.compile(f"({'|'.join(names)})") if names else None
        self._byte_of = letters = _byte_letters()
        size = max([*vocab.values(), *self._special.values()]) + 1
        self._inner, self._last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for letter, b in letters.items():
            self._inner[b], self._last[b] = vocab[letter], vocab[letter + end]
        self.tokens = np.full(size, "", object)
        for token, i in [*vocab.items(), *self._special.items()]:
            self.tokens[i] = token
        self._tokens = pa.array(self.tokens, pa.string())

        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        left, right, made = np.array(pairs, np.int64).reshape(-1, 3).T
        order = np.argsort(left * size + right)
        self._size = size
        self._keys = (left * size + right)[order]
        self._ranks = order.astype(np.int32)
        self._made = made.astype(np.int32)
        first = np.full(size, _NONE, np.int64)  # the lowest rank of a pair that a symbol is part of
        np.minimum.at(first, left, np.arange(len(pairs)))
        np.minimum.at(first, right, np.arange(len(pairs)))
        self._alone = first[made] < np.arange(len(pairs))
        self._clear()

    def _clear(self) -> None:
        self._slot: dict[str | tuple[str] | bytes, int] = {name.encode(): k for k, name in enumerate(self._special)}
        self._ids = np.array(list(self._special.values()), np.int32)
        self._lengths = np.ones(len(self._special), np.int64)

    # ---- texts to stretches without white space, which words never cross ----

    def _segment(self, text: str) -> list[str | tuple[str]]:
        if _SETTLED.fullmatch(text):
            # Characters are lower-cased one by one, so a final sigma is no special case.
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().split()
        spelled = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [(bytes(map(self._byte_of.__getitem__, word)).decode(),) for word, _ in spelled]

    def stretches(self, text: str) -> list[str | tuple[str] | bytes]:
        """Parts of a text in order: stretches still to be cut into words, words, each in a tuple, and
        special tokens as bytes."""
        if self._specials is None or not self._specials.search(text):
            return self._segment(text)
        parts = self._specials.split(text)
        found: list[str | tuple[str] | bytes] = []
        for k, part in enumerate(parts):
            found += [part.encode()] if k % 2 else self._segment(part)
        return found

    # ---- words to ids ----

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self._size + right
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._ranks[at], _NONE).astype(np.int32)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and the word of each; `word` ascends and no word is empty."""
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), _NONE, np.int32)
        if len(symbols) > 1 and len(self._keys):
            rank[:-1] = np.where(word[1:] == word[:-1], self._rank(symbols[:-1], symbols[1:]), _NONE)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(word)])
            least = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            open_ = least < _NONE
            if not open_.all():
                finished.append((word[~open_], symbols[~open_]))
                word, symbols, rank, least = word[open_], symbols[open_], rank[open_], least[open_]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == least)
            # Of overlapping places, which have three equal symbols, every other one from the left.
            run = np.r_[True, np.diff(at) != 1]
            begun = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            chosen = (np.arange(len(at)) - begun) % 2 == 0
            if self._alone[rank[at]].any():
                chosen &= np.r_[True, word[at][1:] != word[at][:-1]] | ~self._alone[rank[at]]
            at = at[chosen]
            symbols[at] = self._made[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            now = at - np.arange(len(at))  # each earlier merge took one symbol away
            word, symbols, rank = word[stay], symbols[stay], rank[stay]
            changed = np.zeros(len(symbols), bool)
            changed[now] = True
            changed[now[now > 0] - 1] = True
            touched = np.flatnonzero(changed)
            after = np.minimum(touched + 1, len(symbols) - 1)
            joined = (after > touched) & (word[after] == word[touched])
            rank[touched] = np.where(joined, self._rank(symbols[touched], symbols[after]), _NONE)
        if not finished:
            return symbols, word
        owner = np.concatenate([w for w, _ in finished])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([s for _, s in finished])[order], owner[order]

    def _learn(self, new: list[str | tuple[str]]) -> None:
        words = [self._cut.findall(x) if isinstance(x, str) else x for x in new]
        owner = np.repeat(np.arange(len(new)), np.fromiter(map(len, words), np.int64, len(words)))
        raw = [w.encode() for w in chain.from_iterable(words)]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self._inner[flat]
        last = np.cumsum(lengths) - 1
        symbols[last] = self._last[flat[last]]
        symbols, word = self.merge(symbols, np.repeat(np.arange(len(raw)), lengths))
        at = len(self._slot)
        self._slot.update(zip(new, range(at, at + len(new))))
        self._ids = np.concatenate([self._ids, symbols])
        self._lengths = np.concatenate([self._lengths, np.bincount(owner[word], minlength=len(new))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of all texts: text i has ids[offsets[i]:offsets[i + 1]]."""
        parts = [self.stretches(t) for t in texts]
        if len(self._slot) > _CACHED:
            self._clear()
        known = self._slot
        new = [x for x in set(chain.from_iterable(parts)) if x not in known]
        if new:
            self._learn(new)
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        slots = np.array(list(map(known.__getitem__, chain.from_iterable(parts))), np.int64)
        lengths = self._lengths[slots]
        begin = np.r_[0, np.cumsum(self._lengths)][slots]
        ends = np.cumsum(lengths)
        ids = self._ids[np.arange(int(lengths.sum())) + np.repeat(begin - (ends - lengths), lengths)]
        return np.r_[0, np.r_[0, ends][np.cumsum(counts)]], ids

    # ---- ids to texts ----

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """Per text its tokens joined by a space, as the library does for files without a decoder."""
        spelled = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self._tokens.take(pa.array(ids)))
        return pc.binary_join(spelled, " ")


@lru_cache(2)
def word_bpe(path: str) -> WordBpe:
    """One encoder per Python worker."""
    return WordBpe(path)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `_CHUNK` characters, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= _CHUNK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every whole text and the text decoded from them.

    Null and empty texts have no ids and decode to an empty text; repeated rows and null ids give a
    row each; other columns, whatever their names, play no part; an empty table gives no rows. A text
    is held with its ids while it is encoded, other texts join it up to a bounded size. One scan, no
    shuffle.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                offsets, ids = coder.encode(texts[a:b])
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), listed, coder.decode(offsets, ids)],
                    names=["doc_id", "ids", "decoded"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        make, "doc_id long, ids array<int>, decoded string"
    )


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, decoded): the text of each list of ids; null and empty lists give an empty text.

    Ids outside the vocabulary are left out, as the library does. One scan, no shuffle.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe(path)
        known = coder.tokens != ""
        for batch in batches:
            lists = [np.array([i for i in x or [] if i is not None and 0 <= i < len(known) and known[i]], np.int32)
                     for x in batch.column(1).to_pylist()]
            offsets = np.r_[0, np.cumsum([len(x) for x in lists], dtype=np.int64)]
            text = coder.decode(offsets, np.concatenate(lists) if lists else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["doc_id", "decoded"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        make, "doc_id long, decoded string"
    )
