"""Token counts of sections: documents are encoded once, tokens attributed by their offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strataset.llm.tokens import byte_bpe

_LINE = re.compile(rb"[^\n]*\S[^\n]*")


def lines(raw: bytes) -> np.ndarray:
    """(first byte, byte after the last) of the lines that are not blank, in order. A line reaches
    to the start of the next one, the first from the start of the text; a text without such lines is
    one section."""
    starts = [m.start() for m in _LINE.finditer(raw)] or [0]
    starts[0] = 0
    return np.stack([starts, [*starts[1:], len(raw)]], 1)


def attribute(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray, rule: str) -> np.ndarray:
    """The span of each token, -1 for none. Both are in order and do not overlap.

    Rule `start`: the span that holds the token's first byte. Rule `most`: the span that holds most
    of its bytes, the earlier one of equals.
    """
    if not len(spans):
        return np.full(len(starts), -1)
    first = np.searchsorted(spans[:, 0], starts, "right") - 1
    inside = (first >= 0) & (starts < spans[np.maximum(first, 0), 1])
    owner = np.where(inside, first, -1)
    if rule == "most":
        last = np.searchsorted(spans[:, 0], ends - 1, "right") - 1
        for t in np.flatnonzero((last > first) | ~inside):
            reach = range(max(first[t], 0), last[t] + 1)
            shares = [(min(ends[t], spans[k, 1]) - max(starts[t], spans[k, 0]), -k) for k in reach]
            share, k = max(shares, default=(0, 0))
            owner[t] = -k if share > 0 else -1
    elif rule != "start":
        raise ValueError(f"unknown rule {rule}")
    return owner


def section_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans: Column | None = None,
    rule: str = "start", path: str | None = None,
) -> DataFrame:
    """(doc_id, section, char_start, char_end, n_tokens, doc_tokens): a row per section.

    `spans` is an array of (start, end) in code points, in order and not overlapping; without it the
    sections are the lines that are not blank and tile the text. A token that crosses a boundary
    counts once, by `rule` (see `attribute`); tokens outside all spans are a row with a null section.
    So a document's rows add up to its tokens. Null texts are empty ones, with one empty section and
    no tokens (none if `spans` is empty). One scan, no shuffle.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    given = spans is not None
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "section", "char_start", "char_end", "n_tokens", "doc_tokens"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            out: list[list] = [[] for _ in kinds]

            def add(doc_id, section, a, b, n, total):
                for column, values in zip(out, (np.full(len(n), doc_id, object), section, a, b, n, np.full(len(n), total))):
                    column.extend(values.tolist() if isinstance(values, np.ndarray) else values)

            for row, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                text = text.as_py() or ""
                raw = text.encode()
                ends = np.cumsum(bpe.n_bytes[bpe.encode(text)])
                starts = np.r_[0, ends[:-1]] if len(ends) else ends
                if given:
                    chars = np.array([tuple(s.values()) for s in batch.column(2)[row].as_py() or []], np.int64).reshape(-1, 2)
                    at = np.r_[np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw)]
                    where = at[np.clip(chars, 0, len(at) - 1)]
                else:
                    where = lines(raw)
                    chars = where
                    if len(raw) != len(text):
                        head = np.r_[0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]
                        chars = head[where]
                owner = attribute(starts, ends, where, rule)
                n = np.bincount(owner + 1, minlength=len(where) + 1)
                add(doc_id, range(len(where)), chars[:, 0], chars[:, 1], n[1:], len(ends))
                if n[0]:
                    add(doc_id, [None], [None], [None], n[:1], len(ends))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    if given:
        columns.append(spans.alias("spans"))
    return docs.select(*columns).mapInArrow(
        make, "doc_id long, section int, char_start long, char_end long, n_tokens long, doc_tokens long"
    )


def field_spans(*fields: Column, separator: str = "\n") -> tuple[Column, Column]:
    """(text, spans) of several fields joined by `separator`; null fields are empty spans."""
    texts = [F.coalesce(f, F.lit("")) for f in fields]
    spans, at = [], F.lit(0)
    for t in texts:
        end = at + F.length(t)
        spans.append(F.struct(at.cast("long").alias("start"), end.cast("long").alias("end")))
        at = end + len(separator)
    return F.concat_ws(separator, *texts), F.array(*spans)
