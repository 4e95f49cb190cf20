"""Removal of repeated passages by a depth-limited radix sort of suffixes.

A suffix is looked at through its first `depth` bytes, its window. The passes go from the most
significant digit on, and only suffixes whose digits so far also start another document's suffix
stay:

1. The first digit is the smallest hash of the window's 18-byte grams. It is a function of the
   window, so equal windows share it, and neighbouring windows mostly have the same one: a run of
   some 17 suffixes is sorted as one item. Only the digits are shuffled, and each part of the
   corpus learns which of its digits other documents have too.
2. Runs with a shared digit are sent to the bucket of their digit, each distinct one once per part.
3. In a bucket, windows are sorted by digits of eight bytes, as far as their group still has
   members; the groups left at the full depth are exactly the repeated windows.

A digit that very many parts share would make a large bucket (the edges of a passage that many
documents have differ in each). Its runs are taken apart and its windows sent on by a hash of all
their bytes, so equal windows still meet, and different ones spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from strataset.llm.streams import text_bytes, total

GRAM = 18
_PART = 2 << 20  # bytes of text that are looked at together
_BLOCK = 1 << 18  # windows hashed at once
_LONGEST_RUN = 64
_DIGITS = 8 << 20  # text bytes per bucket of first digits: about 4 MB of digits
_RUNS = 4 << 20  # text bytes per bucket of runs
_HOT = 1024  # parts that share a digit beyond which its windows are spread
_DIGIT_BYTES = 5  # of a digit inside its bucket; of half a million there, one in 10^6 matches by chance
_LAST = (1 << 63) - 1  # stands for a null id: no id is smaller than another because of it

_DIGIT_BITS = np.uint64(8 * _DIGIT_BYTES)
_DIGIT = np.uint64((1 << 8 * _DIGIT_BYTES) - 1)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def _grams(raw: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k bytes, built from runs of twice the length at a time."""
    power = (raw.astype(np.uint64) + np.uint64(1)) * _M1
    power ^= power >> np.uint64(32)
    length, out, done = 1, None, 0
    while True:
        if k & length:
            if out is None:
                out, done = power, length
            else:
                n = len(raw) - done - length + 1
                out = _mixed(out[:n] * _M1 + power[done : done + n])
                done += length
        if done == k:
            return _mixed(out * _M1)
        n = len(power) - length
        power = _mixed(power[:n] * _M1 + power[length:])
        length *= 2


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Part:
    """The texts of one part, end to end, and their runs of windows with one first digit."""

    def __init__(self, table: pa.Table, depth: int, buckets: int) -> None:
        self.depth = depth
        self.ids = np.array([_LAST if i is None else i for i in table.column("__id").to_pylist()], np.int64)
        texts = [(t or "").encode() for t in table.column("__text").to_pylist()]
        self.raw = b"".join(texts)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.r_[np.int64(0), self.ends[:-1]]
        whole = np.frombuffer(self.raw, np.uint8)
        edge = np.zeros(len(whole) + 1, np.int8)
        long = self.ends - self.starts >= depth
        edge[self.starts[long]] += 1
        edge[self.ends[long] - depth + 1] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        first = np.zeros(len(whole), bool)
        first[self.starts[long]] = True
        at, digit, size = [], [], []
        for a in range(0, max(0, len(whole) - depth + 1), _BLOCK):
            b = min(a + _BLOCK, len(whole) - depth + 1)
            if not inside[a:b].any():
                continue
            low = _least(_grams(whole[a : b + depth - 1], GRAM), depth - GRAM + 1)
            new = first[a:b].copy()
            new[0] = True
            new[1:] |= (low[1:] != low[:-1]) | (inside[a + 1 : b] != inside[a : b - 1])
            start = np.flatnonzero(new)
            length = np.diff(np.r_[start, b - a])
            keep = inside[a + start]
            start, length = start[keep], length[keep]
            if len(length) and length.max() > _LONGEST_RUN:
                cuts = -(-length // _LONGEST_RUN)
                nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start, rest = np.repeat(start, cuts) + nth * _LONGEST_RUN, np.repeat(length, cuts) - nth * _LONGEST_RUN
                length = np.minimum(rest, _LONGEST_RUN)
            at.append(start + a)
            size.append(length)
            whole_digit = _mixed(low[start] * _M1)
            bucket = (whole_digit >> _DIGIT_BITS) % np.uint64(buckets)
            digit.append((bucket << _DIGIT_BITS | whole_digit & _DIGIT) & ~np.uint64(1))
        empty = np.zeros(0, np.int64)
        self.at, self.size = (np.concatenate(x) if x else empty for x in (at, size))
        self.digit = np.concatenate(digit) if digit else np.zeros(0, np.uint64)
        self.doc = np.searchsorted(self.ends, self.at, "right")

    def digits(self) -> np.ndarray:
        """Its distinct first digits, in order; the last bit is set if several documents have it."""
        ids = self.ids[self.doc]
        order = np.lexsort((ids, self.digit))
        digit, ids = self.digit[order], ids[order]
        begin = np.flatnonzero(np.r_[True, digit[1:] != digit[:-1]][: len(digit)])
        if not len(begin):
            return digit
        end = np.r_[begin[1:], len(digit)] - 1
        return digit[begin] | (ids[begin] != ids[end]).astype(np.uint64)


def _pack(values: np.ndarray | bytes) -> bytes:
    """Runs and their places on the way to their bucket: shuffled columns are compressed here, as
    texts and small numbers take half the space that the shuffle's own codec leaves them."""
    return zstandard.compress(values if isinstance(values, bytes) else values.tobytes(), 1)


def _pack_digits(digits: np.ndarray) -> bytes:
    """Digits byte by byte, the lowest bytes of all first: sorted ones then compress to half."""
    return _pack(np.ascontiguousarray(digits.view(np.uint8).reshape(-1, 8)[:, :_DIGIT_BYTES].T))


def _unpack_digits(packed: bytes, bucket: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(_DIGIT_BYTES, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :_DIGIT_BYTES] = planes.T
    return out.view(np.uint64).reshape(-1) | np.uint64(bucket) << _DIGIT_BITS


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indexes of its items)."""
    own = bucket.astype(np.int64)
    order = np.argsort(own, kind="stable")
    cut = np.flatnonzero(np.diff(own[order])) + 1
    for group in np.split(order, cut):
        if len(group):
            yield int(own[group[0]]), group


def _shared(table: pa.Table) -> pa.Table:
    """Which digits of a bucket several documents have; the last bit is set if very many parts do."""
    bucket = table.column("bucket")[0].as_py()
    parts = [_unpack_digits(x, bucket) for x in table.column("digits").to_pylist()]
    marked = np.concatenate(parts)
    value = marked & ~np.uint64(1)
    order = np.argsort(value, kind="stable")
    begin = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]])
    count = np.diff(np.r_[begin, len(value)])
    several = np.logical_or.reduceat((marked & np.uint64(1)).astype(bool)[order], begin)
    keep = several | (count > 1)
    known = value[order][begin][keep]
    hot = (count[keep] > _HOT).astype(np.uint64)
    chunks, found = [], []
    for chunk, digits in zip(table.column("chunk").to_pylist(), parts):
        digits = digits & ~np.uint64(1)
        at = np.searchsorted(known, digits)
        at[at == len(known)] = 0
        hit = known[at] == digits if len(known) else np.zeros(len(digits), bool)
        if hit.any():
            chunks.append(chunk)
            found.append(_pack_digits((known[at] | hot[at])[hit]))
    return pa.table(
        [pa.array(chunks, pa.int64()), pa.array([bucket] * len(chunks), pa.int64()), pa.array(found, pa.binary())],
        names=["chunk", "bucket", "found"],
    )


def _send(part: Part, found: np.ndarray, buckets: int, chunk: int) -> pa.Table:
    """The distinct runs of a part that have a shared digit, dealt into buckets, with their places."""
    found = np.sort(found)
    known = found & ~np.uint64(1)
    at = np.searchsorted(known, part.digit)
    at[at == len(known)] = 0
    hit = known[at] == part.digit if len(known) else np.zeros(len(part.digit), bool)
    hot = (found[at] & np.uint64(1)).astype(bool) & hit if len(known) else hit
    plain = np.flatnonzero(hit & ~hot)
    each = part.size[hot]
    single = np.repeat(part.at[hot], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    start = np.r_[part.at[plain], single]
    size = np.r_[part.size[plain], np.ones(len(single), np.int64)] + part.depth - 1
    digit = np.r_[part.digit[plain], np.zeros(len(single), np.uint64)]
    doc = np.searchsorted(part.ends, start, "right")
    # In order of ids, so that the first place of a run is that of its smallest document.
    order = np.lexsort((start, part.ids[doc]))
    start, size, digit, doc = start[order], size[order], digit[order], doc[order]
    raw, entries = part.raw, {}
    entry = np.fromiter(
        (entries.setdefault(raw[a:b], len(entries)) for a, b in zip(start.tolist(), (start + size).tolist())),
        np.int64, len(start),
    )
    first = np.flatnonzero(np.r_[True, np.maximum.accumulate(entry)[1:] > np.maximum.accumulate(entry)[:-1]][: len(entry)])
    words = list(entries)
    digit = digit[first]
    if (lone := np.flatnonzero(digit == 0)).size:
        at = np.frombuffer(b"".join(words[i] for i in lone), np.uint8).reshape(len(lone), -1)
        h = np.zeros(len(lone), np.uint64)
        for column in at.T:
            h = _mixed(h * _M1 + column + np.uint64(1))
        digit[lone] = h
    by_entry = np.argsort(entry, kind="stable")
    begin = np.searchsorted(entry[by_entry], np.arange(len(words) + 1))
    rows: list[tuple] = []
    for bucket, own in _by_bucket((_mixed(digit * _M1) >> np.uint64(8)) % np.uint64(buckets)):
        places = np.concatenate([by_entry[begin[e] : begin[e + 1]] for e in own.tolist()])
        times = begin[own + 1] - begin[own]
        text = [words[e] for e in own.tolist()]
        rows.append((
            bucket, chunk, _pack(b"".join(text)), _pack(np.array([len(t) for t in text], np.int32)),
            _pack(part.ids[doc[first[own]]]), _pack(times.astype(np.int32)), _pack(doc[places].astype(np.int32)),
            _pack(part.ids[doc[places]]), _pack(start[places] - part.starts[doc[places]]),
        ))
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 7]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 9, kinds)], names=_SENT)


_SENT = ["bucket", "chunk", "runs", "sizes", "ids", "times", "rows", "row_ids", "starts"]


def repeated_windows(raw: np.ndarray, at: np.ndarray, ids: np.ndarray, depth: int) -> np.ndarray:
    """Which windows, starting at `at` in `raw`, also start in a document of smaller id.

    Most significant digit first: windows are sorted by (group, next eight bytes); groups with one
    document drop out, the others are sorted on by the next digit. The last digit overlaps the one
    before it if the depth is no multiple of eight.
    """
    padded = np.r_[raw, np.zeros(8, np.uint8)].astype(np.uint64)
    eight = np.zeros(len(raw), np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(raw)]
    left, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    for digit in [*range(0, depth - 7, 8), depth - 8]:
        order = np.lexsort((eight[at[left] + digit], group))
        left, group = left[order], group[order]
        value = eight[at[left] + digit]
        new = np.r_[True, (value[1:] != value[:-1]) | (group[1:] != group[:-1])]
        begin = np.flatnonzero(new)
        if not len(left):
            break
        low = np.minimum.reduceat(ids[left], begin)
        keep = low < np.maximum.reduceat(ids[left], begin)
        group = np.cumsum(new) - 1
        stay = keep[group]
        left, group = left[stay], group[stay]
    out = np.zeros(len(at), bool)
    if len(left):
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        low = np.minimum.reduceat(ids[left], begin)
        out[left] = ids[left] > np.repeat(low, np.diff(np.r_[begin, len(left)]))
    return out


def _sort_bucket(table: pa.Table, depth: int) -> pa.Table:
    """The repeated stretches of a bucket's runs: per part, document rows, first bytes and ends."""
    get = lambda name, kind: [np.frombuffer(zstandard.decompress(x), kind) for x in table.column(name).to_pylist()]
    sizes, ids, times = get("sizes", np.int32), get("ids", np.int64), get("times", np.int32)
    rows, row_ids, starts = get("rows", np.int32), get("row_ids", np.int64), get("starts", np.int64)
    # Equal runs of several parts are sorted once, under the smallest of their documents.
    distinct: dict[bytes, int] = {}
    of: list[int] = []
    for text, length in zip(get("runs", np.uint8), sizes):
        text, stops = text.tobytes(), np.cumsum(length).tolist()
        of += [distinct.setdefault(text[a:b], len(distinct)) for a, b in zip([0, *stops], stops)]
    of = np.array(of, np.int64)
    raw = np.frombuffer(b"".join(distinct), np.uint8)
    size = np.fromiter(map(len, distinct), np.int64, len(distinct))
    id_of = np.full(len(distinct), _LAST)
    np.minimum.at(id_of, of, np.concatenate(ids))
    each = size - depth + 1
    begin = np.cumsum(size) - size
    window = np.cumsum(each) - each
    inner = np.arange(each.sum()) - np.repeat(window, each)
    at = np.repeat(begin, each) + inner
    again = repeated_windows(raw, at, np.repeat(id_of, each), depth)
    out: list[tuple] = []
    entry = 0
    for chunk, s, t, r, ri, st in zip(table.column("chunk").to_pylist(), sizes, times, rows, row_ids, starts):
        own = np.repeat(of[entry : entry + len(s)], t)
        entry += len(s)
        later = ri > id_of[own]
        a, b, doc = [st[later]], [st[later] + size[own[later]]], [r[later]]
        same = np.flatnonzero(~later)
        n = each[own[same]]
        place = np.repeat(same, n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = again[np.repeat(window[own[same]], n) + step]
        place, step = place[hit], step[hit]
        if len(place):
            new = np.r_[True, (place[1:] != place[:-1]) | (step[1:] != step[:-1] + 1)]
            one = np.flatnonzero(new)
            last = np.r_[one[1:], len(place)] - 1
            a.append(st[place[one]] + step[one])
            b.append(st[place[one]] + step[last] + depth)
            doc.append(r[place[one]])
        a, b, doc = np.concatenate(a), np.concatenate(b), np.concatenate(doc)
        if len(a):
            out.append((chunk, doc.tobytes(), a.astype(np.int64).tobytes(), b.astype(np.int64).tobytes()))
    kinds = [pa.int64(), *[pa.binary()] * 3]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], names=["chunk", "rows", "begins", "ends"])


def _ordered(table: pa.Table) -> pa.Table:
    """A part's rows in an order that does not depend on how they arrived."""
    return table.sort_by([("__row", "ascending"), ("__id", "ascending")])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 50, as_text: bool = False
) -> DataFrame:
    """`docs` with kept (binary), n_bytes, n_removed and n_spans, longs.

    Every byte of a text (UTF-8) that lies in a window of `depth` bytes which also starts in a
    document of smaller id is removed; `kept` is what is left, n_spans the number of runs removed.
    With `as_text` it is a string, without the bytes of characters that were cut through.
    Windows are judged on the input and never cross documents. Null texts are empty; a null id is
    larger than all others; rows of one id remove nothing from each other, so repeated rows fare
    alike. Texts shorter than `depth` stay. Columns named like the new ones are replaced; no rows
    give no rows.

    Texts are dealt once, by a hash of id and text, into parts of about 2 MB (a longer text is a
    part by itself), and the three uses of the parts read the same shuffle. Rows equal in id and
    text share a part.
    """
    if depth < GRAM + 1:
        raise ValueError(f"depth is at least {GRAM + 1}")
    amount = total(docs.select(text_col), text_bytes(F.col(text_col)))
    made = ("kept", "n_bytes", "n_removed", "n_spans")
    columns = [c for c in docs.columns if c not in made]
    parts = max(1, -(-amount // _PART))
    digit_buckets, run_buckets = max(1, -(-amount // _DIGITS)), max(1, -(-amount // _RUNS))
    row = F.xxhash64(id_col, text_col)
    keyed = docs.select(
        F.pmod(F.xxhash64(F.lit(1), row), F.lit(parts)).alias("__chunk"), row.alias("__row"),
        F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__doc"),
    )
    grouped = keyed.groupBy("__chunk")

    def first_digits(table: pa.Table) -> pa.Table:
        digits = Part(_ordered(table), depth, digit_buckets).digits()
        chunk = table.column("__chunk")[0].as_py()
        rows = [(bucket, chunk, _pack_digits(digits[own])) for bucket, own in _by_bucket(digits >> _DIGIT_BITS)]
        return pa.table(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, [pa.int64(), pa.int64(), pa.binary()])],
            names=["bucket", "chunk", "digits"],
        )

    def runs(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [_unpack_digits(x, b) for x, b in zip(right.column("found").to_pylist(), right.column("bucket").to_pylist())]
        if not found or not left.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], pa.binary())] * 7, names=_SENT)
        return _send(Part(_ordered(left), depth, digit_buckets), np.concatenate(found), run_buckets, left.column("__chunk")[0].as_py())

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _ordered(left)
        get = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in right.column(name).to_pylist()] or [np.zeros(0, kind)])
        doc, begin, end = get("rows", np.int32), get("begins", np.int64), get("ends", np.int64)
        order = np.lexsort((begin, doc))
        doc, begin, end = doc[order], begin[order], end[order]
        bound = np.searchsorted(doc, np.arange(left.num_rows + 1))
        out: list[list] = [[], [], [], []]
        for i, text in enumerate(left.column("__text")):
            raw = (text.as_py() or "").encode()
            a, b = begin[bound[i] : bound[i + 1]], end[bound[i] : bound[i + 1]]
            spans = 0
            if len(a):
                reach = np.maximum.accumulate(b)
                new = np.r_[True, a[1:] > reach[:-1]]
                a, b = a[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(a) - 1]]
                keep = zip([0, *b.tolist()], [*a.tolist(), len(raw)])
                left_over = [raw[x:y] for x, y in keep]
                spans, n, raw = len(a), len(raw), b"".join(left_over)
            else:
                n = len(raw)
            kept = raw
            if as_text:  # piece by piece, so that halves of two characters do not become one
                kept = "".join([x.decode("utf-8", "ignore") for x in left_over]) if spans else text.as_py() or ""
            for column, value in zip(out, (kept, n, n - len(raw), spans)):
                column.append(value)
        rest = left.select(["__doc"])
        for name, values, kind in zip(made, out, [pa.string() if as_text else pa.binary(), *[pa.int64()] * 3]):
            rest = rest.append_column(name, pa.array(values, kind))
        return rest

    schema = T.StructType(
        [keyed.schema["__doc"], T.StructField("kept", T.StringType() if as_text else T.BinaryType())] + [T.StructField(c, T.LongType()) for c in made[1:]]
    )
    digits = grouped.applyInArrow(first_digits, "bucket long, chunk long, digits binary")
    shared = digits.groupBy("bucket").applyInArrow(_shared, "chunk long, bucket long, found binary")
    sent = grouped.cogroup(shared.groupBy("chunk")).applyInArrow(
        runs, ", ".join(f"{c} {'long' if k < 2 else 'binary'}" for k, c in enumerate(_SENT))
    )
    covered = sent.groupBy("bucket").applyInArrow(
        lambda table: _sort_bucket(table, depth), "chunk long, rows binary, begins binary, ends binary"
    )
    done = grouped.cogroup(covered.groupBy("chunk")).applyInArrow(cut, schema)
    return done.select(*[F.col("__doc").getField(c).alias(c) for c in columns], *made)
