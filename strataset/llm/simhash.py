"""SimHash fingerprints of word shingles, and near duplicates by BK-trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from strataset.llm.components import components
from strataset.llm.streams import whole_runs
from strataset.session import hold

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SEGMENT = 1 << 20  # bytes of a text that are cut into words at a time
_ROWS = 100_000  # rows of several trees that are searched together
_PAIRS = 1 << 21  # (query, node) pairs looked at together
HASH_SEED = 42


def _segments(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part of the text at a time."""
    start = 0
    while start < len(raw):
        end = start + _SEGMENT
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        yield raw[start:end].translate(_LOWER).split()
        start = end


def hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text; fewer words are one shingle, no words none."""
    digest = xxhash.xxh64_intdigest
    n, rest = 0, []
    for part in _segments((text or "").encode("utf-8", "surrogatepass")):
        part = rest + part
        if len(part) >= words:
            joined = b" ".join(part)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            starts = [0, *ends[:-1].tolist()]
            stops = (ends - 1)[words - 1 :].tolist()
            yield np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)], np.uint64)
            n += len(stops)
            rest = part[len(part) - words + 1 :] if words > 1 else []
        else:
            rest = part
    if n == 0 and rest:
        yield np.array([digest(b" ".join(rest), HASH_SEED)], np.uint64)


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of a text; 0 without words."""
    counts, n = np.zeros(64, np.int64), 0
    for h in hashes(text, words):
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    if n == 0:
        return 0
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long. One scan, no shuffle."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"]
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        make, "id long, fp long"
    )


# ---- BK-trees ------------------------------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees over the shards of one batch; shards are runs of equal `shard`, values differ in each.

    A child is keyed by its Hamming distance to its parent. All trees grow a level at a time: the
    first value that reaches a free place becomes the child, the others descend to it.
    """

    def __init__(self, shard: np.ndarray, values: np.ndarray) -> None:
        n = len(values)
        self.values = values
        first = np.r_[True, shard[1:] != shard[:-1]]
        self.root = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        self.parent, self.dist = np.full(n, -1), np.zeros(n, np.int64)
        at, pending, self.levels = self.root.copy(), np.flatnonzero(~first), []
        while len(pending):
            d = _distance(values[pending], values[at[pending]])
            place, new, which = np.unique(at[pending] * 65 + d, return_index=True, return_inverse=True)
            child = pending[new]
            self.parent[child], self.dist[child] = place // 65, place % 65
            self.levels.append(child)
            at[pending] = child[which]
            pending = pending[at[pending] != pending]
        order = np.argsort(self.parent, kind="stable")
        self.order = order[np.searchsorted(self.parent[order], 0) :]
        sorted_parents = self.parent[self.order]
        self.begin = np.searchsorted(sorted_parents, np.arange(n))
        self.count = np.searchsorted(sorted_parents, np.arange(n), "right") - self.begin

    def links(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that join whatever is within `radius`, without every pair of a dense group.

        A child within the radius of its parent is linked to it. A query then skips subtrees whose
        values all hang together with it already, and follows only edges within the radius.
        """
        n = len(self.values)
        near = [c[self.dist[c] <= radius] for c in self.levels]
        label = np.arange(n)
        for child in near:  # parents are a level above, so their label is final
            label[child] = label[self.parent[child]]
        mixed = np.zeros(n, bool)
        for child in reversed(self.levels):
            up = self.parent[child]
            np.logical_or.at(mixed, up, mixed[child] | (label[child] != label[up]))
        a = [np.concatenate(near)] if near else [np.zeros(0, np.int64)]
        b = [self.parent[a[0]]]
        asked = np.flatnonzero(mixed[self.root])
        for block in np.array_split(asked, max(1, len(asked) * 16 // _PAIRS + 1)):
            todo = [(block, self.root[block])]
            while todo:
                query, node = todo.pop()
                if len(query) > _PAIRS:
                    half = len(query) // 2
                    todo += [(query[:half], node[:half]), (query[half:], node[half:])]
                    continue
                d = _distance(self.values[query], self.values[node])
                hit = (d <= radius) & (label[query] != label[node])
                a.append(query[hit])
                b.append(node[hit])
                many = self.count[node]
                offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                child = self.order[np.repeat(self.begin[node], many) + offset]
                query, d = np.repeat(query, many), np.repeat(d, many)
                go = (np.abs(self.dist[child] - d) <= radius) & (mixed[child] | (label[child] != label[query]))
                if go.any():
                    todo.append((query[go], child[go]))
        a, b = np.concatenate(a), np.concatenate(b)
        pair = np.unique(np.stack([np.maximum(label[a], label[b]), np.minimum(label[a], label[b])]), axis=1)
        tree = label != np.arange(n)
        return (
            np.concatenate([np.flatnonzero(tree), pair[0]]),
            np.concatenate([label[tree], pair[1]]),
        )


def _shards(radius: int, equal: int = 2) -> list[int]:
    """Bit masks: two values within `radius` agree on all bits of at least one of them.

    The 64 bits are cut into radius + `equal` blocks; at least `equal` blocks have no differing bit.
    """
    edges = np.linspace(0, 64, radius + equal + 1).astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, equal)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(reps: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links between rows of `reps` (id long, fp long; fp distinct), enough to join whatever
    is linked within `radius` directly or by others.

    Every value goes to the shards of its blocks (15 for radius 4), each of which has a BK-tree.
    Shards are shuffled rather than broadcast: all trees together grow with the corpus.
    """
    masks = _shards(radius)
    shard = F.explode(
        F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["shard"], _ROWS):
            ids, shards = table.column("id").to_numpy(), table.column("shard").to_numpy()
            same = shards[1:] == shards[:-1]
            shared = np.r_[False, same] | np.r_[same, False]
            if not shared.any():
                continue
            ids = ids[shared]
            forest = Forest(shards[shared], table.column("fp").to_numpy()[shared].view(np.uint64))
            a, b = forest.links(radius)
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    spread = reps.select("id", "fp", shard.alias("shard"))
    return (
        spread.repartition("shard").sortWithinPartitions("shard", "id").mapInArrow(search, "a long, b long").distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """(id, fp, component): a row per row of `docs`; component is the smallest id reachable by links.

    Texts that are null, empty or without words have fingerprint 0 and are linked like others. A
    null id is kept, gets its fingerprint, and its component is null unless its fingerprint has ids;
    repeated rows give repeated rows. Equal fingerprints are one tree node, so copies add no work
    beyond their fingerprint, and the search sees distinct fingerprints only.
    """
    marks = hold(fingerprints(docs, id_col, text_col, words), "fingerprints")
    reps = hold(
        marks.groupBy("fp").agg(F.min("id").alias("id")).filter("id is not null"), "fingerprint-classes"
    )
    joined = components(links(reps, radius))
    classes = reps.join(joined, reps["id"] == joined["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component")
    )
    return marks.join(classes, "fp", "left").select("id", "fp", "component")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4,
    groups: Callable[[DataFrame, str, str], DataFrame] | None = None,
) -> DataFrame:
    """`docs` with one row of each component of `near_duplicates`, that of its smallest id; or of
    those that `groups` finds, given rows and the names of their id and text.

    Rows without an id take part under a hash of their text, larger than usual ids, so they give way
    to rows with one. Rows of one id count as one document; the one of smallest hash stays.
    """
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text_col), 2)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), stand_in).alias("key"), F.col(text_col).alias("text"),
        F.xxhash64(whole).alias("pick"), whole.alias("doc"),
    )
    found = groups(rows, "key", "text") if groups else near_duplicates(rows, "key", "text", words, radius)
    kept = found.filter("id = component").select(F.col("id").alias("key"))
    first = Window.partitionBy("key").orderBy("pick")
    return (
        rows.select("key", "pick", "doc").join(kept.distinct(), "key")
        .withColumn("nth", F.row_number().over(first)).filter("nth = 1")
        .select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
    )
