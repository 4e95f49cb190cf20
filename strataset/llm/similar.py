"""Near duplicates by the exact Jaccard similarity of word shingles: no pair is lost."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataset.llm import simhash
from strataset.llm.components import components
from strataset.llm.streams import whole_runs
from strataset.session import hold, release

_ROWS = 100_000  # rows of several lists that are taken from the stream together
_FEW = 32  # a longer list of documents is a crowd: first linked by stars, then cut into blocks
_BLOCK = 2048  # rows of a crowd that meet in one task
_TILE = 256  # rows of a block compared at once
_CELLS = 256  # counts of a sketch
_VALUES = 1 << 21  # shingles of a group that are decided on together, or a cut of it
_SALTS = 64  # parts of the list of a common shingle
_SAMPLE = 4000  # documents that common shingles are looked for in
_COMMON = 1 << 16  # common shingles at most


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles in ascending order; fewer words are one shingle."""
    parts = list(simhash.hashes(text, words))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def prefix(values: np.ndarray, common: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """The first shingles of a set, in the order of their hashes with common ones last.

    Of two sets of at least that similarity, the prefixes share a shingle whatever the order is.
    """
    over, under = similarity
    n = len(values)
    if n and len(common):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        last = common[at] == values
        values = np.concatenate([values[~last], values[last]])
    return values[: n + over * -n // under + 1] if n else values


def sketch(values: np.ndarray) -> bytes:
    """How many shingles fall into each of the cells, at most 255: sets have no more in common than
    the sum of the smaller counts, plus what was cut off at 255."""
    return np.minimum(np.bincount((values >> np.uint64(56)).astype(np.int64), minlength=_CELLS), 255).astype(np.uint8).tobytes()


def _alike(shared, a, b, similarity: tuple[int, int]):
    over, under = similarity
    return under * shared >= over * (a + b - shared)


def _common(rows: DataFrame, words: int) -> np.ndarray:
    """Shingles of many documents of a sample. They only order the prefixes, for shorter lists."""
    every = max(1, rows.count() // _SAMPLE)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle_set(text.as_py(), words).view(np.int64))], names=["shingle"]
                )

    found = (
        rows.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("text")
        .mapInArrow(make, "shingle long").groupBy("shingle").count().filter("count >= 10")
        .orderBy(F.desc("count"), "shingle").limit(_COMMON).collect()
    )
    return np.sort(np.array([r.shingle for r in found], np.int64).view(np.uint64))


def _may_be_alike(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Whether sets of `n` and `m` shingles with the sketches `x` and `y` can be similar enough."""
    cut_off = np.minimum(n - x.sum(1, dtype=np.int64), m - y.sum(1, dtype=np.int64))
    most = np.minimum(x, y).sum(1, dtype=np.int64) + cut_off
    return _alike(np.minimum(most, np.minimum(n, m)), n, m, similarity)


def _open(pairs: DataFrame, classes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The rows (a, b) of `pairs` that the sketches leave open."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(c).to_numpy().astype(np.int64) for c in (2, 3))
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, _CELLS) for c in (4, 5))
                keep = pa.array(_may_be_alike(x, y, n, m, similarity))
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in (0, 1)], names=["a", "b"])

    x, y = (classes.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    return (
        pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "sa", "sb")
        .mapInArrow(make, "a long, b long").distinct()
    )


def _placed(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(node, component, block, blocks) of the ends of `pairs`.

    Documents that hang together by candidates are a group, so that nearly every set is needed in one
    cell only. A group of more than `_VALUES` shingles is cut into blocks, and a cell holds two of them.
    """
    group = hold(components(pairs), "candidate-groups")
    sized = group.join(sizes.select(F.col("rep").alias("node"), "n"), "node")
    blocks = sized.groupBy("component").agg(F.greatest(F.ceil(F.sum("n") / _VALUES), F.lit(1)).cast("int").alias("blocks"))
    placed = hold(
        group.join(blocks, "component")
        .select("node", "component", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "blocks"),
        "candidate-blocks",
    )
    release(group)
    return placed


def _cells(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows (a, b) of `pairs` with the cell (group, x, y) they are decided in."""
    placed = _placed(pairs, sizes)
    x, y = (placed.select(F.col("node").alias(c), F.col("component").alias(f"g{c}"), F.col("block").alias(f"b{c}")) for c in "ab")
    cut = hold(
        pairs.join(x, "a").join(y, "b").select(
            F.col("ga").alias("group"), F.least("ba", "bb").alias("x"), F.greatest("ba", "bb").alias("y"), "a", "b"
        ),
        "candidate-cells",
    )
    release(placed)
    return cut


def _sets(rows: DataFrame, needed: DataFrame, words: int, kind: str) -> DataFrame:
    """(id, shingles) of the rows whose id is in `needed`, once for each struct of its array `cells`."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 100):
                part = batch.slice(a, 100)
                found = [shingle_set(t.as_py(), words).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.binary()), part.column(2)], names=["id", "shingles", "cells"]
                )

    return (
        rows.join(needed, "id").select("id", "text", "cells")
        .mapInArrow(make, f"id long, shingles binary, cells array<{kind}>")
        .select(F.explode("cells").alias("c"), "id", "shingles").select("c.*", "id", "shingles")
    )


def _confirmed(
    pairs: DataFrame, rows: DataFrame, sizes: DataFrame, words: int, similarity: tuple[int, int], label: str,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Rows (a, b) of `pairs` whose texts are similar enough, by their whole shingle sets: enough of
    them to join whatever is. `sizes` has (rep, n) of all ends.

    Sets are sent to the cells that need them; a pair whose ends the cell has joined is not looked at.
    Texts of one id are one document, which is like another if one of them is. With `labels` (rep, label)
    all pairs of what hangs together by `pairs` are decided, but for those of one label.
    """
    if labels is not None:
        return _joined(pairs, rows, sizes, words, similarity, label, labels)
    cells = _cells(pairs, sizes)
    ends = cells.select("group", "x", "y", F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = hold(ends.groupBy("id").agg(F.collect_list(F.struct("group", "x", "y")).alias("cells")), "needed-sets")

    sent = _sets(rows, needed, words, "struct<group:bigint,x:int,y:int>").select(
        "group", "x", "y", F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), "shingles"
    )
    asked = cells.withColumn("shingles", F.lit(None).cast("binary"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, root = None, {}, {}

        def top(i: int) -> int:
            while root.setdefault(i, i) != i:
                root[i] = i = root[root[i]]
            return i

        for batch in batches:
            out = []
            keys = zip(*[batch.column(c).to_pylist() for c in range(5)])
            for k, (group, x, y, a, b) in enumerate(keys):
                if (group, x, y) != cell:
                    cell, held, root = (group, x, y), {}, {}
                if b is None:
                    held.setdefault(a, []).append(np.frombuffer(batch.column(5)[k].as_py(), np.uint64))
                elif top(a) != top(b) and any(_near(s, t, similarity) for s in held[a] for t in held[b]):
                    root[top(a)] = top(b)
                    out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    found = hold(
        sent.unionByName(asked).repartition("group", "x", "y")
        .sortWithinPartitions("group", "x", "y", F.asc_nulls_first("b"), "a")
        .mapInArrow(decide, "a long, b long"),
        label,
    )
    release(cells, needed)
    return found


def _joined(
    pairs: DataFrame, rows: DataFrame, sizes: DataFrame, words: int, similarity: tuple[int, int], label: str, labels: DataFrame
) -> DataFrame:
    """(a, b): links that join what is similar among the documents that hang together by `pairs`, as the
    labels do not yet. Sets and no pairs are moved: all pairs of a cell are looked at where its sets are,
    by size and sketch first."""
    placed = _placed(pairs, sizes)
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    needed = hold(
        placed.join(labels.select(F.col("rep").alias("node"), "label").distinct(), "node").select(
            F.col("node").alias("id"),
            F.transform(other, lambda o: F.struct(
                F.col("component").alias("group"), F.least("block", o).alias("x"), F.greatest("block", o).alias("y"), "block", "label",
            )).alias("cells"),
        ),
        "needed-sets",
    )
    sent = _sets(rows, needed, words, "struct<group:bigint,x:int,y:int,block:int,label:bigint>")

    def search(cell: list[tuple]) -> Iterator[tuple[int, int]]:
        cell.sort(key=lambda row: len(row[3]))
        ids, block, label = (np.array(c) for c in list(zip(*cell))[:3])
        found = [row[3] for row in cell]
        n = np.array([len(x) for x in found])
        marks = np.stack([np.frombuffer(sketch(x), np.uint8) for x in found])
        whole = block.min() == block.max()
        for i, j, end in _tiles(n, similarity):
            maybe = label[i : i + _TILE, None] != label[None, j:end]
            if not whole:
                maybe &= block[i : i + _TILE, None] != block[None, j:end]
            for x, y in _open_in(maybe, i, j, n, marks, label, similarity):
                if label[x] != label[y] and _near(found[x], found[y], similarity):
                    label[label == label[y]] = label[x]
                    yield int(ids[x]), int(ids[y])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            links = list(search(held)) if held else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

        cell, held = None, []
        for batch in batches:
            for k, (group, x, y, block, mark, i) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(6)])):
                if (group, x, y) != cell:
                    yield from out()
                    cell, held = (group, x, y), []
                held.append((i, block, mark, np.frombuffer(batch.column(6)[k].as_py(), np.uint64)))
        yield from out()

    found = hold(
        sent.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y").mapInArrow(decide, "a long, b long"), label
    )
    release(placed, needed)
    return found


def _tiles(n: np.ndarray, similarity: tuple[int, int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, end): tiles of rows from i and rows j to end, over all pairs of the ascending sizes `n`
    that sizes do not rule out."""
    over, under = similarity
    for i in range(0, len(n), _TILE):
        last = int(np.searchsorted(over * n, under * n[min(i + _TILE, len(n)) - 1], "right"))
        for j in range(i, last, _TILE):
            yield i, j, min(j + _TILE, last)


def _open_in(
    maybe: np.ndarray, i: int, j: int, n: np.ndarray, marks: np.ndarray, label: np.ndarray, similarity: tuple[int, int]
) -> Iterator[tuple[int, int]]:
    """The pairs of a tile (rows from i and j) that are set in `maybe` and that sizes and sketches leave
    open; those whose labels have become equal since are passed over."""
    over, under = similarity
    if i == j:
        maybe = maybe & np.tri(*maybe.shape, -1, dtype=bool).T
    a, b = np.nonzero(maybe)
    a, b = a + i, b + j
    for k in range(0, len(a), 1024):
        x, y = a[k : k + 1024], b[k : k + 1024]
        go = (label[x] != label[y]) & (under * n[x] >= over * n[y])
        x, y = x[go], y[go]
        go = _may_be_alike(marks[x], marks[y], n[x], n[y], similarity)
        yield from zip(x[go].tolist(), y[go].tolist())


def _near(x: np.ndarray, y: np.ndarray, similarity: tuple[int, int]) -> bool:
    both = np.sort(np.concatenate([x, y]))
    return bool(_alike(int((both[1:] == both[:-1]).sum()), len(x), len(y), similarity))


def _meet(postings: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b, shingle, n, center): pairs of short lists, all; of crowds each row with a row of about its
    size, and the crowd's rows themselves with a null b, of which those are centers that rows of a part
    of a crowd were paired with."""
    over, under = similarity

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["shingle", "salt"], _ROWS):
            shingle, salt, rep, n = (table.column(c).to_numpy() for c in ("shingle", "salt", "rep", "n"))
            start = np.r_[True, (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])]
            first = np.flatnonzero(start)
            size = np.diff(np.r_[first, len(shingle)])
            crowd = (size > _FEW) | (salt[first] > 0)  # a salted list is part of a crowd
            few = np.repeat((size > 1) & ~crowd, size)
            out = []
            for step in range(1, _FEW):
                i = np.flatnonzero(few[:-step] & (shingle[step:] == shingle[:-step])) if step < len(shingle) else np.zeros(0, int)
                i = i[under * n[i].astype(np.int64) >= over * n[i + step].astype(np.int64)]
                out.append((rep[i], rep[i + step], shingle[i], n[i], np.ones(len(i), bool), np.zeros(len(i), bool)))
            for a, m in zip(first[crowd], size[crowd]):
                own, sizes = rep[a : a + m], n[a : a + m].astype(np.int64)
                i, centers = 0, np.zeros(m, bool)
                while i < m:  # rows are in ascending size
                    end = int(np.searchsorted(over * sizes, under * sizes[i], "right"))
                    out.append((np.full(end - i - 1, own[i]), own[i + 1 : end], shingle[a + i + 1 : a + end], n[a + i + 1 : a + end], np.ones(end - i - 1, bool), np.zeros(end - i - 1, bool)))
                    centers[i] = salt[a] > 0
                    i = end
                out.append((own, own, shingle[a : a + m], n[a : a + m], np.zeros(m, bool), centers))
            a, b, s, c, pair, center = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(pair, np.minimum(a, b), a)), pa.array(np.maximum(a, b), mask=~pair), pa.array(s), pa.array(c), pa.array(center)],
                names=["a", "b", "shingle", "n", "center"],
            )

    return postings.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "n", "rep").mapInArrow(
        make, "a long, b long, shingle long, n int, center boolean"
    )


def _crowd_pairs(crowds: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b): the rows (rep, shingle, n, label, sketch) of a crowd that hang together by pairs of different
    labels that the sketches do not rule out for certain. As many of these pairs as join what hangs
    together, less than there are rows. Blocks of a crowd meet two at a time."""
    sizes = crowds.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"))
    cut = (
        crowds.join(sizes, "shingle")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("part", F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")))
        .withColumn("cell", F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")))
        .select("rep", "n", "label", "part", "cell", "sketch")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["cell"], _BLOCK):
            cells = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            for s, e in zip(starts, np.r_[starts[1:], len(cells)]):
                rep, n, label, part = (table.column(c).to_numpy()[s:e] for c in ("rep", "n", "label", "part"))
                n, group, out = n.astype(np.int64), np.arange(e - s), []
                marks = np.stack([np.frombuffer(x, np.uint8) for x in table.column("sketch").slice(s, e - s).to_pylist()])
                for i, j, end in _tiles(n, similarity):
                    maybe = label[i : i + _TILE, None] != label[None, j:end]
                    if part[0] >= 0:
                        maybe &= part[i : i + _TILE, None] != part[None, j:end]
                    for x, y in _open_in(maybe, i, j, n, marks, group, similarity):
                        if group[x] != group[y]:
                            group[group == group[y]] = group[x]
                            out.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return cut.repartition("cell").sortWithinPartitions("cell", "n", "rep").mapInArrow(make, "a long, b long").distinct()


def _fingerprint_pairs(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b): rows of `classes` whose SimHash fingerprints are equal or linked, by BK-trees: enough pairs
    to join whatever is linked. A group of near copies so meets along a tree, not in all its pairs.
    `rows` (id, and text or its fp) may have several texts of one id."""
    rows = rows.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    marks = rows.select("id", "fp") if "fp" in rows.columns else simhash.fingerprints(rows, "id", "text")
    marks = hold(marks.distinct(), "class-fingerprints")
    heads = hold(marks.groupBy("fp").agg(F.min("id").alias("id")), "fingerprint-heads")
    equal = marks.join(heads.select("fp", F.col("id").alias("head")), "fp").filter("id <> head")
    found = equal.select(F.col("head").alias("a"), F.col("id").alias("b")).unionByName(
        simhash.links(heads).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    found = hold(found.filter("a < b").distinct(), "fingerprint-pairs")
    release(marks, heads)
    return found


def links(
    classes: DataFrame, rows: DataFrame, words: int, similarity: tuple[int, int], common: np.ndarray = np.zeros(0, np.uint64),
    near: DataFrame | None = None, sure: DataFrame | None = None,
) -> DataFrame:
    """(a, b): links between the rows of `classes` (rep, n, prefix, sketch), enough to join whatever is linked.

    The pairs `near` (a, b) are candidates too, decided like all others; `sure` (a, b) are linked already,
    are part of the result, and what they join is not decided on again in crowds.
    Documents that share a shingle of their prefixes form a list. Pairs of short lists are all
    decided. A crowd is joined by stars first, as a large group of near copies hangs together then;
    what hangs together by its other pairs that the sketches leave open is then decided as a group, in
    which no pair is moved. The lists of `common` shingles,
    which may hold a third of all documents, are dealt to `_SALTS` parts, each with stars of its own,
    whose centers meet in a list again.
    """
    often = common.view(np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                found = [np.frombuffer(x, np.int64) for x in part.column(2).to_pylist()]
                size = [len(x) for x in found]
                rep, n = (np.repeat(part.column(c).to_numpy(), size) for c in (0, 1))
                shingle = np.concatenate(found)
                salt = np.where(np.isin(shingle, often), 1 + (rep * 0x9E3779B1 >> 16) % _SALTS, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle), pa.array(salt), pa.array(rep), pa.array(n)], names=["shingle", "salt", "rep", "n"]
                )

    postings = classes.select("rep", "n", "prefix").mapInArrow(spread, "shingle long, salt int, rep long, n int")
    met = hold(_meet(postings, similarity), "shingle-lists")
    centers = met.filter("center").select("shingle", F.lit(0).alias("salt"), F.col("a").alias("rep"), "n")
    both = met.unionByName(_meet(centers, similarity)).filter("b is not null").select("a", "b")
    if near is not None:
        both = both.unionByName(near)
    pairs = hold(_open(both.distinct(), classes, similarity), "open-pairs")
    sizes = classes.select("rep", "n")
    first = _confirmed(pairs, rows, sizes, words, similarity, "near-pairs")
    release(pairs)
    if sure is not None:
        first = first.unionByName(sure)
    crowds = met.filter("b is null").select(F.col("a").alias("rep"), "shingle", "n")
    if not crowds.head(1):
        return first
    label = components(first)
    nodes = hold(
        classes.select("rep", "sketch").join(crowds.select("rep").distinct(), "rep", "left_semi")
        .join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("rep", F.coalesce("component", "rep").alias("label"), "sketch"),
        "crowd-sketches",
    )
    pairs = hold(_crowd_pairs(crowds.join(nodes, "rep"), similarity), "crowd-pairs")
    release(met)
    second = _confirmed(pairs, rows, sizes, words, similarity, "crowd-near-pairs", nodes)
    release(pairs, nodes)
    return first.unionByName(second)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: tuple[int, int] = (4, 5),
    fingerprints: bool = False,
) -> DataFrame:
    """(id, component): a row per row of `docs`; component is the smallest id reachable by links.

    Links are pairs whose sets of shingles of `words` words have at least the Jaccard similarity,
    a fraction. Candidates come from SimHash fingerprints linked by BK-trees and from prefixes, which lose
    no pair, and are decided by whole sets. With `fingerprints` the links of `simhash` between the texts of
    all rows are links as well, whatever the similarity of their sets is.
    Equal sets are one class of the search; texts without words are linked to each other. A null id
    keeps a null component unless its shingles have ids; repeated rows give repeated rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    common = _common(rows, words)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                sets = [shingle_set(t.as_py(), words) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([prefix(s, common, similarity).tobytes() for s in sets], pa.binary()),
                        pa.array([sketch(s) for s in sets], pa.binary()),
                        pa.array(np.array([simhash.fingerprint(t.as_py()) for t in part.column(1)], np.uint64).view(np.int64)),
                    ],
                    names=["id", "same", "n", "prefix", "sketch", "fp"],
                )

    marks = hold(
        rows.mapInArrow(mark, "id long, same binary, n int, prefix binary, sketch binary, fp long"), "shingle-marks"
    )
    classes = hold(
        marks.filter("id is not null").groupBy("same")
        .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
             F.first("sketch").alias("sketch")),
        "shingle-classes",
    )
    members = hold(marks.select("id", "same", "fp"), "shingle-members")
    release(marks)
    prints = members.join(classes.select("same", "rep"), "same").select(F.col("rep").alias("id"), "fp")
    near = _fingerprint_pairs(classes, prints.unionByName(members.select("id", "fp")))
    joined = components(links(classes, rows, words, similarity, common, **{"sure" if fingerprints else "near": near}))
    known = classes.join(joined, classes["rep"] == joined["node"], "left").select(
        "same", F.coalesce("component", "rep").alias("component")
    )
    return members.join(known, "same", "left").select("id", "component")
