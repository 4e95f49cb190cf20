"""Near duplicates of embeddings: randomly rotated binary codes decide which pairs are computed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataset.llm.components import components
from strataset.llm.streams import whole_runs
from strataset.session import hold

_ROWS = 20_000  # rows of several cells that are taken from the stream together
_BLOCK = 4096  # rows of a block, of which two meet in one task
_NUMBERS = 1 << 21  # components of a block's vectors, so long vectors have smaller blocks
_TILE = 512  # rows of a block compared at once


@lru_cache(64)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of unit vectors: rotated vectors, their sign codes as unit vectors, and the correction
    factors, the inner product of each code with its own rotated vector."""
    turned = unit @ rotation(unit.shape[1], seed)
    signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(unit.shape[1])
    return turned, signs, (signs * turned).sum(1)


def estimate(
    turned: np.ndarray, signs: np.ndarray, factor: np.ndarray, confidence: float
) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of <row, column> from the columns' codes, and the bound of their error.

    <code, query> / factor is unbiased; its error exceeds sqrt((1 - f^2) / f^2 / (dim - 1)) times
    `confidence` with probability falling as exp(-c * confidence^2).
    """
    bound = confidence * np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, signs.shape[1] - 1))
    return (turned @ signs.T) / factor, bound


def least_product(factor: np.ndarray, threshold: float) -> np.ndarray:
    """The least inner product of a row with a column's code if <row, column> >= `threshold`.

    For certain: the angle between row and code is at most that between row and column plus that
    between column and code, whose cosine is the column's factor.
    """
    widest = np.arccos(np.clip(factor, -1, 1)) + math.acos(max(-1.0, min(1.0, threshold)))
    return np.cos(np.minimum(widest, math.pi)) - 1e-7


def plan_tables(rows: int, threshold: float, recall: float, per_bucket: int) -> tuple[int, int]:
    """(bits of a key, tables): keys are as long as to leave about `per_bucket` unrelated rows in a
    bucket at any number of rows, tables as many as find a pair at the threshold with `recall`."""
    bits = max(6, math.ceil(math.log2(max(2, rows / per_bucket))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - together))


@lru_cache(4096)
def _lines(dim: int, bits: int, table: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, bits, table]).standard_normal((dim, bits))


def table_keys(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(rows, tables): a key of sign bits of own random directions for each table."""
    dim = unit.shape[1]
    out = np.empty((len(unit), tables), np.int64)
    weight = 1 << np.arange(bits, dtype=np.int64)
    for t in range(tables):
        out[:, t] = ((unit @ _lines(dim, bits, t, seed)) >= 0) @ weight
    return out


def _units(flat: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(v, np.float64) for v in flat])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _joined(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """`label` after joining a with b."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != label[label]).any():
            label = label[label]
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def _compare(unit, first: int, sizes, threshold: float, seed: int):
    """Links inside one cell: weighted numbers of links per row, and joined labels.

    Where two blocks meet, the first has `first` rows and only pairs between them are compared;
    `first` is 0 inside one block.
    """
    n = len(unit)
    found, label = np.zeros(n, np.int64), np.arange(n)
    turned, signs, factor = codes(unit, seed)
    least = least_product(factor, threshold)
    for i in range(0, first or n, _TILE):
        for j in range(first or i, n, _TILE):
            r, c = slice(i, min(i + _TILE, first or n)), slice(j, j + _TILE)
            maybe = turned[r] @ signs[c].T >= least[c]
            if i == j:
                maybe &= np.tri(*maybe.shape, -1, dtype=bool).T
            a, b = np.nonzero(maybe)
            a, b = a + i, b + j
            if not len(a):
                continue
            # Recomputed as sums of products of the whole vectors, in double precision.
            exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            a, b = a[exact], b[exact]
            np.add.at(found, a, sizes[b])
            np.add.at(found, b, sizes[a])
            label = _joined(n, a, b, label)
    return found, label


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    seed: int = 7,
) -> DataFrame:
    """(id, n_links, component): a row per row of `vectors`.

    Links are pairs of cosine >= `threshold`, all of them, each confirmed in double precision. All
    vectors of one length meet: they are cut into blocks that meet two at a time in different tasks.
    The product of a rotated vector with the other's code leaves out pairs that cannot reach the
    threshold for certain (`least_product`). Equal vectors are one class of the search and count as
    links of each other. The work grows with the square of the number of classes.

    Vectors that are null, empty, zero or have null or non-finite components link with nothing;
    vectors of different lengths are never linked. Rows without an id keep a null component. A
    repeated row counts as another vector with the same id.
    """
    v = F.col("vec")
    source = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0)).alias("vec"),
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("id").isNotNull() & F.coalesce(
        F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    # The digest stands for the vector, so that rows, classes and links are joined on a narrow key.
    marked = source.withColumn("same", F.when(usable, F.sha2(F.to_json(F.struct("vec")), 256)))
    narrow = hold(marked.select("id", "same"), "vector-digests")
    classes = hold(
        marked.filter("same is not null")
        .groupBy("same")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec")),
        "vector-classes",
    )

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [np.array(x, np.float64).tobytes() for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(flat, pa.binary())], names=["rep", "size", "dim", "vec"]
            )

    dims = classes.groupBy(F.size("vec").alias("dim")).count()
    per = F.greatest(F.lit(1), F.least(F.lit(_BLOCK), F.floor(F.lit(_NUMBERS) / F.col("dim"))))
    blocks = hold(dims.select("dim", F.ceil(F.col("count") / per).cast("int").alias("blocks")), "vector-blocks")
    cut = (
        classes.select("rep", "size", F.size("vec").alias("dim"), "vec")
        .mapInArrow(flatten, "rep long, size long, dim int, vec binary")
        .join(blocks, "dim")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("part", F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")))
        .withColumn("cell", F.xxhash64("dim", F.least("own", "other"), F.greatest("own", "other")))
        .select("rep", "size", "part", "cell", "vec")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["cell"], _ROWS):
            cells = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            ends = np.r_[starts[1:], len(cells)]
            rep, size, part = (table.column(c).to_numpy() for c in ("rep", "size", "part"))
            vec = table.column("vec").to_pylist()
            out = []
            for a, b in zip(starts, ends):
                if b - a < 2:
                    continue
                first = int((part[a:b] == 0).sum())
                if part[a] == 1 or first == b - a:  # the other block has no rows
                    continue
                found, label = _compare(_units(vec[a:b]), first, size[a:b], threshold, seed)
                some = np.flatnonzero(found)
                out.append((rep[a:b][some], found[some], rep[a:b][label[some]]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*out)], names=["rep", "n", "root"]
                )

    linked = hold(
        cut.repartition("cell").sortWithinPartitions("cell", "part", "rep")
        .mapInArrow(compare, "rep long, n long, root long"),
        "vector-links",
    )
    joined = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct())
    counts = linked.groupBy("rep").agg(F.sum("n").alias("n"))
    known = (
        classes.select("same", "rep", "size")
        .join(counts, "rep", "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(
            "same",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return narrow.join(known, "same", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
