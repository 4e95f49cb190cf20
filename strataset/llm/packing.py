"""Packing of token sequences by column generation over patterns of piece lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strataset.llm.tokens import byte_bpe
from strataset.session import hold

VOCABULARY = "byte_bpe_50k.json"
_RANKED = 200_000  # pieces that are ranked together
_STEPS = 20_000  # pivots of the linear program at most; stopping early keeps a valid plan


def pieces(
    docs: DataFrame, size: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, end_id: int = 0,
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): the tokens of every document in pieces of `size`
    ids and a rest; `ids` are little-endian unsigned 32-bit numbers. Null texts are empty texts,
    which have the end id alone. One scan, no shuffle."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = byte_bpe(path), np.array([end_id], "<u4")
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([bpe.encode(text.as_py() or "").astype("<u4"), end])
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    rows.append((doc_id, start, len(part), part.tobytes(), len(ids)))
                    held += part.nbytes
                if held > 1 << 24:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        make, "doc_id long, start long, length long, ids binary, doc_tokens long"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["doc_id", "start", "length", "ids", "doc_tokens"],
    )


# ---- the plan: small numbers of lengths, on the driver -------------------------------------------


def best_pattern(worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of most worth: an unbounded knapsack over lengths 1..len(worth)."""
    value, last = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for c in range(1, capacity + 1):
        k = min(c, len(worth))
        options = worth[:k] + value[c - 1 :: -1][:k]
        best = int(options.argmax())
        value[c], last[c] = (options[best], best + 1) if options[best] > value[c - 1] else (value[c - 1], 0)
    pattern, c = np.zeros(len(worth), int), capacity
    while c > 0:
        if last[c]:
            pattern[last[c] - 1] += 1
        c -= last[c] or 1
    return value[capacity], pattern


def relaxed(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Patterns (columns), how often each is used, and the worth of each length, at the optimum of
    the linear program that meets `demand` (all positive at the lengths it is given for).

    Gilmore and Gomory's column generation: the simplex method over patterns, where a knapsack
    program finds the column of least reduced cost.
    """
    used = np.flatnonzero(demand)
    m = len(used)
    columns = np.diag(capacity // (used + 1)).astype(float)
    amount = demand[used] / columns.diagonal()
    for _ in range(_STEPS):
        dual = np.linalg.solve(columns.T, np.ones(m))
        worth = np.zeros(len(demand))
        worth[used] = np.maximum(dual, 0)
        value, pattern = best_pattern(worth, capacity)
        entering = pattern[used] * (dual > 0)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(columns, entering)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * step, 0)
        columns[:, out], amount[out] = entering, ratio[out]
    return columns, amount, worth


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used: together exactly demand[b] pieces of length b + 1.

    The counts of the linear program are rounded down; what is left, at most a few pieces per
    pattern, is packed first-fit by decreasing length.
    """
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    m = len(used)
    columns, amount, _ = relaxed(demand, capacity)
    plans: Counter[tuple[int, ...]] = Counter()
    rest = demand[used].copy()
    for j in np.argsort(-amount):
        column = np.rint(columns[:, j]).astype(np.int64)
        if not column.any():
            continue
        times = int(min(np.floor(amount[j] + 1e-6), (rest[column > 0] // column[column > 0]).min()))
        if times > 0:
            plans[tuple(column)] += times
            rest -= times * column
    while rest.any():  # one sequence after the other, the longest pieces that still fit first
        column, free = np.zeros(m, np.int64), capacity
        for j in range(m - 1, -1, -1):
            n = min(int(rest[j]), free // int(used[j] + 1))
            column[j] = n
            free -= n * int(used[j] + 1)
        times = int((rest[column > 0] // column[column > 0]).min())
        plans[tuple(column)] += times
        rest -= times * column
    out = []
    for column, times in plans.items():
        whole = np.zeros(len(demand), np.int64)
        whole[used] = column
        out.append((whole, times))
    return out


def pack(found: DataFrame, size: int = 1024, grain: int = 8) -> DataFrame:
    """`found` (with length, 1 to `size`) with sequence_id and offset; `ids` may be among its columns.

    Lengths are counted in steps of `grain` for the plan, so it has at most size / grain rows at
    any number of documents. A piece's rank among those of its step tells its sequence. Ranks come
    from counts per part and step: neither a common length nor a common id meets in one task.
    Repeated rows are packed as often as they occur; no rows give no rows.
    """
    rank_parts = max(1, -(-found.count() // _RANKED))
    step = F.ceil(F.col("length") / grain).cast("int")
    marked = found.withColumn("_step", step).withColumn(
        "_part", F.pmod(F.xxhash64(*found.columns), F.lit(rank_parts)).cast("int")
    )
    sizes = marked.groupBy("_step", "_part").count()
    before = Window.partitionBy("_step").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = hold(sizes.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))), "pack-starts")
    demand = np.zeros(size // grain, np.int64)
    for row in starts.groupBy("_step").agg(F.sum("count").alias("n")).collect():
        demand[row["_step"] - 1] = row["n"]
    plans = plan(demand, size // grain)
    lookup = {}  # per step: first rank, pieces per sequence, and first sequence of each pattern
    first = np.cumsum([0] + [t for _, t in plans])
    for b in range(len(demand)):
        own = [(p[b], t, s) for (p, t), s in zip(plans, first) if p[b]]
        ranks = np.cumsum([0] + [a * t for a, t, _ in own])[:-1]
        lookup[b + 1] = (ranks, np.array([a for a, _, _ in own]), np.array([s for _, _, s in own]))

    @F.pandas_udf("long")
    def sequence(steps, ranks):
        out = np.zeros(len(steps), np.int64)
        step_of, rank = steps.to_numpy(), ranks.to_numpy()
        for b in np.unique(step_of):
            at = step_of == b
            begin, per, base = lookup[int(b)]
            k = np.searchsorted(begin, rank[at], "right") - 1
            out[at] = base[k] + (rank[at] - begin[k]) // per[k]
        return type(steps)(out)

    row = Window.partitionBy("_part", "_step").orderBy(F.xxhash64(*found.columns))
    ranked = marked.withColumn("_row", F.row_number().over(row) - 1).join(
        starts.select("_step", "_part", "_before"), ["_step", "_part"]
    )
    placed = ranked.withColumn("sequence_id", sequence("_step", F.col("_row") + F.col("_before")))
    inside = (
        Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).select(
        *found.columns, "sequence_id", "offset"
    )


def sequences(packed: DataFrame, size: int = 1024, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens): the packed ids of each sequence, padded to `size`."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens")).select(
        "sequence_id",
        F.concat(
            F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])),
            F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (size - F.col("n_tokens")).cast("int"))),
        ).alias("ids"),
        "n_tokens",
    )


def packed_documents(docs: DataFrame, size: int = 1024, **options) -> DataFrame:
    """Pieces of all documents with the check sum of their ids, held narrow, and packed."""
    narrow = pieces(docs, size, **options).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(hold(narrow, "pieces"), size)


def packed_pieces(docs: DataFrame, size: int = 1024, **options) -> DataFrame:
    """`packed_documents` with the ids of the pieces. They are packed without them, by a number of
    their own, and the ids move once, to their places."""
    found = pieces(docs, size, **options).withColumn("ids_crc32", F.crc32("ids"))
    held = hold(found.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    return pack(held.drop("ids"), size).join(held.select("_piece", "ids"), "_piece").drop("_piece")
