"""Ranked lexical search over documents grouped by the length normaliser of their scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strataset.session import hold

# Bytes of UTF-8: A-Z lower-cased, other ASCII but digits and letters to a space, the rest as it is.
_LETTERS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
_BLOCK = 16_384  # documents of one stratum that are scored together
_GATHERED = 65_536  # documents whose strata are ordered by their bounds together
_BOUNDS = 1 << 24  # bounds that are held together
_BATCH = 1 << 16  # distinct terms of the items that are searched in one pass
_CHUNK = 1 << 23  # characters of text whose terms are counted together


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8: runs of ASCII letters, digits and all characters beyond
    ASCII, with A-Z lower-cased. A null text has none."""
    return text.encode().translate(_LETTERS).split() if text else []


@dataclass
class Queries:
    """Items of one pass, by position in `vocabulary`; item i has at[i]:at[i + 1]."""

    vocabulary: list[bytes]
    weight: np.ndarray
    items: np.ndarray
    at: np.ndarray
    terms: np.ndarray


# ---- counting ------------------------------------------------------------------------------------


def _counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: how many terms it has, and positions in
    the vocabulary with how often they occur. One scan."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            ids, rows, held = batch.column(0).to_pylist(), [], 0
            for doc_id, text in zip(ids, batch.column(1)):
                text = text.as_py()
                found = terms(text)
                if not found:
                    continue
                wanted = Counter(map(place.get, found))
                wanted.pop(None, None)
                rows.append((doc_id, len(found), list(wanted), list(wanted.values())))
                held += len(text)
                if held >= _CHUNK:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

    return docs.mapInArrow(make, "doc_id long, n long, terms array<int>, tfs array<long>")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n", "terms", "tfs"]
    )


# ---- strata --------------------------------------------------------------------------------------


class Stratum:
    """Postings of up to `_BLOCK` documents of equal normaliser, by term and then by tf."""

    def __init__(self, m: int, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, q: Queries) -> None:
        order = np.lexsort((doc, tf, term))
        self.ids, self.doc, term, tf = ids, doc[order].astype(np.int32), term[order], tf[order]
        # The impact of each tf that occurs is worked out once for the stratum.
        distinct, which = np.unique(tf, return_inverse=True)
        impact = (1_000_000_000 * distinct) // (1000 * distinct + 20 * m)
        self.impact = impact[which]
        self.starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        self.ends = np.r_[self.starts[1:], len(term)]
        self.term = term[self.starts]
        # The last posting of a term has its highest tf. No document of the stratum exceeds the bounds.
        best = np.zeros(len(q.weight), np.int64)
        best[self.term] = self.impact[self.ends - 1] * q.weight[self.term]
        self.bounds = np.add.reduceat(best[q.terms], q.at[:-1])

    def scores(self, item: int, q: Queries) -> tuple[np.ndarray, np.ndarray]:
        """Documents with a score above 0, as positions in `ids`, and their scores."""
        t = q.terms[q.at[item] : q.at[item + 1]]
        place = np.minimum(np.searchsorted(self.term, t), len(self.term) - 1)
        there = self.term[place] == t
        place, t = place[there], t[there]
        lengths = self.ends[place] - self.starts[place]
        ends = np.cumsum(lengths)
        at = np.arange(int(lengths.sum())) + np.repeat(self.starts[place] - (ends - lengths), lengths)
        total = np.zeros(len(self.ids), np.int64)
        np.add.at(total, self.doc[at], self.impact[at] * np.repeat(q.weight[t], lengths))
        found = np.flatnonzero(total)
        return found, total[found]


class Best:
    """The k highest scores of each item so far, equal ones by ascending id, null ids last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.scores = [np.zeros(0, np.int64) for _ in range(items)]
        self.ids = [np.zeros((0, 2), np.int64) for _ in range(items)]  # (is null, id)

    def least(self, item: int) -> int:
        """A document below this score cannot be among the k."""
        return int(self.scores[item][-1]) if len(self.scores[item]) == self.k else 1

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        enough = scores >= self.least(item)
        ids = np.concatenate([self.ids[item], ids[enough]])
        scores = np.concatenate([self.scores[item], scores[enough]])
        order = np.lexsort((ids[:, 1], ids[:, 0], -scores))[: self.k]
        self.ids[item], self.scores[item] = ids[order], scores[order]


def _strata(table: pa.Table, q: Queries) -> list[Stratum]:
    """Strata of rows (m, doc_id, terms, tfs) that are sorted by m, large ones in blocks."""
    m = table.column("m").to_numpy()
    doc_id = table.column("doc_id").combine_chunks()
    ids = np.stack([doc_id.is_null().to_numpy(False).astype(np.int64), doc_id.fill_null(0).to_numpy(False)], axis=1)
    lists, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    doc = np.repeat(np.arange(len(m)), lengths)
    term, tf = lists.flatten().to_numpy(False), tfs.flatten().to_numpy(False)
    after = np.cumsum(lengths)
    cuts = np.flatnonzero(np.r_[True, m[1:] != m[:-1], True])
    found = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        for lo in range(a, b, _BLOCK):
            hi = min(lo + _BLOCK, b)
            p = slice(int(after[lo] - lengths[lo]), int(after[hi - 1]))
            found.append(Stratum(int(m[lo]), ids[lo:hi], doc[p] - lo, term[p], tf[p], q))
    return found


def _searched(rows: DataFrame, q: Queries, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each item among the documents of each task. `rows` has
    (m, doc_id, terms, tfs) sorted by m within each task."""

    together = max(256, min(_GATHERED, _BOUNDS // len(q.items)))

    def visit(tables: list[pa.RecordBatch], best: Best) -> None:
        strata = _strata(pa.Table.from_batches(tables), q)
        bounds = np.stack([s.bounds for s in strata])
        for item in range(len(q.items)):
            for s in np.argsort(-bounds[:, item], kind="stable"):
                if bounds[s, item] < best.least(item):
                    break  # nor can any stratum after it
                found, scores = strata[s].scores(item, q)
                best.add(item, strata[s].ids[found], scores)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, n = Best(len(q.items), k), [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, together):
                held.append(batch.slice(a, together))
                n += held[-1].num_rows
                if n >= together:
                    visit(held, best)
                    held, n = [], 0
        if n:
            visit(held, best)
        for a in range(0, len(q.items), 256):
            part = range(a, min(a + 256, len(q.items)))
            ids = np.concatenate([best.ids[i] for i in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q.items[list(part)], [len(best.ids[i]) for i in part])),
                 pa.array(ids[:, 1], mask=ids[:, 0] > 0),
                 pa.array(np.concatenate([best.scores[i] for i in part]))],
                names=["item", "doc_id", "score"],
            )

    return rows.mapInArrow(make, "item long, doc_id long, score long")


# ---- the search ----------------------------------------------------------------------------------


def _item_batches(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Rows (item, terms), a bounded number of terms at a time, an item of more terms by itself."""
    batch: list[tuple[int, list[bytes]]] = []
    seen: set[bytes] = set()
    for row in items.toLocalIterator():
        wanted = [bytes(t) for t in row.terms]
        if batch and len(seen) + len(wanted) > _BATCH:
            yield batch
            batch, seen = [], set()
        batch.append((row.item, wanted))
        seen.update(wanted)
    if batch:
        yield batch


def _distinct_terms(items: DataFrame) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"]
            )

    return items.mapInArrow(make, "item long, terms array<binary>").filter("size(terms) > 0")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item.

    With N documents that have a term and L terms in all, a document of n terms has the normaliser
    m = 50 + (50 n N) div L, a term in df documents the weight floor(1000 ln((2N+2)/(2df+1))), and a
    document scores the sum of weight * ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct
    terms. Documents of equal m form a stratum, whose postings lie by term and tf; impacts are worked
    out once per tf, and an item visits strata by falling bounds until none can reach its k-th score.

    Only scores above 0 count; equal scores rank by ascending doc_id, null ids last. Null and empty
    texts are no documents and, as items, find nothing; rows of one id are documents by themselves, and
    rows of one item id are items by themselves of which each rank is one row. Empty tables give no
    rows; other columns, whatever their names, play no part. Whole texts are counted; a document's row
    holds the terms that items ask for.

    The text is read once for each `_BATCH` distinct terms of the items (once for all items, as a rule).
    What moves is a narrow row per document, dealt by ranges of m, so that a frequent m is split over
    tasks, and k rows per item and task. Only the terms of one such batch reach driver and tasks.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = hold(
        _distinct_terms(items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")))
        .select(F.monotonically_increasing_id().alias("row"), "item", "terms"),
        "search-items",
    )
    found = None
    for batch in _item_batches(asked.select(F.col("row").alias("item"), "terms").orderBy("item")):
        part = _rank_batch(source, batch, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found.join(asked.select(F.col("row").alias("item"), F.col("item").alias("item_id")), "item").select(
        "item_id", "rank", "doc_id", "score"
    )


def _rank_batch(source: DataFrame, batch: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    vocabulary = sorted({t for _, ts in batch for t in ts})
    counted = hold(
        _counted(source, vocabulary).withColumn("row", F.monotonically_increasing_id()), "search-counts"
    )
    n_docs, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # As many rows as the vocabulary has terms at most.
    held = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    place = {t: i for i, t in enumerate(vocabulary)}
    q = Queries(
        vocabulary,
        np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1)))
                  for i in range(len(vocabulary))], np.int64),
        np.array([i for i, _ in batch], np.int64),
        np.cumsum([0] + [len(ts) for _, ts in batch]),
        np.array([place[t] for _, ts in batch for t in ts], np.int64),
    )
    # n * N is a product of numbers that fit 64 bits together up to 10^9 terms in 10^9 documents.
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(length, 1)}L")
    rows = (
        counted.filter("size(terms) > 0")
        .select(m.alias("m"), "doc_id", "terms", "tfs", F.xxhash64("row").alias("spread"))
        .repartitionByRange("m", "spread").sortWithinPartitions("m").drop("spread")
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        _searched(rows, q, k).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )
