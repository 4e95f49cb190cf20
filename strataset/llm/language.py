"""Language identification by unigram pieces, summed over all segmentations of a word."""

from __future__ import annotations

import math
import re
import uuid
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strataset.llm.pieces import MARK, NORMAL, Model
from strataset.session import hold

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_LONG = 64  # letters of a word up to which words are segmented in batches; longer ones go one by one
_PLACES = 1 << 21  # places of words that are segmented together
_CACHED = 400_000  # words whose scores a worker keeps at most; then it starts anew
_PER_BATCH = 20_000  # words that are segmented together
_SEGMENT = 1 << 20  # characters of a text that are cut into words at a time


def words_of(text: str) -> list[str]:
    """The words of a text in lower case: runs of letters, of any length."""
    out: list[str] = []
    at = 0
    while at < len(text):
        end = at + _SEGMENT
        while end < len(text) and text[end].isalpha():
            end += 1
        for word in _WORD.findall(text[at:end].lower()):  # numbers such as ² and ① are no letters
            out += [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()
        at = end
    return out


def vocabulary(path: str) -> dict[str, int]:
    """The model's pieces that are letters, with or without the mark of a word's start."""
    with open(path, "rb") as f:
        found = [p for p, _, kind in Model.parse(f.read()).pieces if kind == NORMAL]
    return {p: i for i, p in enumerate(sorted({p.lower() for p in found if p.lstrip(MARK).isalpha() and p.count(MARK) <= 1}))}


class Lattice:
    """All segmentations of a batch of words into pieces; a letter that is no piece is the last id.

    Sums are scaled at each position, so that words of any length have one.
    """

    def __init__(self, words: list[str], ids: dict[str, int]) -> None:
        longest = max(map(len, ids), default=1)
        get, unknown = ids.get, len(ids)
        self.n, self.length = len(words), np.array([len(w) + 1 for w in words])
        arcs: list[list[list[int]]] = [[[], [], []] for _ in range(max(map(len, words), default=0) + 2)]  # by end
        for w, word in enumerate(words):
            marked = MARK + word
            for a in range(len(marked)):
                if a == 1:  # the mark alone is no piece: it belongs to the first one
                    continue
                found = False
                for b in range(a + 1 + (a == 0), min(len(marked), a + longest) + 1):
                    piece = get(marked[a:b])
                    if piece is not None:
                        arcs[b][0].append(w), arcs[b][1].append(a), arcs[b][2].append(piece)
                        found |= b - a == 1 + (a == 0)
                if not found:
                    b = a + 1 + (a == 0)
                    arcs[b][0].append(w), arcs[b][1].append(a), arcs[b][2].append(unknown)
        self.arcs = [tuple(np.array(x, np.int64) for x in end) for end in arcs]

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, words): sums over the segmentations up to each position, under piece
        probabilities `p`, divided by their scale, and the logarithm of the scale."""
        alpha, scale = np.zeros((len(self.arcs), self.n)), np.zeros((len(self.arcs), self.n))
        alpha[0] = 1
        for b, (w, a, piece) in enumerate(self.arcs[1:], 1):
            scale[b] = scale[b - 1]
            if len(w):
                total = np.bincount(w, alpha[a, w] * np.exp(scale[a, w] - scale[b - 1, w]) * p[piece], self.n)
                some = total > 0
                alpha[b, some] = 1
                scale[b, some] += np.log(total[some])
        return alpha, scale

    def log_likelihood(self, log_p: np.ndarray) -> np.ndarray:
        """(words, languages): log of the sum over all segmentations."""
        out = np.empty((self.n, log_p.shape[1]))
        last = self.length, np.arange(self.n)
        for k in range(log_p.shape[1]):
            p = np.exp(log_p[:, k])
            sums = np.zeros((len(self.arcs), self.n))  # without a scale, which few words need
            sums[0] = 1
            for b, (w, a, piece) in enumerate(self.arcs[1:], 1):
                if len(w):
                    sums[b] = np.bincount(w, sums[a, w] * p[piece], self.n)
            whole = sums[last]
            small = whole < 1e-280
            out[:, k] = np.log(np.where(small, 1, whole))
            if small.any():
                out[small, k] = self.forward(p)[1][last][small]
        return out

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The expected number of times each piece is used, words weighted by `counts`."""
        alpha, scale = self.forward(p)
        beta = np.zeros_like(alpha)  # of what follows, times the forward scale, by the whole sum
        beta[self.length, np.arange(self.n)] = 1
        out = np.zeros(len(p))
        for b in range(len(self.arcs) - 1, -1, -1):
            w, a, piece = self.arcs[b]
            if len(w):
                flow = p[piece] * beta[b, w] * np.exp(scale[a, w] - scale[b, w])
                # Several arcs of a word may end here, each from another place.
                np.add.at(beta, (a, w), flow)
                out += np.bincount(piece, alpha[a, w] * flow * counts[w], len(p))
        return out


def lattices(words: list[str], ids: dict[str, int]) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Lattices of all words, words of about a length together, with the places of the words."""
    order = np.argsort([len(w) for w in words], kind="stable")
    start = 0
    for i in range(1, len(order) + 1):
        wide = len(words[order[min(i, len(order) - 1)]]) + 2
        if i == len(order) or (i + 1 - start) * wide > _PLACES or i - start == _PER_BATCH:
            at = order[start:i]
            yield at, Lattice([words[j] for j in at], ids)
            start = i


def long_likelihood(word: str, ids: dict[str, int], log_p: np.ndarray) -> np.ndarray:
    """`Lattice.log_likelihood` of one long word; only the last few positions are held."""
    longest, unknown = max(map(len, ids), default=1), len(ids)
    marked, none = MARK + word, np.full(log_p.shape[1], -np.inf)
    recent: deque[np.ndarray] = deque([np.zeros(log_p.shape[1])], maxlen=longest + 1)  # logs, up to b - 1
    for b in range(1, len(marked) + 1):
        if b == 1:
            recent.append(none)
            continue
        sums = []
        single = b - 1 if b > 2 else 0  # the first letter comes with the mark
        for a in range(max(0, b - longest), b):
            piece = ids.get(marked[a:b]) if a != 1 else None
            if piece is None and a == single:
                piece = unknown
            if piece is not None:
                sums.append(recent[a - b] + log_p[piece])
        recent.append(np.logaddexp.reduce(sums) if sums else none)
    return recent[-1]


class Scorer:
    """Scores of texts under the languages; scores of words are kept while they last."""

    def __init__(self, log_p: np.ndarray, ids: dict[str, int]) -> None:
        self.log_p, self.ids = log_p, ids
        self._known: dict[str, int] = {}
        self._scores = np.empty((1 << 14, log_p.shape[1]))

    def _learn(self, words: list[str]) -> None:
        for a in range(0, len(words), _PER_BATCH):
            part = words[a : a + _PER_BATCH]
            begin = len(self._known)
            while begin + len(part) > len(self._scores):
                self._scores = np.concatenate([self._scores, np.empty_like(self._scores)])
            short = [w for w in part if len(w) <= _LONG]
            part = short + [w for w in part if len(w) > _LONG]
            for at, lattice in lattices(short, self.ids):
                self._scores[begin + at] = lattice.log_likelihood(self.log_p)
            for i in range(len(short), len(part)):
                self._scores[begin + i] = long_likelihood(part[i], self.ids, self.log_p)
            self._known.update(zip(part, range(begin, begin + len(part))))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) sums of the words' log-likelihoods, and the numbers of words."""
        if len(self._known) > _CACHED:
            self._known.clear()
        words = [words_of(t) for t in texts]
        known = self._known
        self._learn(list({w: None for ws in words for w in ws if w not in known}))
        out = np.zeros((len(texts), self.log_p.shape[1]))
        for i, ws in enumerate(words):
            if ws:
                out[i] = self._scores[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))].sum(0)
        return out, np.array([len(ws) for ws in words])


def smoothed(sums: np.ndarray, background: float) -> np.ndarray:
    """Probabilities from counts (pieces + unknown letter, languages): relative frequencies, of which
    the share `background` goes to their mean over the languages and, by as much of it, to all pieces
    alike. A letter that is no piece says nothing: all languages give it the least probability."""
    pieces = sums[:-1]
    totals = pieces.sum(0)
    own = np.where(totals > 0, pieces / np.where(totals > 0, totals, 1), 1 / len(pieces))
    common = (1 - background) * own.mean(1, keepdims=True) + background / len(pieces)
    p = (1 - background) * own + background * common
    return np.concatenate([p, np.full((1, p.shape[1]), p.min())])


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """The `per_language` rows (lang, text, pick) of each language of smallest `pick`.

    Hashes are counted by their leading bits first: what is ranked is about as many narrow rows as are
    wanted, however many a language has. The few that tie at the last hash are ranked with their texts.
    """
    leading = F.shiftright("pick", 48)
    counted = rows.groupBy("lang", leading.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = hold(
        counted.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .filter(F.col("before") < per_language).groupBy("lang").agg(F.max("bin").alias("last_bin")),
        "language-bins",
    )
    first = Window.partitionBy("lang").orderBy("pick")
    near = rows.select("lang", "pick").join(bins, "lang").filter(leading <= F.col("last_bin")).drop("last_bin")
    last = (
        near.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
        .groupBy("lang").agg(F.max("pick").alias("last"))
    )
    return (
        rows.join(hold(last, "language-picks"), "lang").filter("pick <= last")
        .withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
    )


def fit(
    labelled: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", path: str | None = None,
    per_language: int = 1500, rounds: int = 3, background: float = 0.05,
) -> tuple[list[str], np.ndarray, str]:
    """Languages, log-probabilities (pieces + unknown letter, languages) and the vocabulary's path.

    Fitted on `per_language` labelled rows of each language, those of smallest hash of their id.
    Their words are counted by Spark; expectation maximisation runs over the counts in tasks, and
    only sums per language and piece reach the driver: the vocabulary's size times the languages.
    Rows with a null language or text are left out. The share `background` of each language's
    probabilities is that of all languages together, so a piece that a language has not shown is as
    likely in it as in any other that has not.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    ids = vocabulary(path)
    rows = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("pick")
    ).filter("lang is not null and text is not null")
    sample = _sample(rows, per_language)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, counts = np.unique(words_of(text.as_py()), return_counts=True)
                if len(words):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(words)), pa.array(words.tolist()), pa.array(counts)],
                        names=["lang", "word", "n"],
                    )

    counted = hold(
        sample.select("lang", "text").mapInArrow(cut, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "language-words",
    )
    langs = sorted(r[0] for r in counted.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((len(ids) + 1, 0)), path
    place = {lang: k for k, lang in enumerate(langs)}
    log_p = np.full((len(ids) + 1, len(langs)), -math.log(len(ids) + 1))
    for _ in range(rounds):
        shared = np.exp(log_p)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sums = np.zeros_like(shared)
            for batch in batches:
                of = np.array([place[x] for x in batch.column(0).to_pylist()])
                words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                for k in np.unique(of):
                    at = np.flatnonzero(of == k)
                    for own, lattice in lattices([words[i] for i in at], ids):
                        sums[:, k] += lattice.expected(shared[:, k], n[at[own]])
            piece, k = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(k), pa.array(sums[piece, k])], names=["piece", "k", "n"]
            )

        sums = np.zeros_like(log_p)
        found = counted.mapInArrow(expect, "piece long, k long, n double").groupBy("piece", "k").agg(F.sum("n").alias("n"))
        for row in found.toPandas().itertuples(index=False):
            sums[row.piece, row.k] += row.n
        log_p = np.log(smoothed(sums, background))
    return langs, log_p, path


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, str], text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score: the language of most probability over the whole text, and
    that probability among the learned languages. Texts that are null or have no letter, and all
    texts if no language was learned, are `und` with score 0. Ties go to the first language by name.
    Columns of these names are replaced. One scan, no shuffle; the broadcast model has the
    vocabulary's size."""
    langs, log_p, path = model
    shared = docs.sparkSession.sparkContext.broadcast((langs, log_p))
    token = uuid.uuid4().hex
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(token, shared, path)
        names = np.array([*shared.value[0], UNDETERMINED], object)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [t or "" for t in part.column(0).field(text_col).to_pylist()]
                if len(names) == 1:
                    best, top = np.zeros(len(texts), int), np.zeros(len(texts))
                else:
                    score, n = scorer.score(texts)
                    best = score.argmax(1)
                    top = 1 / np.exp(score - score.max(1, keepdims=True)).sum(1)
                    best[n == 0], top[n == 0] = len(names) - 1, 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(top)],
                    names=["doc", "lang_pred", "score"],
                )

    schema = T.StructType([*rows.schema.fields]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(make, schema).select(
        *[F.col("doc").getField(c).alias(c) for c in columns], "lang_pred", "score"
    )


_SCORERS: dict[str, Scorer] = {}


def _scorer(token: str, shared, path: str) -> Scorer:
    """The scorer of a model, kept by the worker between tasks; earlier models' are let go."""
    if token not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[token] = Scorer(shared.value[1], vocabulary(path))
    return _SCORERS[token]


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text is divisible by `folds`."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))
