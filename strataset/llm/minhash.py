"""One-permutation MinHash fingerprints in DataFrame functions: no Python runs on the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataset.functions.numbering import dense_position
from strataset.session import hold

BINS, BITS = 128, 8  # bins, a power of two, and low-order bits stored of each
_PER_LONG = 64 // BITS
_SHIFT = 64 - (BINS.bit_length() - 1)  # the top bits of a hash are its bin
_TRIES = 12  # probes that are tried one by one; then all others


_LOW = (1 << _SHIFT) - 1  # a value with these bits marks an empty bin


def _probe(b: Column, attempt: Column) -> Column:
    """The bin that empty bin `b` asks at an attempt, a hash of both: two empty bins choose
    independently of each other, as optimal densification has it."""
    return F.pmod(F.xxhash64(b.cast("int"), attempt.cast("int")), F.lit(BINS)).cast("int")


def _probe_after(b: Column, step: Column) -> Column:
    """Where it goes on: from a hashed bin with a hashed odd stride, so that all bins are met."""
    start, stride = F.xxhash64(b.cast("int"), F.lit(-1)), F.xxhash64(b.cast("int"), F.lit(-2))
    mask = F.lit(BINS - 1)
    return F.pmod(start.bitwiseAND(mask) + step * stride.bitwiseAND(mask).bitwiseOR(F.lit(1)), F.lit(BINS)).cast("int")


def signatures(df: DataFrame, text: str, name: str, words: int = 5) -> DataFrame:
    """`df` with `name`: the packed signature, an array of longs; null if `text` has no words.

    Shingles are runs of `words` words (lower case, cut at white space); fewer words are one
    shingle. Each shingle is hashed once; a bin keeps its smallest hash, an empty bin takes that of
    the first bin on its own list of probes that is not empty; the low-order bits are packed.
    """
    w, h, s, m = (f"_{name}_{x}" for x in "whsm")
    cut = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    rolled = F.transform(
        F.sequence(F.lit(0), F.size(h) - words),
        lambda i: F.xxhash64(*[F.get(F.col(h), i + k) for k in range(words)]),
    )
    shingles = (
        F.when(F.size(h) >= words, rolled)
        .when(F.size(h) > 0, F.array(F.xxhash64(F.col(h))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    marks = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda b: F.shiftleft((b - BINS // 2).cast("long"), _SHIFT).bitwiseOR(F.lit(_LOW)),
    )
    # The marks sort behind all hashes of their bin, so each bin has a first value.
    first = F.filter(
        F.col(s),
        lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(F.col(s), i - 1), _SHIFT)),
    )
    bins = F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != _LOW, x))
    value = F.col(m)
    filled = F.transform(
        value,
        lambda x, i: F.coalesce(
            x,
            *[F.get(value, _probe(i, F.lit(t))) for t in range(_TRIES)],
            F.get(
                F.filter(
                    F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(value, _probe_after(i, j))),
                    lambda v: v.isNotNull(),
                ),
                F.lit(0),
            ),
        ),
    )
    d = f"_{name}_d"
    low = (1 << BITS) - 1

    def packed(g: Column) -> Column:
        out = None
        for k in range(_PER_LONG):
            part = F.shiftleft(F.get(F.col(d), g * _PER_LONG + k).bitwiseAND(F.lit(low)), BITS * (_PER_LONG - 1 - k))
            out = part if out is None else out.bitwiseOR(part)
        return out

    return (
        df.withColumn(w, cut)
        .withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
        .withColumn(s, F.sort_array(F.concat(shingles, marks)))
        .withColumn(m, F.when(F.size(w) > 0, bins))
        .withColumn(d, filled)
        .withColumn(name, F.when(F.col(d).isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), packed)))
        .drop(w, h, s, m, d)
    )


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of two signatures, 0 to 1, without the share of bins that
    agree in their low-order bits by chance. Two texts without words are alike, one is like no other."""
    def equal_bytes(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift, low in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift).bitwiseAND(F.lit(low)))
        return F.lit(_PER_LONG) - F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    same = F.aggregate(F.zip_with(a, b, equal_bytes), F.lit(0), lambda x, y: x + y)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return (
        F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(estimate)
    )


def text_form(signature: Column) -> Column:
    """A signature as hex digits; dashes for a text without words."""
    digits = F.concat_ws("", F.transform(signature, lambda x: F.lpad(F.hex(x), 16, "0")))
    return F.when(signature.isNull(), F.lit("-" * (BINS * BITS // 4))).otherwise(F.lower(digits))


def edited_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, edited, key, row, next_key, next_row, copies): a row per distinct document.

    In the edited text the last quarter of the code points is replaced by the first as many of the
    next document in ascending id, or by all of it; the last document is followed by the first.
    Documents are ordered on narrow rows. Texts move once: heads of next documents are cut off where
    the texts are, and both meet on the key the texts are already partitioned by.

    A null id comes first. Rows equal in id and text are one document with its number of `copies`;
    rows of one id with different texts follow in the order of their texts' hashes. Null texts are
    empty texts.
    """
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(0)).alias("key"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("row"),
    )
    narrow = keyed.select("doc_id", "key", "row", F.length("text").alias("n_chars"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    placed = hold(
        dense_position(narrow.groupBy("doc_id", "key", "row", "n_chars").agg(F.count(F.lit(1)).alias("copies")), order),
        "document-order",
    )
    rows = placed.count()
    pairs = hold(
        placed.select(
            (F.col("position") % max(1, rows) + 1).alias("position"), F.col("key").alias("own_key"),
            F.col("row").alias("own_row"), F.floor(F.col("n_chars") / 4).cast("int").alias("n"), "copies", "doc_id",
        ).join(placed.select("position", F.col("key").alias("next_key"), F.col("row").alias("next_row")), "position"),
        "document-pairs",
    )
    # Both uses below need the same columns of it, so that they read one shuffle.
    texts = keyed.groupBy("key", "row").agg(F.first("text").alias("text"))
    heads = texts.join(
        pairs, (texts["key"] == pairs["next_key"]) & (texts["row"] == pairs["next_row"])
    ).select("doc_id", "own_key", "own_row", "next_key", "next_row", "n", "copies", F.substring("text", F.lit(1), F.col("n")).alias("head"))
    both = texts.join(heads, (texts["key"] == heads["own_key"]) & (texts["row"] == heads["own_row"]))
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("n"))
    return both.select(
        "doc_id", "text", F.concat(kept, "head").alias("edited"), "key", "row", "next_key", "next_row", "copies"
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its own fingerprint, that of its edited text, and the likenesses to that and to
    the next document; see `edited_documents` for order, ties and nulls. A table of one document has
    itself as the next; no rows give no rows."""
    signed = signatures(signatures(edited_documents(docs, id_col, text_col), "text", "own"), "edited", "other")
    held = hold(
        signed.select(
            "doc_id", "key", "row", "next_key", "next_row", "copies", F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", "other",
        ),
        "fingerprints",
    )
    following = held.select(F.col("key").alias("next_key"), F.col("row").alias("next_row"), F.col("own").alias("next_own"))
    return (
        held.join(following, ["next_key", "next_row"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "doc_id", "n_chars", "edited_sha256", text_form(F.col("own")).alias("fingerprint"),
            text_form(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("other")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        )
    )
