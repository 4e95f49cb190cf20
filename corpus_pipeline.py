"""The corpus pipeline: stages that each write Parquet and hand it to the next.

Language identification, near duplicates, repeated passages, packing. A stage works on all rows its
predecessor kept; null and empty texts, repeated rows and empty tables go through as the operators
define it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataset.llm import language, packing, repeats, similar, simhash
from strataset.session import hold

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Learned models, hashes and packing plans are not SQL; tests compare with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those that are `und` (no letter, or no text) go.

    Learned from the labelled documents outside the held-out fold; `lang` stays as it was.
    """
    model = language.fit(docs.filter(~language.held_out()))
    found = language.predict(docs, model)
    return found.filter(F.col("lang_pred") != language.UNDETERMINED).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest id, those without an id after all others. Two
    documents are linked if their SimHash fingerprints differ in at most 4 bits (`op3_simhash_near_dedup`),
    or if the shingles of five words have a Jaccard similarity of 0.8 and more. Rows of one id are one
    document, of which one row stays. Texts without words are one group; very long ones are whole."""
    return simhash.deduplicated(docs, groups=partial(similar.near_duplicates, fingerprints=True)).select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes and more that an earlier document has, with n_chars
    of what is left. A document of which nothing is left goes; one that was empty stays."""
    cut = repeats.remove_repeats(docs, as_text=True)
    changed = F.col("n_removed") > 0
    return cut.filter("n_removed = 0 or length(kept) > 0").select(
        "doc_id",
        F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"),
    )


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, and their places in the sequences they are packed
    into; `packing.sequences` puts these together."""
    return packing.packed_pieces(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", remove_repeated_passages),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = hold(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
