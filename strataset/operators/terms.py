"""Term index: records, groups, splits, samples and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataset.functions.names import unused
from strataset.schemas import TERM_RECORD, TERM_SPLITS

# Documented feature types of a term group.
TERM_FEATURES = {
    "term": "string",
    "count": "int32",
    "category": "string",
    "significance": "string",
    "vibe": "string",
    "action_suggestion": "string",
    "emoji_representation": "string",
    "osi_layer": "string",
    "prime_factor": "int64",
    "is_power_of_two": "boolean",
    "numerical_address": "string",
    "first_seen_timestamp": "int64",
    "last_seen_timestamp": "int64",
}
# Fixed value: estimated size of a record in the dataset description.
BYTES_PER_RECORD = 200


def term_records(raw: DataFrame) -> DataFrame:
    """Raw terms to the 16 exported columns; embedding vectors, versions and unusable documents are
    dropped. How many documents there were is counted on `raw`, see group_stats."""
    if "problem" in raw.columns:
        raw = raw.filter("problem IS NULL")
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TERM_RECORD.fields])


def character_groups(terms: DataFrame) -> DataFrame:
    return terms.select("character_group").distinct().orderBy("character_group")


def group_stats(terms: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Terms per group, and one row with a null group for the totals. On scanned documents it counts
    them all, usable or not.

    Groups listed in `groups` but without terms count 0.
    """
    per_group = terms.groupBy("character_group").agg(F.count(F.lit(1)).alias("terms"))
    if groups is not None:
        per_group = (
            groups.select("character_group").distinct()
            .join(per_group, "character_group", "full_outer")
            .withColumn("terms", F.coalesce("terms", F.lit(0).cast("long")))
        )
    # Rolled up after the counts, so the roll-up sees one row per group.
    return per_group.rollup("character_group").agg(
        F.sum("terms").alias("terms"), F.count(F.lit(1)).alias("groups")
    )


def split_of(group: Column) -> Column:
    """ASCII letter: train; ASCII digit: validation; anything else: test. No name: train."""
    return (
        F.when(group.rlike("^[A-Za-z]") | (group == ""), "train")
        .when(group.rlike("^[0-9]"), "validation")
        .otherwise("test")
    )


def assign_split(terms: DataFrame) -> DataFrame:
    return terms.withColumn("split", split_of(F.col("character_group")))


def sample_per_group(
    terms: DataFrame, n: int = 1000, groups: int | None = None, salts: int = 64
) -> DataFrame:
    """The first max(n // groups, 1) terms of each group by id.

    Both filters are of the form Spark turns into a limit per group ahead of the shuffle. What each
    input partition kept of a group is ranked in `salts` bundles first and then as a whole, so that
    a group found in every partition comes to its last task as `salts` times k rows. Without
    `groups` the groups are counted first.
    """
    if groups is None:
        groups = terms.select("character_group").distinct().count()
    k = max(n // groups, 1) if groups else 1
    # Any assignment of rows to bundles gives the same result; by input partition each of them
    # sends at most k rows of a group.
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    bundle, rank = unused(terms.columns, "_salt", "_rank")
    sliced = Window.partitionBy("character_group", bundle).orderBy("id")
    whole = Window.partitionBy("character_group").orderBy("id")
    return (
        terms.withColumn(bundle, salt)
        .withColumn(rank, F.row_number().over(sliced))
        .filter(F.col(rank) <= k)
        .withColumn(rank, F.row_number().over(whole))
        .filter(F.col(rank) <= k)
        .drop(bundle, rank)
    )


def dataset_info(terms: DataFrame) -> DataFrame:
    """Examples and estimated bytes per split, all splits present, and the total."""
    spark = terms.sparkSession
    splits = spark.createDataFrame([(s,) for s in TERM_SPLITS], "split string")
    counts = assign_split(terms).groupBy("split").agg(F.count(F.lit(1)).alias("examples"))
    per_split = splits.join(counts, "split", "left")
    return (
        per_split.rollup("split")
        .agg(F.coalesce(F.sum("examples"), F.lit(0).cast("long")).alias("num_examples"))
        .select(
            F.coalesce("split", F.lit("total")).alias("split"),
            "num_examples",
            (F.col("num_examples") * BYTES_PER_RECORD).alias("num_bytes"),
        )
    )


def dataset_description(
    terms: DataFrame, dataset_name: str, config_name: str = "default", version: str = "1.0.0"
) -> DataFrame:
    """The figures of dataset_info as one row, with a map of the three splits."""
    info = dataset_info(terms)
    split = F.struct(
        F.col("split").alias("name"), "num_bytes", "num_examples",
        F.lit(dataset_name).alias("dataset_name"),
    )
    is_total = F.col("split") == "total"
    total = F.max(F.when(is_total, F.col("num_bytes")))
    return info.agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.when(~is_total, F.struct("split", split.alias("info")))))
        ).alias("splits"),
        total.alias("download_size"),
        total.alias("dataset_size"),
    ).select(
        F.lit(dataset_name).alias("dataset_name"), F.lit(config_name).alias("config_name"),
        F.lit(version).alias("version"), "splits", "download_size", "dataset_size",
    )


def list_null_to_empty(df: DataFrame, column: str) -> DataFrame:
    """A null list becomes an empty one, as the exporter writes it."""
    empty = F.array().cast(df.schema[column].dataType)
    return df.withColumn(column, F.coalesce(F.col(column), empty))


def lookup_term(terms: DataFrame, ids: DataFrame) -> DataFrame:
    """The terms with the wanted ids; of several groups holding an id the first one wins."""
    found = terms.join(ids.select("id").distinct(), "id", "left_semi")
    rest = [c for c in terms.columns if c != "id"]
    winner = F.min_by(F.struct(*rest), "character_group")
    return found.groupBy("id").agg(winner.alias("_t")).select(
        *[F.col("id") if c == "id" else F.col(f"_t.{c}").alias(c) for c in terms.columns]
    )


def term_features(terms: DataFrame) -> DataFrame:
    """Feature names and types of each group, with its row count."""
    features = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("dtype"))
        for name, dtype in TERM_FEATURES.items()
    ])
    return (
        terms.groupBy("character_group")
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select("character_group", "num_rows", F.inline(features))
    )
