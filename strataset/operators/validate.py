"""Capability validation: split, config and dataset level, term index and Parquet datasets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from strataset.schemas import CAPABILITIES, SEMANTIC_RECORD
from strataset.session import any_path

_ENTITY = ["dataset", "config", "split"]


def level_of(config: Column, split: Column) -> Column:
    return (
        F.when(config.isNotNull() & split.isNotNull(), "split")
        .when(config.isNotNull(), "config")
        .otherwise("dataset")
    )


def entity_keys(entities: DataFrame, kind: str) -> DataFrame:
    """Add the level, the cache key of `kind` and the display path."""
    level = level_of(F.col("config"), F.col("split"))
    name = F.coalesce("config", F.lit("")), F.coalesce("split", F.lit(""))
    return entities.withColumns({
        "level": level,
        "cache_key": F.concat_ws(":", F.lit(kind), "dataset", *name),
        "display": F.when(level == "dataset", F.col("dataset")).otherwise(
            F.concat_ws("/", *_ENTITY)
        ),
    })


def capability_count(df: DataFrame) -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.col(c).cast("int") for c in CAPABILITIES])
    return df.withColumn("capability_count", total)


def _any_true(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in CAPABILITIES
    ])


def merge_capabilities(a: DataFrame, b: DataFrame) -> DataFrame:
    """Flag-wise OR of two result sets per entity."""
    columns = [*_ENTITY, *CAPABILITIES]
    return _any_true(a.select(*columns).unionByName(b.select(*columns)), _ENTITY)


def _searchable(needles: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col("dtype").contains(n) for n in needles])


def indexable_columns(
    features: DataFrame, needles: Sequence[str] = ("string", "text")
) -> DataFrame:
    """(dataset, config) with whether any feature type can be searched."""
    return features.groupBy("dataset", "config").agg(
        F.bool_or(_searchable(needles)).alias("indexable")
    )


def validate_split(entities: DataFrame, responses: DataFrame, features: DataFrame) -> DataFrame:
    """Flags of each split entity; a missing response or missing metadata is false.

    responses: (kind, dataset, config, split, ok); features: (dataset, config, column, dtype).
    What is known of a split, and of a config, is one row per key first, so the joins add no rows.
    """
    splits = entities.filter(F.col("config").isNotNull() & F.col("split").isNotNull())
    ok = F.col("ok")
    of_split = (
        responses.filter(F.col("kind").isin("split-has-preview", "split-has-statistics")
                         & F.col("split").isNotNull())
        .groupBy(*_ENTITY)
        .agg(
            F.bool_or(ok & (F.col("kind") == "split-has-preview")).alias("preview"),
            F.bool_or(ok & (F.col("kind") == "split-has-statistics")).alias("statistics"),
        )
    )
    # Viewer responses and column types of a config meet in one aggregate.
    none = F.lit(None).cast("boolean")
    viewers = responses.filter((F.col("kind") == "config-has-viewer") & F.col("split").isNull())
    columns = features.select(
        "dataset", "config", none.alias("viewer"), _searchable(("string", "text")).alias("indexable"),
        F.lit(True).alias("filter"),
    )
    config_level = (
        viewers.select("dataset", "config", ok.alias("viewer"), none.alias("indexable"), none.alias("filter"))
        .unionByName(columns)
        .groupBy("dataset", "config")
        .agg(*[F.bool_or(c).alias(c) for c in ("viewer", "indexable", "filter")])
    )
    joined = splits.join(of_split, _ENTITY, "left").join(config_level, ["dataset", "config"], "left")
    flags = {c: F.col("indexable" if c == "search" else c) for c in CAPABILITIES}
    return joined.select(
        *_ENTITY,
        *[F.coalesce(flag, F.lit(False)).alias(c) for c, flag in flags.items()],
        F.lit(1.0).alias("progress"),
    )


def _roll_up(parents: DataFrame, children: DataFrame, cached: DataFrame, kind: str,
             parent_keys: list[str], child_keys: list[str]) -> DataFrame:
    """OR of the children's cached results with status 200, and the share that is cached.

    Children and results meet in an aggregate per child, children and parents in one per parent, so
    there are two shuffles and no join.
    """
    none = F.lit(None).cast("boolean")
    known = children.select(
        *child_keys, F.lit(True).alias("_child"), none.alias("_good"), *[none.alias(c) for c in CAPABILITIES]
    ).unionByName(cached.filter(F.col("kind") == kind).select(
        *child_keys, none.alias("_child"), (F.col("status") == 200).alias("_good"), *CAPABILITIES,
    ))
    per_child = known.groupBy(*child_keys).agg(
        F.bool_or("_child").alias("_child"), F.count("_good").alias("_cached"),
        *[F.bool_or(F.col(c) & F.col("_good")).alias(c) for c in CAPABILITIES],
    ).filter("_child")
    members = per_child.select(
        *parent_keys, F.lit(1).alias("_total"), (F.col("_cached") > 0).cast("int").alias("_done"),
        none.alias("_parent"), *CAPABILITIES,
    ).unionByName(parents.select(
        *parent_keys, F.lit(0).alias("_total"), F.lit(0).alias("_done"), F.lit(True).alias("_parent"),
        *[none.alias(c) for c in CAPABILITIES],
    ))
    merged = members.groupBy(*parent_keys).agg(
        F.sum("_total").alias("_total"), F.sum("_done").alias("_done"),
        F.bool_or("_parent").alias("_parent"), *[F.bool_or(c).alias(c) for c in CAPABILITIES],
    ).filter("_parent")
    share = F.when(F.col("_total") > 0, F.col("_done") / F.col("_total")).otherwise(F.lit(1.0))
    return merged.select(
        *parent_keys, *[F.coalesce(c, F.lit(False)).alias(c) for c in CAPABILITIES],
        share.alias("progress"),
    )


def validate_config(entities: DataFrame, cached: DataFrame) -> DataFrame:
    """Results of each config entity from its splits' cached results.

    cached: (kind, dataset, config, split, status, five flags), one row per key. A split without a
    cached row is pending; one with another status than 200 is neither merged nor pending.
    """
    configs = entities.filter(F.col("config").isNotNull() & F.col("split").isNull())
    splits = entities.filter(F.col("config").isNotNull() & F.col("split").isNotNull())
    return _roll_up(
        configs, splits, cached, "split-is-valid", ["dataset", "config"], _ENTITY
    ).withColumn("split", F.lit(None).cast("string"))


def validate_dataset(entities: DataFrame, cached: DataFrame) -> DataFrame:
    """Results of each dataset entity from its configs' cached results."""
    datasets = entities.filter(F.col("config").isNull())
    configs = entities.filter(F.col("config").isNotNull() & F.col("split").isNull())
    return _roll_up(
        datasets, configs, cached, "config-is-valid", ["dataset"], ["dataset", "config"]
    ).withColumns({"config": F.lit(None).cast("string"), "split": F.lit(None).cast("string")})


def validate_batch(
    requests: DataFrame, entities: DataFrame, responses: DataFrame, features: DataFrame,
    cached: DataFrame,
) -> DataFrame:
    """A result per requested entity and level; an unknown config or dataset is no success.

    What is known about an entity is one row per level, so no repeats arise. The catalog goes
    through aggregates only: a shuffle each, after partial sums, and no join before it is reduced.
    """
    columns = [*_ENTITY, *CAPABILITIES, "progress"]
    results = (
        validate_split(requests.distinct(), responses, features).select(*columns)
        .unionByName(validate_config(entities, cached).select(*columns))
        .unionByName(validate_dataset(entities, cached).select(*columns))
    )
    keyed = results.withColumns({
        f"_{c}": F.coalesce(c, F.lit("")) for c in ("config", "split")
    }).drop("config", "split").withColumn(
        "level",
        F.when(F.col("_split") != "", "split").when(F.col("_config") != "", "config")
        .otherwise("dataset"),
    )
    asked = requests.withColumns({
        **{f"_{c}": F.coalesce(c, F.lit("")) for c in ("config", "split")},
        "level": level_of(F.col("config"), F.col("split")),
    })
    return asked.join(keyed, ["dataset", "_config", "_split", "level"], "left").select(
        *_ENTITY, "level", F.col("progress").isNotNull().alias("success"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in CAPABILITIES], "progress",
    )


def batch_totals(results: DataFrame) -> DataFrame:
    return capability_count(results).agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if("success").alias("successful"),
        F.sum("capability_count").alias("total_capabilities"),
    )


def _term_flags() -> dict[str, Column]:
    counted = F.col("count") > 0
    return {
        "viewer": F.lit(True),
        "preview": F.lit(True),
        "search": F.col("term") != "",
        "filter": counted | (F.col("category") != ""),
        "statistics": counted | F.col("first_seen_timestamp").isNotNull(),
    }


def term_split_validity(terms: DataFrame) -> DataFrame:
    """Flags of each term of the index, which is a split of its character group."""
    return terms.select(
        "id", "character_group", *[flag.alias(c) for c, flag in _term_flags().items()]
    )


def group_validity(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """All five flags for a group that has terms, none for one that has not."""
    sizes = terms.groupBy("character_group").agg(F.count(F.lit(1)).alias("_n"))
    return groups.select("character_group").distinct().join(
        sizes, "character_group", "left"
    ).select("character_group", *[F.col("_n").isNotNull().alias(c) for c in CAPABILITIES])


def probe_capabilities(terms: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Dataset flags probed from the first groups, by name.

    Viewer: there are groups at all. Preview: one of the first three has a term. Search, filter
    and statistics look at the first term, by id, of the first group.
    """
    if groups is None:
        groups = terms.select("character_group")
    leading = groups.select("character_group").distinct().orderBy("character_group").limit(3)
    # The first term of a group is the smallest struct, so map-side combining leaves one row per
    # leading group and partition.
    head = F.struct(
        "id", "term", "count", "category", "significance", "prime_factor", "is_power_of_two",
        "first_seen_timestamp", "last_seen_timestamp",
    )
    heads = (
        terms.join(leading, "character_group", "left_semi")
        .groupBy("character_group").agg(F.min(head).alias("t"))
    )
    probed = leading.join(heads, "character_group", "left").agg(
        F.count(F.lit(1)).alias("groups"),
        F.count("t").alias("with_terms"),
        F.min(F.struct("character_group", "t")).getField("t").alias("t"),
    )
    term = F.col("t")
    counted = term["count"] > 0
    flags = {
        "viewer": F.col("groups") > 0,
        "preview": F.col("with_terms") > 0,
        "search": (term["term"] != "") | (term["category"] != "") | (term["significance"] != ""),
        "filter": counted | (term["category"] != "") | term["prime_factor"].isNotNull()
        | term["is_power_of_two"].isNotNull(),
        "statistics": counted | term["first_seen_timestamp"].isNotNull()
        | term["last_seen_timestamp"].isNotNull(),
    }
    return probed.select(*[F.coalesce(f, F.lit(False)).alias(c) for c, f in flags.items()])


def group_by_split(file_info: DataFrame) -> DataFrame:
    """Files, rows and bytes per split; the files of a split stay rows of `file_info`."""
    return file_info.groupBy("split_name").agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("num_rows").alias("num_rows"),
        F.sum("file_size_bytes").alias("size_bytes"),
    )


# Column name parts that make a dataset searchable or give it statistics.
SEARCH_NAMES = ("term", "text", "content")
STATISTICS_NAMES = ("count", "id", "timestamp")


def file_flags() -> dict[str, Column]:
    """The five flags of a Parquet dataset, as aggregates over its file info."""

    def named(parts: Sequence[str]) -> Column:
        return F.exists(
            "columns", lambda c: reduce(lambda a, b: a | b, [c.contains(p) for p in parts])
        )

    flags = {
        "viewer": F.lit(True),
        "preview": F.col("num_rows") > 0,
        "search": named(SEARCH_NAMES),
        "filter": F.size("columns") > 1,
        "statistics": named(STATISTICS_NAMES),
    }
    return {c: F.coalesce(F.bool_or(flag), F.lit(False)) for c, flag in flags.items()}


def assess_capabilities(file_info: DataFrame) -> DataFrame:
    """The five flags of a Parquet dataset from its files' row counts and column names."""
    return file_info.agg(*[flag.alias(c) for c, flag in file_flags().items()])


# How the types of a sample that are not shown are named.
_TYPE_NAMES = {
    "tinyint": "Int8",
    "smallint": "Int16",
    "int": "Int32",
    "float": "Float32",
    "double": "Float64",
    "binary": "Binary",
    "date": "Date32",
    "timestamp": 'Timestamp(Microsecond, Some("UTC"))',
    "timestamp_ntz": "Timestamp(Microsecond, None)",
}


def _shown(name: str, dtype: str) -> Column:
    column = F.col(_quoted(name))
    if dtype in ("string", "bigint", "boolean"):
        text = column.cast("string")
    elif dtype.startswith("array"):
        text = F.lit("[list]")
    else:
        text = F.lit(f"[{_TYPE_NAMES.get(dtype, dtype)}]")
    return F.when(column.isNull(), "null").otherwise(text)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sample_records(df: DataFrame, order: str | Column, k: int = 5, name: str | None = None) -> DataFrame:
    """The first k rows by `order`, a column's name or an expression called `name`, each a map from
    column name to shown value. Columns may have any type and name."""
    place = F.col(_quoted(order)) if isinstance(order, str) else order
    values = [part for n, t in df.dtypes for part in (F.lit(n), _shown(n, t))]
    record = F.create_map(*values) if values else F.create_map().cast("map<string,string>")
    shown = df.select(place.alias(name or order), record.alias("record"))
    return shown.orderBy(F.col(_quoted(name or order))).limit(k)


def phase_dataset_check(records: DataFrame, phases: Sequence[str]) -> DataFrame:
    """Records, distinct files and distinct phase names of each expected phase.

    Phases that have records but were not expected are rows too, with `expected` false.
    """
    wanted = F.array(*[F.lit(p) for p in phases]).cast("array<string>")
    expected = records.sparkSession.createDataFrame([(p,) for p in phases], "phase string")
    found = records.groupBy("phase").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("file_path").alias("files")
    )
    zero = F.lit(0).cast("long")
    return expected.join(found, "phase", "full_outer").select(
        "phase",
        F.coalesce("records", zero).alias("records"),
        F.coalesce("files", zero).alias("files"),
        F.when(F.col("records").isNull(), 0).otherwise(1).alias("phases"),
        F.col("records").isNull().alias("empty"),
        F.coalesce(F.array_contains(wanted, F.col("phase")), F.lit(False)).alias("expected"),
    )


def phase_files_check(
    spark: SparkSession, path: str, phases: Sequence[str], flat: bool = False
) -> DataFrame:
    """Whether each phase's JSON is there and can be read: (phase, state, records, bad_records).

    state: `missing`, `invalid` if some record is no record of the format, else `valid`. Folders are
    phase=<name>, or, if `flat`, <name>-phase with one array in data.json.
    """
    shape = T.StructType([*SEMANTIC_RECORD.fields, T.StructField("_text", T.StringType())])
    reader = spark.read.schema(shape).option("columnNameOfCorruptRecord", "_text")
    expected = spark.createDataFrame([(p,) for p in phases], "phase string")
    base = path.rstrip("/")
    pattern = "*-phase/data.json" if flat else "phase=*/*"
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    name = F.regexp_replace(folder, "-phase$", "") if flat else F.substring_index(folder, "=", -1)
    if not any_path(spark, f"{base}/{pattern}"):
        found = expected.limit(0).select("phase", F.lit(0).alias("records"), F.lit(0).alias("bad_records"))
    else:
        rows = reader.option("multiLine", flat).json(f"{base}/{pattern}")
        # All columns are read, since a reader of fewer would not notice what does not parse.
        bad = F.col("_text").isNotNull() | F.col("id").isNull()
        found = rows.select(name.alias("phase"), bad.alias("_bad"), F.hash(*SEMANTIC_RECORD.names)).groupBy("phase").agg(
            F.count(F.lit(1)).alias("records"), F.count_if("_bad").alias("bad_records")
        )
    zero = F.lit(0).cast("long")
    return expected.join(found, "phase", "left").select(
        "phase",
        F.when(F.col("records").isNull(), "missing").when(F.col("bad_records") > 0, "invalid")
        .otherwise("valid").alias("state"),
        F.coalesce("records", zero).alias("records"),
        F.coalesce("bad_records", zero).alias("bad_records"),
    )


def phase_completeness(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected phases (or phase and level combinations) against the files found for them.

    found: one row per file with the key columns of `expected`, num_rows and file_size_bytes. The
    estimate of 1000 records per MB stands beside the real row count.
    """
    keys = expected.columns
    mb = F.col("file_size_bytes") / (1024 * 1024)
    sums = found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size_bytes").alias("size_bytes"),
        F.sum(F.floor(mb * 1000)).alias("estimated_rows"),
        F.sum("num_rows").alias("num_rows"),
    )
    counts = ["files", "size_bytes", "estimated_rows", "num_rows"]
    return (
        expected.join(sums, keys, "left")
        .withColumn("found", F.col("files").isNotNull())
        .fillna(0, counts)
    )
