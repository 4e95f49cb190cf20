"""Queries for the term index operators and for loading and searching its splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataset.operators import explore, terms as ops
from strataset.plans import views
from strataset.plans.registry import query, table

SAMPLE = 1000
_SHOWN = "id, count, category, character_group"


def terms(spark, sf_dir):
    return ops.term_records(views.raw_terms(spark, sf_dir))


def split_terms(spark, sf_dir):
    return ops.assign_split(terms(spark, sf_dir))


def _shown(df):
    return df.select("id", "count", "category", "character_group")


@query("term_records", f"""
    WITH {views.TERMS}
    SELECT id, term, count, category, significance, vibe, action_suggestion, emoji_representation,
           array_to_string(semantic_names, '|') AS semantic_names, osi_layer, prime_factor,
           is_power_of_two, numerical_address, first_seen_timestamp, last_seen_timestamp,
           character_group
    FROM terms""")
def term_records(spark, sf_dir):
    return terms(spark, sf_dir).withColumn(
        "semantic_names", F.array_join("semantic_names", "|")
    )


@query("character_groups", f"""
    WITH {views.TERMS} SELECT DISTINCT character_group FROM terms ORDER BY 1""")
def character_groups(spark, sf_dir):
    return ops.character_groups(terms(spark, sf_dir))


@query("group_stats", f"""
    WITH {views.TERMS}, per_group AS (
      SELECT character_group, count(*) AS terms FROM terms GROUP BY 1)
    SELECT character_group, terms, CAST(1 AS BIGINT) AS groups FROM per_group
    UNION ALL
    SELECT NULL, CAST(sum(terms) AS BIGINT), count(*) FROM per_group""")
def group_stats(spark, sf_dir):
    return ops.group_stats(terms(spark, sf_dir))


@query("assign_split", f"""
    WITH {views.TERMS} SELECT id, character_group, split FROM split_terms""")
def assign_split(spark, sf_dir):
    return split_terms(spark, sf_dir).select("id", "character_group", "split")


@query("sample_per_group", f"""
    WITH {views.TERMS}, ranked AS (
      SELECT {_SHOWN}, row_number() OVER (PARTITION BY character_group ORDER BY id) AS rank,
             (SELECT count(DISTINCT character_group) FROM terms) AS groups
      FROM terms)
    SELECT {_SHOWN} FROM ranked WHERE rank <= greatest({SAMPLE} // groups, 1)""")
def sample_per_group(spark, sf_dir):
    return _shown(ops.sample_per_group(terms(spark, sf_dir), SAMPLE))


@query("dataset_info", f"""
    WITH {views.TERMS}, splits AS (
      SELECT unnest(['train', 'validation', 'test']) AS split),
    sizes AS (
      SELECT s.split, count(t.id) AS num_examples
      FROM splits s LEFT JOIN split_terms t ON s.split = t.split GROUP BY s.split),
    listed AS (
      SELECT split, num_examples FROM sizes
      UNION ALL SELECT 'total', CAST(sum(num_examples) AS BIGINT) FROM sizes)
    SELECT split, num_examples, num_examples * 200 AS num_bytes FROM listed""")
def dataset_info(spark, sf_dir):
    return ops.dataset_info(terms(spark, sf_dir))


@query("list_null_to_empty", f"""
    WITH {views.TERMS}
    SELECT id, CAST(coalesce(len(semantic_names), 0) AS INTEGER) AS names FROM terms""")
def list_null_to_empty(spark, sf_dir):
    filled = ops.list_null_to_empty(terms(spark, sf_dir), "semantic_names")
    return filled.select("id", F.size("semantic_names").alias("names"))


@query("lookup_term", f"""
    WITH {views.TERMS}, wanted AS (
      SELECT DISTINCT lower(unnest(regexp_extract_all(text, '([^ \\n\\t.,|]+)', 1))) AS id
      FROM benchmark)
    SELECT {_SHOWN} FROM terms WHERE id IN (SELECT id FROM wanted)""")
def lookup_term(spark, sf_dir):
    found = F.expr(r"regexp_extract_all(text, r'([^ \n\t.,|]+)', 1)")
    wanted = table(spark, sf_dir, "benchmark").select(F.explode(found).alias("word"))
    ids = wanted.select(F.lower("word").alias("id"))
    return _shown(ops.lookup_term(terms(spark, sf_dir), ids))


@query("term_features", f"""
    WITH {views.TERMS}, features AS (
      SELECT * FROM (VALUES
        ('term', 'string'), ('count', 'int32'), ('category', 'string'),
        ('significance', 'string'), ('vibe', 'string'), ('action_suggestion', 'string'),
        ('emoji_representation', 'string'), ('osi_layer', 'string'), ('prime_factor', 'int64'),
        ('is_power_of_two', 'boolean'), ('numerical_address', 'string'),
        ('first_seen_timestamp', 'int64'), ('last_seen_timestamp', 'int64')) AS f("column", dtype)),
    sizes AS (SELECT character_group, count(*) AS num_rows FROM terms GROUP BY 1)
    SELECT character_group, num_rows, "column", dtype FROM sizes, features""")
def term_features(spark, sf_dir):
    return ops.term_features(terms(spark, sf_dir))


@query("list_splits", f"""
    WITH {views.TERMS} SELECT DISTINCT split FROM split_terms""")
def list_splits(spark, sf_dir):
    return explore.list_splits(split_terms(spark, sf_dir))


@query("load_split", f"""
    WITH {views.TERMS} SELECT {_SHOWN} FROM split_terms WHERE split = 'test'""")
def load_split(spark, sf_dir):
    return _shown(explore.load_split(split_terms(spark, sf_dir), "test"))


@query("split_stats", f"""
    WITH {views.TERMS} SELECT split, count(*) AS examples FROM split_terms GROUP BY split""")
def split_stats(spark, sf_dir):
    return explore.split_stats(split_terms(spark, sf_dir))


@query("filter_examples", f"""
    WITH {views.TERMS} SELECT {_SHOWN} FROM split_terms WHERE split = 'train' AND count > 20""")
def filter_examples(spark, sf_dir):
    return _shown(explore.filter_examples(split_terms(spark, sf_dir), "train", F.col("count") > 20))


@query("search_by_term", f"""
    WITH {views.TERMS}
    SELECT {_SHOWN} FROM split_terms
    WHERE split = 'train' AND contains(lower(term), lower('TION'))""")
def search_by_term(spark, sf_dir):
    return _shown(explore.search_by_term(split_terms(spark, sf_dir), "train", "TION"))


@query("search_by_term_literal_percent", f"""
    WITH {views.TERMS}
    SELECT {_SHOWN} FROM split_terms WHERE split = 'test' AND contains(lower(term), '%')""")
def search_by_term_literal_percent(spark, sf_dir):
    return _shown(explore.search_by_term(split_terms(spark, sf_dir), "test", "%"))


@query("by_character_group", f"""
    WITH {views.TERMS}
    SELECT {_SHOWN} FROM split_terms WHERE split = 'train' AND character_group = 'r'""")
def by_character_group(spark, sf_dir):
    return _shown(explore.by_character_group(split_terms(spark, sf_dir), "train", "r"))


@query("head_examples", f"""
    WITH {views.TERMS}
    SELECT {_SHOWN} FROM split_terms WHERE split = 'train' ORDER BY id LIMIT 5""")
def head_examples(spark, sf_dir):
    train = explore.load_split(split_terms(spark, sf_dir), "train")
    return _shown(explore.head_examples(train, 5))
