"""Queries for capability validation of the catalog and of the term index."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataset.operators import semantic, validate as ops
from strataset.plans import semantic_queries as sem, views
from strataset.plans.registry import query, table
from strataset.plans.term_queries import terms
from strataset.schemas import CAPABILITIES, SEMANTIC_PHASES

_FLAGS = "viewer, preview, search, filter, statistics"
_OR_FLAGS = ", ".join(f"coalesce(bool_or({c} AND status = 200), false) AS {c}" for c in CAPABILITIES)
_COUNT = " + ".join(f"CAST({c} AS INTEGER)" for c in CAPABILITIES)

_SPLITS = """split_results AS (
  SELECT e.dataset, e.config, e.split, coalesce(v.ok, false) AS viewer,
         coalesce(p.ok, false) AS preview, coalesce(f.searchable, false) AS search,
         f.config IS NOT NULL AS filter, coalesce(s.ok, false) AS statistics,
         CAST(1 AS DOUBLE) AS progress
  FROM entities e
  LEFT JOIN responses v ON v.kind = 'config-has-viewer' AND v.config = e.config
  LEFT JOIN responses p ON p.kind = 'split-has-preview' AND p.config = e.config
                       AND p.split = e.split
  LEFT JOIN responses s ON s.kind = 'split-has-statistics' AND s.config = e.config
                       AND s.split = e.split
  LEFT JOIN (SELECT dataset, config, bool_or(contains(dtype, 'string') OR contains(dtype, 'text'))
               AS searchable FROM features GROUP BY 1, 2) f
    ON f.dataset = e.dataset AND f.config = e.config
  WHERE e.split IS NOT NULL)"""
_CONFIGS = f"""config_results AS (
  SELECT e.dataset, e.config, CAST(NULL AS VARCHAR) AS split, {_OR_FLAGS},
         count(c.kind) / CAST(count(*) AS DOUBLE) AS progress
  FROM entities e LEFT JOIN cached c
    ON c.dataset = e.dataset AND c.config = e.config AND c.split = e.split
  WHERE e.split IS NOT NULL GROUP BY e.dataset, e.config)"""
_DATASETS = f"""dataset_results AS (
  SELECT dataset, CAST(NULL AS VARCHAR) AS config, CAST(NULL AS VARCHAR) AS split,
         {", ".join(f"bool_or({c}) AS {c}" for c in CAPABILITIES)}, CAST(1 AS DOUBLE) AS progress
  FROM config_results GROUP BY dataset)"""
_BATCH = f"""{views.CATALOG}, {_SPLITS}, {_CONFIGS}, {_DATASETS},
batch AS (
  SELECT dataset, config, split, 'split' AS level, true AS success, {_FLAGS}, progress
  FROM split_results
  UNION ALL SELECT dataset, config, split, 'config', true, {_FLAGS}, progress FROM config_results
  UNION ALL SELECT dataset, config, split, 'dataset', true, {_FLAGS}, progress FROM dataset_results
  UNION ALL SELECT DISTINCT 'documents', concat(lang, '-unknown'), CAST(NULL AS VARCHAR), 'config',
                   false, false, false, false, false, false, CAST(NULL AS DOUBLE) FROM documents)"""


def split_results(spark, sf_dir):
    return ops.validate_split(
        views.entities(spark, sf_dir), views.responses(spark, sf_dir),
        views.features(spark, sf_dir),
    )


def config_results(spark, sf_dir):
    return ops.validate_config(views.entities(spark, sf_dir), views.cached(spark, sf_dir))


def all_cached(spark, sf_dir):
    """The cached split results, and the config results as they would be cached."""
    configs = config_results(spark, sf_dir).select(
        F.lit("config-is-valid").alias("kind"), "dataset", "config", "split",
        F.lit(200).alias("status"), *CAPABILITIES,
    )
    return views.cached(spark, sf_dir).unionByName(configs)


def batch(spark, sf_dir):
    known = views.entities(spark, sf_dir)
    unknown = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("dataset"),
        F.concat("lang", F.lit("-unknown")).alias("config"),
        F.lit(None).cast("string").alias("split"),
    ).distinct()
    return ops.validate_batch(
        known.unionByName(unknown), known, views.responses(spark, sf_dir),
        views.features(spark, sf_dir), all_cached(spark, sf_dir),
    )


@query("validate_split", f"WITH {views.CATALOG}, {_SPLITS} SELECT * FROM split_results")
def validate_split(spark, sf_dir):
    return split_results(spark, sf_dir)


@query("validate_config", f"WITH {views.CATALOG}, {_CONFIGS} SELECT * FROM config_results")
def validate_config(spark, sf_dir):
    return config_results(spark, sf_dir)


@query("validate_dataset", f"""
    WITH {views.CATALOG}, {_CONFIGS}, {_DATASETS} SELECT * FROM dataset_results""")
def validate_dataset(spark, sf_dir):
    return ops.validate_dataset(views.entities(spark, sf_dir), all_cached(spark, sf_dir))


@query("capability_count", f"""
    WITH {views.CATALOG}, {_SPLITS}
    SELECT dataset, config, split, {_COUNT} AS capability_count FROM split_results""")
def capability_count(spark, sf_dir):
    counted = ops.capability_count(split_results(spark, sf_dir))
    return counted.select("dataset", "config", "split", "capability_count")


@query("merge_capabilities", f"""
    WITH {views.CATALOG}, {_SPLITS}, both_results AS (
      SELECT dataset, config, split, {_FLAGS} FROM split_results
      UNION ALL SELECT dataset, config, split, {_FLAGS} FROM cached)
    SELECT dataset, config, split, {", ".join(f"bool_or({c}) AS {c}" for c in CAPABILITIES)}
    FROM both_results GROUP BY 1, 2, 3""")
def merge_capabilities(spark, sf_dir):
    return ops.merge_capabilities(split_results(spark, sf_dir), views.cached(spark, sf_dir))


@query("entity_keys", f"""
    WITH {views.CATALOG}
    SELECT dataset, config, split,
           CASE WHEN split IS NOT NULL THEN 'split' WHEN config IS NOT NULL THEN 'config'
                ELSE 'dataset' END AS level,
           concat('split-is-valid:', dataset, ':', coalesce(config, ''), ':', coalesce(split, ''))
             AS cache_key,
           concat_ws('/', dataset, config, split) AS display
    FROM entities""")
def entity_keys(spark, sf_dir):
    return ops.entity_keys(views.entities(spark, sf_dir), "split-is-valid")


@query("validate_batch", f"WITH {_BATCH} SELECT * FROM batch")
def validate_batch(spark, sf_dir):
    return batch(spark, sf_dir)


@query("validate_batch_totals", f"""
    WITH {_BATCH}
    SELECT count(*) AS entities, count(*) FILTER (WHERE success) AS successful,
           CAST(sum({_COUNT}) AS BIGINT) AS total_capabilities
    FROM batch""")
def validate_batch_totals(spark, sf_dir):
    return ops.batch_totals(batch(spark, sf_dir))


@query("term_split_validity", f"""
    WITH {views.TERMS}
    SELECT id, character_group, true AS viewer, true AS preview, term <> '' AS search,
           count > 0 OR category <> '' AS filter,
           count > 0 OR first_seen_timestamp IS NOT NULL AS statistics
    FROM terms""")
def term_split_validity(spark, sf_dir):
    return ops.term_split_validity(terms(spark, sf_dir))


@query("group_validity", f"""
    WITH {views.TERMS}, expected AS (
      SELECT DISTINCT substr(p_name, 1, 1) AS character_group FROM part
      UNION SELECT DISTINCT substr(p_brand, 1, 1) FROM part
      UNION SELECT DISTINCT character_group FROM terms),
    held AS (SELECT DISTINCT character_group FROM terms)
    SELECT e.character_group, h.character_group IS NOT NULL AS viewer,
           h.character_group IS NOT NULL AS preview, h.character_group IS NOT NULL AS search,
           h.character_group IS NOT NULL AS filter, h.character_group IS NOT NULL AS statistics
    FROM expected e LEFT JOIN held h USING (character_group)""")
def group_validity(spark, sf_dir):
    held = terms(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    expected = part.selectExpr("substr(p_name, 1, 1) AS character_group").unionByName(
        part.selectExpr("substr(p_brand, 1, 1) AS character_group")
    ).unionByName(held.select("character_group"))
    return ops.group_validity(held, expected)


@query("probe_capabilities", f"""
    WITH {views.TERMS}, first_term AS (
      SELECT * FROM terms ORDER BY character_group, id LIMIT 1)
    SELECT true AS viewer, true AS preview,
           term <> '' OR category <> '' OR significance <> '' AS search,
           count > 0 OR category <> '' OR prime_factor IS NOT NULL
             OR is_power_of_two IS NOT NULL AS filter,
           count > 0 OR first_seen_timestamp IS NOT NULL
             OR last_seen_timestamp IS NOT NULL AS statistics
    FROM first_term""")
def probe_capabilities(spark, sf_dir):
    return ops.probe_capabilities(terms(spark, sf_dir))


@query("indexable_columns", f"""
    WITH {views.CATALOG}
    SELECT dataset, config, bool_or(contains(dtype, 'string') OR contains(dtype, 'text'))
             AS indexable
    FROM features GROUP BY dataset, config""")
def indexable_columns(spark, sf_dir):
    return ops.indexable_columns(views.features(spark, sf_dir))


@query("sample_records", """
    WITH sample AS (SELECT * FROM documents ORDER BY doc_id LIMIT 5),
    shown AS (
      SELECT doc_id, 'doc_id' AS "column", CAST(doc_id AS VARCHAR) AS value FROM sample
      UNION ALL SELECT doc_id, 'text', coalesce(text, 'null') FROM sample
      UNION ALL SELECT doc_id, 'lang', coalesce(lang, 'null') FROM sample
      UNION ALL SELECT doc_id, 'source', coalesce(source, 'null') FROM sample
      UNION ALL SELECT doc_id, 'n_chars', coalesce(CAST(n_chars AS VARCHAR), 'null') FROM sample)
    SELECT doc_id, "column", value FROM shown""")
def sample_records(spark, sf_dir):
    sample = ops.sample_records(table(spark, sf_dir, "documents"), "doc_id")
    return sample.select("doc_id", F.explode("record").alias("column", "value"))


_EXPECTED = [p for p in SEMANTIC_PHASES if p != "type_inference"]


@query("phase_dataset_check", f"""
    WITH {views.CORPUS_LINES}, {sem._PHASED}, expected AS (
      SELECT unnest({_EXPECTED}) AS phase),
    found AS (SELECT phase, count(*) AS records, count(DISTINCT file_path) AS files
              FROM phased GROUP BY phase)
    SELECT e.phase, coalesce(f.records, 0) AS records, coalesce(f.files, 0) AS files,
           CASE WHEN f.phase IS NULL THEN 0 ELSE 1 END AS phases, f.phase IS NULL AS empty,
           true AS expected
    FROM expected e LEFT JOIN found f ON e.phase = f.phase
    UNION ALL SELECT phase, records, files, 1, false, false FROM found
              WHERE phase NOT IN (SELECT phase FROM expected)""")
def phase_dataset_check(spark, sf_dir):
    """One phase that has records is not among those expected."""
    found = semantic.phase_records(views.corpus_lines(spark, sf_dir), SEMANTIC_PHASES)
    return ops.phase_dataset_check(found, _EXPECTED)
