"""Queries on tables where one key of each kind holds a third of the rows."""

import glob
import os

import duckdb
import pytest

from strataset import plans
from tests.test_queries import SF_DIR, ordered

QUERIES, ORACLES = plans.queries(), plans.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# Columns that take the same value in every third row.
HOT = {
    "lineitem": "CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN n % 3 = 1 THEN 3 ELSE l_partkey END AS l_partkey",
    "orders": "CASE WHEN n % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey",
    "part": "CASE WHEN n % 3 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand",
    "events": "CASE WHEN n % 3 = 0 THEN 1 ELSE user_id END AS user_id",
    "documents": "CASE WHEN n % 3 = 0 THEN repeat(concat('hot words', chr(10)), 90) ELSE text END "
                 "AS text, CASE WHEN n % 3 = 0 THEN 'src1' ELSE source END AS source, "
                 "CASE WHEN n % 3 = 0 THEN 'en' ELSE lang END AS lang",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{SF_DIR}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        numbered = f"(SELECT *, row_number() OVER () AS n FROM '{path}')"
        changed = f" REPLACE ({HOT[name]})" if name in HOT else ""
        con.execute(
            f"COPY (SELECT * EXCLUDE (n) FROM (SELECT *{changed} FROM {numbered})) "
            f"TO '{folder}/{name}.parquet'"
        )
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", [
    "parsing_records", "line_context", "processing_order", "run_phases", "dependency_counts",
    "dependency_detail", "dependency_json", "unify_project_records", "project_totals",
    "ecosystem_enrich", "source_metrics", "version_history", "optimization_compare",
    "level_summary", "term_records", "sample_per_group", "chunk_plan", "group_stats",
    "validate_split", "validate_batch", "write_phase_parquet", "write_split_parquet",
    "dedup_records", "incremental_extract", "completeness_check",
])
def test_hot_keys(spark, skewed, name):
    folder, con = skewed
    df = QUERIES[name](spark, folder)
    result = con.execute(ORACLES[name])
    expected = ordered([c[0] for c in result.description], result.fetchall())
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_hot_package_has_several_parts(spark, skewed):
    rows = QUERIES["dependency_json"](spark, skewed[0]).filter("pkg_id = 7").count()
    assert rows > 1000
