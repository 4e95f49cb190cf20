"""Every registered query against its SQL, and what its plan may not contain."""

import glob
import math
import os
import re

import duckdb
import pytest

from strataset import plans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = plans.queries(), plans.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def ordered(columns, rows):
    names = sorted(columns)
    index = [columns.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in index) for r in rows), key=repr)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    expected = ordered([c[0] for c in result.description], result.fetchall())
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The window with k = 1000 // groups is limited ahead of the shuffle, in both of its steps.
@pytest.mark.parametrize(
    ("name", "limits"), [("sample_per_group", 4), ("dedup_records", 2), ("optimization_compare", 4)]
)
def test_ranks_are_limited_before_the_shuffle(spark, name, limits):
    assert len(re.findall(r"WindowGroupLimit", plan_of(QUERIES[name](spark, SF_DIR)))) >= limits


def test_one_scan_makes_all_phases(spark):
    from strataset.operators.semantic import run_phases
    from strataset.plans.views import code_lines

    records = run_phases(code_lines(spark, SF_DIR), "parsing,name_resolution,type_inference")
    assert plan_of(records).count("FileScan") == 1
    assert "Exchange" not in plan_of(records)
    # Counting does not build the payloads.
    assert "to_json" not in plan_of(records.groupBy("phase").count())


def test_numbering_moves_no_records(spark):
    """Neither contents nor lines and records are shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["processing_order"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Generate" in plan and "Exchange" not in plan


def test_columns_and_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["version_history"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)" in plan_of(
        QUERIES["dependency_counts"](spark, SF_DIR)
    )


def test_rows_are_never_sorted_or_numbered_in_one_task(spark):
    """A single partition may only take partial aggregates, or rows that are already limited."""
    for name in sorted(QUERIES):
        if name in ("first_file_sample",):
            continue
        lines = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = lines[i + 1]
                assert re.search(r"Aggregate|Limit|Window", below), (name, below)
