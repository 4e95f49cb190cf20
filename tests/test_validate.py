import pytest
from pyspark.sql import functions as F

from strataset.operators import validate
from strataset.schemas import CAPABILITIES

ENTITY = "dataset string, config string, split string"
FLAGS = ", ".join(f"{c} boolean" for c in CAPABILITIES)

# Splits per config, uneven on purpose; the last config has none.
LIBRARY = {
    "weather": {"hourly": ["y2019", "y2020", "y2021"], "daily": ["all"]},
    "birds": {"songs": ["near", "far"], "maps": []},
}
NO_PREVIEW = {("weather", "daily", "all")}
NO_STATISTICS = {("weather", "hourly", "y2020"), ("birds", "songs", "far")}
TEXTLESS = {("birds", "maps"), ("weather", "daily")}  # configs without a column to search
FAILED = {("weather", "hourly", "y2021")}  # cached with another status than 200
NOT_CACHED = {("birds", "songs", "far")}


@pytest.fixture(scope="module")
def catalog(spark):
    entities, responses, features, cached = [], [], [], []
    for dataset, configs in LIBRARY.items():
        entities.append((dataset, None, None))
        for config, splits in configs.items():
            entities.append((dataset, config, None))
            text = (dataset, config) not in TEXTLESS
            features.append((dataset, config, "height", "float"))
            if text:
                features.append((dataset, config, "note", "large_string"))
            responses.append(("config-has-viewer", dataset, config, None, dataset == "weather"))
            cached.append(("config-is-valid", dataset, config, None, 200, True, False, text, True, False))
            for split in splits:
                key = (dataset, config, split)
                entities.append(key)
                if key not in NO_PREVIEW:
                    responses.append(("split-has-preview", *key, True))
                responses.append(("split-has-statistics", *key, key not in NO_STATISTICS))
                if key not in NOT_CACHED:
                    status = 404 if key in FAILED else 200
                    cached.append(("split-is-valid", *key, status, True, True, text, True, key not in NO_STATISTICS))
    return (
        spark.createDataFrame(entities, ENTITY),
        spark.createDataFrame(responses, f"kind string, {ENTITY}, ok boolean"),
        spark.createDataFrame(features, "dataset string, config string, column string, dtype string"),
        spark.createDataFrame(cached, f"kind string, {ENTITY}, status int, {FLAGS}"),
    )


def answers(spark, catalog, *requests):
    asked = spark.createDataFrame(list(requests), ENTITY)
    rows = validate.capability_count(validate.validate_batch(asked, *catalog)).collect()
    return {(r.dataset, r.config, r.split): r for r in rows}


def test_batch_over_the_catalog(spark, catalog):
    got = answers(
        spark, catalog, ("weather", "hourly", "y2020"), ("weather", "daily", "all"), ("weather", "hourly", None),
        ("birds", "songs", None), ("birds", "maps", None), ("birds", None, None),
    )
    assert all(r.success for r in got.values()) and len(got) == 6
    assert got["weather", "hourly", "y2020"].capability_count == 4  # all but statistics
    daily = got["weather", "daily", "all"]
    assert (daily.viewer, daily.preview, daily.search, daily.filter, daily.statistics) == (True, False, False, True, True)
    # Two splits of three merge; the third is cached as failed, so nothing is pending.
    hourly = got["weather", "hourly", None]
    assert (hourly.progress, hourly.capability_count) == (1.0, 5)
    songs = got["birds", "songs", None]
    assert (songs.progress, songs.statistics) == (0.5, True)
    assert (got["birds", "maps", None].progress, got["birds", "maps", None].capability_count) == (1.0, 0)
    assert got["birds", None, None].capability_count == 3


def test_repeated_requests_and_totals(spark, catalog):
    asked = spark.createDataFrame([("weather", "hourly", "y2019")] * 2 + [("weather", None, None)], ENTITY)
    results = validate.validate_batch(asked, *catalog)
    assert tuple(validate.batch_totals(results).first()) == (3, 3, 13)


def test_batch_needs_few_shuffles(spark, catalog):
    asked = spark.createDataFrame([("weather", "hourly", "y2019"), ("birds", None, None)], ENTITY)
    plan = validate.validate_batch(asked, *catalog)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 12


def test_unknown_entities(spark, catalog):
    got = answers(spark, catalog, ("rocks", None, None), ("birds", "eggs", None), ("rocks", "red", "big"))
    # A split is judged by its responses alone, so an unknown one succeeds with nothing.
    assert {k: (r.success, r.progress, r.capability_count) for k, r in got.items()} == {
        ("rocks", None, None): (False, None, 0), ("birds", "eggs", None): (False, None, 0),
        ("rocks", "red", "big"): (True, 1.0, 0),
    }


def test_progress(spark, catalog):
    entities = spark.createDataFrame(
        [("d", "none", None), ("d", "none", "a"), ("d", "empty", None), ("d", "half", None),
         ("d", "half", "a"), ("d", "half", "b"), ("d", None, None)], ENTITY,
    )
    cached = spark.createDataFrame(
        [("split-is-valid", "d", "half", "a", 500, True, True, True, True, True)],
        f"kind string, {ENTITY}, status int, {FLAGS}",
    )
    found = {r.config: r for r in validate.validate_config(entities, cached).collect()}
    assert {c: r.progress for c, r in found.items()} == {"none": 0.0, "empty": 1.0, "half": 0.5}
    assert not found["half"].viewer
    (dataset,) = validate.validate_dataset(entities, cached).collect()
    assert dataset.progress == 0.0 and dataset.config is None


def test_entity_keys(spark):
    entities = spark.createDataFrame([("d", "c", "s"), ("d", "c", None), ("d", None, None)], ENTITY)
    found = {r.level: (r.cache_key, r.display) for r in validate.entity_keys(entities, "k").collect()}
    assert found == {
        "split": ("k:d:c:s", "d/c/s"), "config": ("k:d:c:", "d/c"), "dataset": ("k:d::", "d"),
    }


def test_merge(spark):
    a = spark.createDataFrame([("d", "c", None, True, False, False, False, False)], f"{ENTITY}, {FLAGS}")
    b = spark.createDataFrame([("d", "c", None, False, True, False, False, None)], f"{ENTITY}, {FLAGS}")
    (row,) = validate.merge_capabilities(a, b).collect()
    assert tuple(row) == ("d", "c", None, True, True, False, False, False)


def test_names_are_matched_by_part(spark):
    info = spark.createDataFrame(
        [(["width"], 0)], "columns array<string>, num_rows long"
    )
    (row,) = validate.assess_capabilities(info).collect()
    assert (row.viewer, row.preview, row.search, row.filter, row.statistics) == (
        True, False, False, False, True
    )
    assert not any(validate.assess_capabilities(info.limit(0)).first())


def term_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "id string, character_group string, term string, count long, category string, "
        "significance string, prime_factor long, is_power_of_two boolean, "
        "first_seen_timestamp long, last_seen_timestamp long",
    )


def test_term_flags(spark):
    df = term_frame(spark, [
        ("1", "a", "", 0, "", "", None, None, None, 4), ("2", "a", "x", 0, "c", "", None, None, 3, None),
    ])
    found = {r.id: tuple(r)[2:] for r in validate.term_split_validity(df).collect()}
    assert found["1"] == (True, True, False, False, False)
    assert found["2"] == (True, True, True, True, True)


def test_probe_looks_at_the_first_term(spark):
    df = term_frame(spark, [
        ("2", "a", "x", 9, "c", "s", 2, True, 1, 1), ("1", "a", "", 0, "", "", None, None, None, 4),
        ("0", "b", "x", 9, "c", "s", 2, True, 1, 1),
    ])
    # Statistics also accept the last time a term was seen.
    assert tuple(validate.probe_capabilities(df).first()) == (True, True, False, False, True)
    groups = spark.createDataFrame([(g,) for g in "0123"], "character_group string")
    assert tuple(validate.probe_capabilities(df, groups).first()) == (
        True, False, False, False, False
    )
    assert not any(validate.probe_capabilities(df.limit(0)).first())


def test_groups_without_terms(spark):
    df = term_frame(spark, [("1", "a", "x", 1, "c", "s", 2, True, 1, 1)])
    groups = spark.createDataFrame([("a",), ("z",)], "character_group string")
    found = {r.character_group: tuple(r)[1:] for r in validate.group_validity(df, groups).collect()}
    assert found == {"a": (True,) * 5, "z": (False,) * 5}


def test_sample_shows_values_as_text(spark):
    df = spark.sql(
        "SELECT 2L AS id, 's' AS a, true AS b, array(1) AS c, 1.5D AS d, CAST(NULL AS INT) AS e, "
        "1 AS f UNION ALL SELECT 1L, NULL, false, NULL, NULL, 7, 2"
    )
    first, second = validate.sample_records(df, "id").collect()
    assert first.record == {
        "id": "1", "a": "null", "b": "false", "c": "null", "d": "null", "e": "[Int32]", "f": "[Int32]"
    }
    assert second.record["c"] == "[list]" and second.record["d"] == "[Float64]"


def test_phase_completeness(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "phase string")
    found = spark.createDataFrame(
        [("a", 10, 1024 * 1024), ("a", 5, 1024 * 512), ("other", 1, 1)],
        "phase string, num_rows long, file_size_bytes long",
    )
    rows = {r.phase: r for r in validate.phase_completeness(expected, found).collect()}
    assert (rows["a"].files, rows["a"].num_rows, rows["a"].estimated_rows) == (2, 15, 1500)
    assert not rows["b"].found and rows["b"].files == 0 and set(rows) == {"a", "b"}


def test_phases_that_were_not_expected_are_rows(spark):
    records = spark.createDataFrame([("a", "f"), ("x", "f"), ("x", "g")], "phase string, file_path string")
    found = {r.phase: (r.records, r.files, r.empty, r.expected) for r in validate.phase_dataset_check(records, ["a", "b"]).collect()}
    assert found == {"a": (1, 1, False, True), "b": (0, 0, True, True), "x": (2, 2, False, False)}


def test_sample_takes_any_name_and_type(spark):
    df = spark.sql("SELECT map('k', 1) AS m, 'v' AS `a.b`, array(1) AS `q``t`, CAST(NULL AS STRUCT<x:INT>) AS s")
    (row,) = validate.sample_records(df, F.lit(0), 5, "row").collect()
    assert row.record == {"m": "[map<string,int>]", "a.b": "v", "q`t": "[list]", "s": "null"} and row.row == 0
