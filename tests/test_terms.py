from pyspark.sql import functions as F

from strataset.operators import explore, terms

COLUMNS = "id string, character_group string"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_split_is_told_by_the_first_character(spark):
    df = frame(spark, [("1", "a"), ("2", "Z"), ("3", "7"), ("4", "é"), ("5", "_"), ("6", ""), ("7", "ß")])
    found = {r.id: r.split for r in terms.assign_split(df).collect()}
    assert found == {
        "1": "train", "2": "train", "3": "validation", "4": "test", "5": "test", "6": "train",
        "7": "test",
    }


def test_sample_takes_at_least_one_per_group(spark):
    df = frame(spark, [(f"{g}{i:02}", g) for g in "abcdefghij" for i in range(5)])
    assert sorted(r.id for r in terms.sample_per_group(df, 5).collect()) == [
        f"{g}00" for g in "abcdefghij"
    ]
    assert terms.sample_per_group(df, 30).count() == 30
    assert terms.sample_per_group(df.limit(0), 30).isEmpty()


def test_sample_of_a_hot_group_is_exact(spark):
    df = frame(spark, [(f"{i:05}", "hot") for i in range(3000)] + [("x", "cold")])
    found = sorted(r.id for r in terms.sample_per_group(df, 40, salts=7).collect())
    assert found == [f"{i:05}" for i in range(20)] + ["x"]


def test_large_samples_are_numbered(spark):
    df = frame(spark, [(f"{i:05}", "hot") for i in range(3000)] + [("x", "cold")])
    found = sorted(r.id for r in terms.sample_per_group(df, 4000).collect())
    assert found == [f"{i:05}" for i in range(2000)] + ["x"]


def test_stats_list_empty_groups(spark):
    df = frame(spark, [("1", "a"), ("2", "a"), ("3", "b")])
    groups = spark.createDataFrame([("a",), ("b",), ("c",)], "character_group string")
    found = {r.character_group: (r.terms, r.groups) for r in terms.group_stats(df, groups).collect()}
    assert found == {"a": (2, 1), "b": (1, 1), "c": (0, 1), None: (3, 3)}


def test_dataset_info_lists_every_split(spark):
    found = {
        r.split: (r.num_examples, r.num_bytes)
        for r in terms.dataset_info(frame(spark, [("1", "a"), ("2", "-")])).collect()
    }
    assert found == {
        "train": (1, 200), "validation": (0, 0), "test": (1, 200), "total": (2, 400)
    }


def test_null_list_becomes_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ["x"])], "i int, names array<string>")
    filled = terms.list_null_to_empty(df, "names").orderBy("i").collect()
    assert [r.names for r in filled] == [[], ["x"]]


def test_lookup_prefers_the_first_group(spark):
    df = spark.createDataFrame(
        [("1", "b", "late"), ("1", "a", "early"), ("2", "c", "other")],
        "id string, character_group string, term string",
    )
    ids = spark.createDataFrame([("1",), ("1",), ("9",)], "id string")
    assert [tuple(r) for r in terms.lookup_term(df, ids).collect()] == [("1", "a", "early")]


def test_search_has_no_wildcards(spark):
    df = spark.createDataFrame(
        [("50%", "train"), ("Rust", "train"), ("a_b", "train"), ("rust", "test")],
        "term string, split string",
    )

    def search(text):
        return sorted(r.term for r in explore.search_by_term(df, "train", text).collect())

    assert search("%") == ["50%"]
    assert search("_") == ["a_b"]
    assert search("rUST") == ["Rust"]
    assert explore.filter_examples(df, "train", F.length("term") == 4).count() == 1


def test_unparsable_payload_counts_as_unknown(spark):
    df = spark.createDataFrame(
        [('{"inferred_type":"bool"}',), ("{}",), (None,), ("oops",)], "type_data string"
    )
    found = {r.inferred_type: r.records for r in explore.type_patterns(df).collect()}
    assert found == {"bool": 1, "unknown": 3}
