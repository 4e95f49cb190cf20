"""Transitive dependencies and as-of joins against plain versions."""

import random
import re
from bisect import bisect_right

import numpy as np

from pyspark.sql import functions as F

from strataset.functions.asof import as_of, fill_forward
from strataset.operators import graph
from strataset.operators.graph import reachable, transitive_counts


def plain_reach(edges):
    steps = {}
    for a, b in edges:
        if a is not None and b is not None:
            steps.setdefault(a, set()).add(b)
    out = {}
    for start in steps:
        depth, frontier, seen = 1, steps[start], set()
        while frontier:
            out |= {(start, x): depth for x in frontier}
            seen |= frontier
            frontier = {y for x in frontier for y in steps.get(x, ())} - seen
            depth += 1
    return out


def test_reachable_equals_a_search(spark):
    pick = random.Random(2)
    edges = [(f"n{pick.randrange(60)}", f"n{pick.randrange(60)}") for _ in range(90)]
    edges += [(f"c{i}", f"c{(i + 1) % 9}") for i in range(9)] + [("self", "self"), (None, "n1"), ("n1", None)] + edges[:5]
    edges += [(f"user{i}", "hot") for i in range(120)] + [("hot", "n1")]  # one that a third of all need
    df = spark.createDataFrame(edges, "package string, dependency string")
    pairs = plain_reach(edges)
    assert {(r.package, r.dependency): r.depth for r in reachable(df).collect()} == pairs
    names = sorted({x for e in edges for x in e if x}) + ["alone"]
    packages = spark.createDataFrame([(n,) for n in [*names, None, names[0]]], "package string")
    got = {r.package: r for r in transitive_counts(packages, df).collect()}
    assert set(got) == {*names, None}
    for n in names:
        own = {b: d for (a, b), d in pairs.items() if a == n and b != n}
        r = got[n]
        assert (r.direct, r.transitive, r.depth) == (sum(d == 1 for d in own.values()), len(own), max(own.values(), default=0))
        assert r.in_cycle == ((n, n) in pairs) and r.dependents == sum(b == n and a != n for a, b in pairs)
    assert reachable(df.limit(0)).count() == 0


def test_rounds_move_the_last_pairs_only_and_buckets_stay_small(spark, monkeypatch):
    monkeypatch.setattr(graph, "_BUCKET_EDGES", 40)
    monkeypatch.setattr(graph, "_ROWS", 16)
    pick, read, plain = random.Random(7), [], graph._add_round

    def add_round(session, pairs, path, depth, buckets):
        read.append({int(d) for f in pairs.inputFiles() for d in re.findall(r"depth=(\d+)", f)})
        frontier = plain(session, pairs, path, depth, buckets)
        sizes = [r["count"] for r in session.read.parquet(f"{path}/depth=1").groupBy("bucket").count().collect()]
        assert buckets > 5 and len(sizes) > 5 and max(sizes) < sum(sizes) // 2
        return frontier

    monkeypatch.setattr(graph, "_add_round", add_round)
    edges = [(f"n{pick.randrange(90)}", f"n{pick.randrange(90)}") for _ in range(120)] + [("all", f"n{i}") for i in range(90)]
    edges += [(f"c{i}", f"c{(i + 1) % 12}") for i in range(12)] + [(f"user{i}", "n1") for i in range(40)]
    pairs = plain_reach(edges)
    df = spark.createDataFrame(edges, "package string, dependency string")
    assert {(r.package, r.dependency): r.depth for r in reachable(df).collect()} == pairs
    assert len(read) > 10 and read == [set(), *[{d} for d in range(1, len(read))]]  # no earlier round is read again
    names = sorted({x for e in edges for x in e})
    packages = spark.createDataFrame([(n,) for n in names], "package string")
    got = {r.package: tuple(r)[1:] for r in transitive_counts(packages, df).collect()}
    for n in names:
        own = {b: d for (a, b), d in pairs.items() if a == n and b != n}
        dependents = sum(b == n and a != n for a, b in pairs)
        assert got[n] == (sum(d == 1 for d in own.values()), len(own), dependents, max(own.values(), default=0), (n, n) in pairs)


def test_known_pairs_are_taken_out_of_sorted_ones():
    keys = np.array([1, 4, 6, 9, 12])
    known = [(1, np.array([4, 9])), (2, np.array([0, 20])), (3, np.array([12]))]
    assert graph._unknown(keys, iter(known)).tolist() == [1, 6]
    assert graph._different(np.array([3, 1, 3])).tolist() == [1, 3] and not len(graph._different(keys[:0]))


def test_as_of_equals_a_search(spark):
    pick = random.Random(6)
    facts = [(pick.choice(["a", "b", "hot", "hot", "hot", None]), pick.choice([None, *range(500)]), pick.randrange(50)) for _ in range(900)]
    rows = [(i, pick.choice(["a", "b", "hot", "hot", "hot", None, "none"]), pick.choice([None, *range(-20, 520)]), "k", "r") for i in range(2000)]
    found = as_of(
        spark.createDataFrame(rows, "id int, project string, ts int, key string, row string").repartition(6),
        spark.createDataFrame(facts, "project string, taken int, stars int").repartition(5), "project", "ts", "taken",
    )
    per_key = {}
    for k, t, s in facts:
        if t is not None:
            per_key.setdefault(k, {})[t] = max(s, per_key.get(k, {}).get(t, s))
    got = {r.id: r for r in found.collect()}
    assert len(got) == len(rows)
    for i, k, t, *_ in rows:
        known = sorted(per_key.get(k, {}))
        at = bisect_right(known, t) if t is not None else 0
        expected = (known[at - 1], per_key[k][known[at - 1]]) if at else None
        assert (tuple(got[i].fact) if got[i].fact else None) == expected and got[i].key == "k" and got[i].row == "r"


def test_a_hot_key_is_cut_into_ranges(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id",
        F.when(F.col("id") % 7000 == 1, F.col("id")).alias("fact"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        filled = fill_forward(df, ["k"], [F.col("id")], "fact")
        hot = [r.fact for r in filled.filter("k = 'hot'").orderBy("id").collect()]
        marks = [i if i % 7000 == 1 else None for i in range(40_000) if i % 3 > 0]
        last, expected = None, []
        for m in marks:
            last = m if m is not None else last
            expected.append(last)
        assert hot == expected
        assert max(r["count"] for r in filled.groupBy(F.spark_partition_id()).count().collect()) < 15_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
