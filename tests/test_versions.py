"""Semantic versions against a plain comparison in Python."""

import random
import re

import pytest

from strataset.operators.versions import resolve_versions, version_key
from pyspark.sql import functions as F

SEMVER = re.compile(r"(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:-([0-9A-Za-z.-]+))?(?:\+[0-9A-Za-z.-]+)?")


def parsed(text):
    m = SEMVER.fullmatch(text or "")
    if not m or "" in (m[4] or "x").split("."):
        return None
    pre = tuple((0, int(p), "") if p.isdigit() else (1, 0, p) for p in m[4].split(".")) if m[4] else ()
    return (*map(int, m.groups()[:3]), not pre, pre)


def allows(requirement, version):
    """Every comparator holds, and a pre-release is named by one of them."""
    triple, named = version[:3], False
    for part in requirement.split(","):
        m = re.fullmatch(r"\s*(\^|~|>=|<=|>|<|=|)\s*(\d+|\*)(?:\.(\d+|\*))?(?:\.(\d+|\*))?(?:-([0-9A-Za-z.-]+))?\s*", part)
        if not m:
            return False
        op, star = m[1], "*" in m.group(2, 3, 4)
        given = [x not in (None, "*") for x in m.group(2, 3, 4)]
        if given != sorted(given, reverse=True):
            return False
        nums = [int(x) for x in m.group(2, 3, 4) if x not in (None, "*")]
        low = parsed(".".join(map(str, [*nums, 0, 0, 0][:3])) + (f"-{m[5]}" if m[5] else ""))
        named |= bool(m[5]) and triple == low[:3]

        def bump(k):
            return (*nums[:k], nums[k] + 1, *[0] * (2 - k), True, ())

        top = (float("inf"),)
        beyond = bump(len(nums) - 1) if nums else top
        if op in ("", "^") and not (op == "" and star):
            k = next((i for i, x in enumerate(nums) if x), len(nums) - 1)
            ok = low <= version < (bump(k) if nums else top)
        elif op == "~":
            ok = low <= version < (bump(min(1, len(nums) - 1)) if nums else top)
        elif op in ("", "="):
            ok = version == low if len(nums) == 3 else low <= version < beyond
        elif op == ">":
            ok = version > low if len(nums) == 3 else version >= beyond
        elif op == ">=":
            ok = version >= low
        elif op == "<":
            ok = version < low
        else:
            ok = version <= low if len(nums) == 3 else version < beyond
        if not ok:
            return False
    return named or version[3]


def best(requirement, versions):
    fit = [(parsed(v), v) for v in versions if parsed(v) and requirement and allows(requirement, parsed(v))]
    return max(fit)[1] if fit else None


def test_keys_sort_as_versions(spark):
    texts = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-alpha.beta", "1.0.0-beta", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0-rc.1",
             "1.0.0", "1.0.1-0", "1.0.1", "1.2.0", "1.10.0", "2.0.0-a-b", "2.0.0-a.b", "18446744073709551615.0.0"]
    df = spark.createDataFrame([(t,) for t in [*texts, "1.0", "01.0.0", "1.0.0-", "x", None, "1.0.0-a..b"]], "v string")
    got = [r.v for r in df.withColumn("k", version_key(F.col("v"))).filter("k IS NOT NULL").orderBy("k").collect()]
    assert got == sorted(texts, key=parsed) and len(got) == len(texts)


CASES = ["^1.2.3", "1.2", "1", "0", "0.0", "0.0.3", "^0.2.1", "~1", "~1.2", "~1.2.3", "1.*", "1.2.*", "*", "=1.2", "= 1.2.3", ">1", ">1.2",
         ">1.2.3", ">=1.2, <2", "<=1", "<=1.2.3", "<1.2.3", "<0", "1.2.3-rc.1", ">=1.2.3-rc.1, <1.2.3", "~0.2.0-alpha", "=2.0.0-rc.2",
         ">=0.1, <0.1", "latest", "", "1.*.3", "^", ">=1,", None]


def test_requirements_equal_brute_force(spark):
    pick = random.Random(9)
    rows = set()
    for name in ("a", "b", "hot"):
        for _ in range(600 if name == "hot" else 60):
            pre = pick.choice(["", "", "", "-alpha", "-rc.1", "-rc.2", "-rc.10", "+b1", "-0"])
            rows.add((name, f"{pick.randrange(3)}.{pick.randrange(4)}.{pick.randrange(5)}{pre}"))
    rows |= {("a", "nonsense"), ("a", None), (None, "1.0.0"), ("b", "1.2")}
    random_cases = [
        f"{pick.choice(['', '^', '~', '=', '>', '>=', '<', '<='])}{pick.randrange(3)}.{pick.randrange(4)}" + pick.choice(["", f".{pick.randrange(5)}", f".{pick.randrange(5)}-rc.1"])
        for _ in range(150)
    ]
    decl = [(i, n, r, "x", 1) for i, (n, r) in enumerate((n, r) for n in ("a", "b", "hot", "none", None) for r in [*CASES, *random_cases])]
    df = spark.createDataFrame(decl, "id int, dep_name string, version_req string, name string, fact int")
    found = resolve_versions(df.repartition(5), spark.createDataFrame(list(rows), "name string, version string").repartition(7))
    assert found.columns == [*df.columns, "resolved_version"]
    per_name = {n: [v for m, v in rows if m == n] for n in ("a", "b", "hot", "none", None)}
    got = {r.id: r.resolved_version for r in found.collect()}
    assert len(got) == len(decl)
    for i, name, requirement, *_ in decl:
        assert got[i] == (best(requirement, per_name[name]) if name else None), (name, requirement)


def test_builds_and_empty_tables(spark):
    decl = spark.createDataFrame([("a", "^1"), ("a", "=1.0.0")], "dep_name string, version_req string")
    versions = spark.createDataFrame([("a", "1.0.0"), ("a", "1.0.0+b"), ("a", "1.0.0+a")], "name string, version string")
    assert {r.resolved_version for r in resolve_versions(decl, versions).collect()} == {"1.0.0+b"}
    assert [r.resolved_version for r in resolve_versions(decl, versions.limit(0)).collect()] == [None, None]
    assert resolve_versions(decl.limit(0), versions).count() == 0


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_no_pairs_are_formed(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        decl = spark.range(300).selectExpr("id", "'hot' AS dep_name", "concat('>=', id % 90, ', <', id % 90 + 5) AS version_req")
        versions = spark.range(300).selectExpr("'hot' AS name", "concat(id % 100, '.', id, '.0') AS version")
        found = resolve_versions(decl, versions)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert found.filter("resolved_version IS NOT NULL").count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
