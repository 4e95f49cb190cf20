"""Semantic versions as sortable keys, and requirements resolved to the greatest version they allow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataset.functions.asof import fill_forward
from strataset.functions.names import unused

_NUMBER = r"(0|[1-9][0-9]*)"
_IDENTIFIERS = r"[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*"
_VERSION = rf"^{_NUMBER}\.{_NUMBER}\.{_NUMBER}(?:-({_IDENTIFIERS}))?(?:\+{_IDENTIFIERS})?$"
_PART = r"(0|[1-9][0-9]*|[*xX])"
_COMPARATOR = (
    rf"^\s*(\^|~|>=|<=|>|<|=|)\s*{_PART}(?:\.{_PART})?(?:\.{_PART})?(?:-({_IDENTIFIERS}))?(?:\+{_IDENTIFIERS})?\s*$"
)
_DIGITS = 20  # of an unsigned 64-bit number
_RELEASE = "~"  # sorts after any pre-release
_ANY = "~"  # sorts after any version


def _padded(number: Column) -> Column:
    return F.lpad(number, _DIGITS + 1, "0")


def _pre_key(pre: Column) -> Column:
    """Pre-release identifiers as text that sorts like them: numbers before words, by value, and fewer
    before more. `!` sorts before all that an identifier may hold."""
    one = lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("0"), _padded(x))).otherwise(F.concat(F.lit("1"), x))
    return F.array_join(F.transform(F.split(pre, r"\."), one), "!")


def _key(major: Column, minor: Column, patch: Column, pre: Column | None = None) -> Column:
    triple = F.concat(_padded(major), F.lit("."), _padded(minor), F.lit("."), _padded(patch), F.lit("-"))
    if pre is None:
        return F.concat(triple, F.lit(_RELEASE))
    return F.concat(triple, F.when(F.coalesce(pre, F.lit("")) == "", _RELEASE).otherwise(_pre_key(pre)))


def version_key(version: Column) -> Column:
    """A text that sorts as semantic versions do, build metadata aside; null for what is no version.
    Numbers have up to 21 digits."""
    parts = [F.regexp_extract(version, _VERSION, i) for i in range(1, 5)]
    fits = version.rlike(_VERSION) & (F.greatest(*[F.length(p) for p in parts[:3]]) <= _DIGITS + 1)
    return F.when(fits, _key(*parts))


def _next(number: Column) -> Column:
    return (number.cast("decimal(38,0)") + 1).cast("string")


def _bounds(c: Column) -> Column:
    """A comparator as (lower, above, upper, upto, triple, wrong): versions from `lower`, or above it,
    below `upper`, or up to it; the triple whose pre-releases it admits, if any."""
    op, major, minor, patch, pre = (F.regexp_extract(c, _COMPARATOR, i) for i in range(1, 6))
    blank = lambda x: (x == "") | x.isin("*", "x", "X")
    no_major, no_minor, no_patch = blank(major), blank(minor), blank(patch)
    star = F.greatest(*[x.isin("*", "x", "X").cast("int") for x in (major, minor, patch)]) == 1
    zero = F.lit("0")
    a, b, p = (F.when(blank(x), zero).otherwise(x) for x in (major, minor, patch))
    full = ~(no_major | no_minor | no_patch)
    named = F.when(full, _key(a, b, p, pre)).otherwise(_key(a, b, p))
    after_major, after_minor, after_patch = _key(_next(a), zero, zero), _key(a, _next(b), zero), _key(a, b, _next(p))
    beyond = F.when(no_major, _ANY).when(no_minor, after_major).when(no_patch, after_minor)  # of a partial version
    caret = (
        F.when(no_major, _ANY).when((a != "0") | no_minor, after_major)
        .when((b != "0") | no_patch, after_minor).otherwise(after_patch)
    )
    tilde = F.when(no_major, _ANY).when(no_minor, after_major).otherwise(after_minor)
    first = F.lit("")
    exact, wild = op == "=", (op == "") & star
    lower = (
        F.when(op.isin("<", "<=") | no_major, first).when((op == ">") & ~full, beyond).otherwise(named)
    )
    upper = (
        F.when(op == "<", F.when(no_major, first).otherwise(named))
        .when(op.isin(">", ">="), _ANY)
        .when((op == "<=") | exact | wild, F.when(full, named).otherwise(beyond))
        .when(op == "~", tilde).otherwise(caret)
    )
    wrong = ~c.rlike(_COMPARATOR) | (
        F.greatest(*[F.length(x) for x in (major, minor, patch)]) > _DIGITS
    ) | (no_minor & ~no_patch) | (no_major & ~no_minor) | ((pre != "") & ~full) | ((op == ">") & no_major)
    return F.struct(
        lower.alias("lower"), ((op == ">") & full).alias("above"),
        upper.alias("upper"), (full & ((op == "<=") | exact)).alias("upto"),
        F.when(pre != "", _triple(named)).alias("triple"), wrong.alias("wrong"),
    )


def _triple(key: Column) -> Column:
    """What the keys of a version and of its pre-releases begin with."""
    return F.substring(key, 1, 3 * (_DIGITS + 2))


def resolve_versions(
    decl: DataFrame, versions: DataFrame, name: str = "dep_name", requirement: str = "version_req"
) -> DataFrame:
    """Declared dependencies with `resolved_version`: the greatest of the `versions` (name, version) of
    that name that the requirement allows, null if there is none.

    Comparators, joined by commas, all hold: `^1.2`, also written `1.2`, up to the next version whose
    first number that is not zero differs; `~1.2` up to the next minor one; `=`, `>`, `>=`, `<`, `<=`;
    `1.*` and `*`. Pre-releases are allowed where a comparator names a pre-release of the same three
    numbers. Build metadata does not count, of versions that differ in it the last one by name is
    taken. What is no version is not found, what is no requirement finds nothing; null names find
    nothing. Other columns are kept, one named resolved_version is replaced.

    Each different (name, requirement) becomes an interval and asks for the greatest version below its
    upper end, which one sort over versions and questions together answers: a range join without pairs.
    A name of very many versions or requirements is cut into ranges.
    """
    of_name, of_req = unused(decl.columns, "_name", "_req")
    asked = decl.select(F.col(name).alias("name"), F.col(requirement).alias("req")).filter(
        "name IS NOT NULL AND req IS NOT NULL"
    ).distinct()
    each = F.transform(F.split("req", ","), _bounds)
    spans = asked.withColumn("b", each).filter(~F.exists("b", lambda x: x["wrong"])).select(
        "name", "req",
        F.array_max(F.transform("b", lambda x: F.struct(x["lower"].alias("key"), x["above"].alias("above")))).alias("low"),
        F.array_min(F.transform("b", lambda x: F.struct(x["upper"].alias("key"), x["upto"].alias("upto")))).alias("high"),
        # Releases, and the pre-releases of each triple that is named, are looked up on their own.
        F.explode(F.array_distinct(F.concat(
            F.array(F.lit("")), F.filter(F.transform("b", lambda x: x["triple"]), lambda t: t.isNotNull())
        ))).alias("channel"),
    )
    key = version_key(F.col("version"))
    known = (
        versions.select("name", "version", key.alias("key")).filter("name IS NOT NULL AND key IS NOT NULL")
        .groupBy("name", "key").agg(F.max("version").alias("version"))
        .withColumn("channel", F.when(F.col("key").endswith("-" + _RELEASE), "").otherwise(_triple(F.col("key"))))
    )
    fact = F.struct("key", "version")
    span = F.struct("req", "low")
    both = known.select("name", "channel", "key", F.lit(1).alias("turn"), fact.alias("fact")).withColumn(
        "span", F.lit(None).cast(spans.select(span.alias("s")).schema["s"].dataType)
    ).unionByName(spans.select(
        "name", "channel", F.col("high.key").alias("key"), F.when(F.col("high.upto"), 2).otherwise(0).alias("turn"),
        F.lit(None).cast(known.select(fact.alias("f")).schema["f"].dataType).alias("fact"), span.alias("span"),
    ))
    filled = fill_forward(both, ["name", "channel"], [F.col("key"), F.col("turn")], "fact", "versions")
    low, found = F.col("span.low"), F.col("fact.key")
    allowed = (found > low["key"]) | ((found == low["key"]) & ~low["above"])
    resolved = (
        filled.filter(F.col("span").isNotNull() & F.col("fact").isNotNull() & allowed)
        .groupBy(F.col("name").alias(of_name), F.col("span.req").alias(of_req))
        .agg(F.max("fact").getField("version").alias("resolved_version"))
    )
    kept = [c for c in decl.columns if c != "resolved_version"]
    same = (F.col(f"`{name}`") == F.col(of_name)) & (F.col(f"`{requirement}`") == F.col(of_req))
    return decl.select(*[F.col(f"`{c}`") for c in kept]).join(resolved, same, "left").select(
        *[F.col(f"`{c}`") for c in kept], "resolved_version"
    )
