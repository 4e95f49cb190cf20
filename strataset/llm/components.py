"""Connected components of links, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataset.session import hold, release


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half round; `edges` has u > v without repeats, and so has the result."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        made = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        made = (
            edges.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
        )
    return made.filter("u > v").distinct()


def _state(edges: DataFrame) -> tuple:
    """A count and two sums that tell two sets of edges apart."""
    mixed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.shiftright(mixed, 20)),
            F.sum(mixed.bitwiseAND(F.lit((1 << 20) - 1))),
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a long, b long): the smallest node reachable.

    Aggregates run before shuffles and the joins are on plain keys, so a node with very many links
    is split by partial aggregation and skew joins. Each round is written to the shared folder; the
    rounds grow with the logarithm of the longest path. Links to itself and repeats are allowed,
    null ends are left out; no links give no rows.
    """
    edges = hold(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = _state(edges)
    while before[0]:
        earlier, edges = edges, hold(_stars(_stars(edges, True), False), "stars")
        release(earlier)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
