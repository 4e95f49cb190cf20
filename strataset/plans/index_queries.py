"""Queries for indexes over stored datasets, packed files and the deduplicated stream.

A dataset is written to a new folder below the shared one, in several files, and read from there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from strataset.operators import skipping, substrings
from strataset.plans import semantic_queries as sem, views
from strataset.plans.registry import query, table
from strataset.session import scratch_path
from strataset.sinks.compact import write_packed_parquet as write_packed
from strataset.sources.files import read_footer_stats
from strataset.streaming import dedup
from strataset.streaming.batches import batch_files

NEEDLES = ("tion", "MORE than", "100%", "é", "no such passage anywhere")
ROWS_PER_FILE, PACKED_MB = 500, 0.25
# Files of a batch of the stream at least, and batches that all its files would take at most: each batch loads
# and stores the state of its keys.
FILES_PER_BATCH, BATCHES = 4, 4


@query("search_substrings", f"""
    SELECT n AS needle, doc_id, n_chars
    FROM documents, (VALUES {", ".join(f"('{n}')" for n in NEEDLES)}) AS t(n)
    WHERE contains(lower(text), lower(n))""")
def search_substrings(spark, sf_dir):
    """Documents that contain each of some needles, found by the index of their trigrams."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    data, index = scratch_path(spark, "texts"), scratch_path(spark, "trigrams")
    docs.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(data)
    substrings.write_index(spark, data, docs.schema, "text", index)

    def found(needle: str) -> DataFrame:
        rows = substrings.search(spark, data, docs.schema, "text", index, needle)
        return rows.select(F.lit(needle).alias("needle"), "doc_id", "n_chars")

    return reduce(DataFrame.unionByName, map(found, NEEDLES))


@query("read_where", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1995-06-01'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey = 7""")
def read_where(spark, sf_dir):
    """Orders of three months, and those of a customer: bounds serve the first, Bloom filters the second."""
    orders = table(spark, sf_dir, "orders")
    data, bounds, blooms = (scratch_path(spark, n) for n in ("orders", "bounds", "blooms"))
    orders.repartitionByRange("o_orderdate").write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(data)
    skipping.write_bounds(spark, data, orders.schema, ["o_orderdate", "o_custkey"], bounds)
    skipping.write_blooms(spark, data, orders.schema, ["o_custkey"], blooms)

    def rows(*conditions: skipping.Condition) -> DataFrame:
        found = skipping.read_where(spark, data, orders.schema, conditions, bounds, blooms)
        return found.select("o_orderkey", "o_custkey", "o_orderdate")

    season = rows(("o_orderdate", ">=", "1995-03-01"), ("o_orderdate", "<", "1995-06-01"))
    return season.unionByName(rows(("o_custkey", "=", 7)))


@query("write_packed_parquet", f"""
    WITH {views.CORPUS_LINES}, {sem._PHASED}
    SELECT phase, count(*) AS records, count(DISTINCT file_path) AS files, true AS within_limit
    FROM phased GROUP BY phase""")
def write_packed_parquet(spark, sf_dir):
    """Records by phase in files of at most a quarter of a megabyte after encoding."""
    path = scratch_path(spark, "packed")
    write_packed(sem.records(spark, sf_dir), path, max_mb=PACKED_MB)
    sizes = read_footer_stats(spark, path, ["phase"]).groupBy("phase").agg(
        (F.max("file_size_bytes") <= PACKED_MB * 1024 * 1024).alias("within_limit")
    )
    rows = spark.read.parquet(path).groupBy("phase").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("file_path").alias("files")
    )
    return rows.join(sizes, "phase")


@query("stream_dedup_records", """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1""")
def stream_dedup_records(spark, sf_dir):
    """First event of each user and type, from a stream that ends after the later half of the events
    and goes on from its checkpoint when the earlier half has come, which replaces records."""
    events = table(spark, sf_dir, "events")
    middle = events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0] or 0
    data, log = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    late = F.coalesce(F.col("event_id") > middle, F.lit(False))
    for part in (events.filter(late), events.filter(~late)):
        part.write.mode("append").option("maxRecordsPerFile", 20_000).parquet(data)
        files = batch_files(spark, data, FILES_PER_BATCH, BATCHES)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(data)
        dedup.start_dedup(
            stream, ["user_id", "event_type"], ["ts", "event_id"], log, f"{log}-checkpoint"
        ).awaitTermination()
    return dedup.current_records(spark.read.parquet(log))
