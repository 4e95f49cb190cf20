"""Changes of source files by line, and the records they add, replace and withdraw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strataset.operators.maintenance import with_hash
from strataset.operators.semantic import RunInfo, line_array, phase_records
from strataset.session import hold

BUCKETS = 64  # parts of a phase that are rewritten or left alone as a whole


def _lines(content: Column) -> Column:
    split = line_array(content)
    return F.slice(split, F.lit(1), F.size(split) - (F.element_at(split, -1) == "").cast("int"))


def file_state(files: DataFrame) -> DataFrame:
    """(file_path, content_hash, line_hashes) of files (file_path, unique, and content): what a later
    run compares with. A line's hash covers its neighbours, which its records may hold."""
    near = F.transform("_raw", lambda line, i: F.xxhash64(
        line, F.coalesce(F.get("_raw", i - 1), F.lit("")), i > 0,
        F.coalesce(F.get("_raw", i + 1), F.lit("")), i < F.size("_raw") - 1,
    ))
    return (
        with_hash(files).select("file_path", "content_hash", _lines(F.col("content")).alias("_raw"))
        .select("file_path", "content_hash", near.alias("line_hashes"))
    )


def line_delta(files: DataFrame, state: DataFrame) -> DataFrame:
    """(file_path, change, lines): how files differ from an earlier `state` (see `file_state`).

    `change` is `added`, `changed` or `deleted`; files that are as they were have no row. `lines` are
    the numbers of the lines whose records must be made or withdrawn: those that are new, gone, or that
    differ in themselves or in a neighbour. For a deleted file it is null, which stands for all lines.

    Only paths and hashes are compared. Line hashes are moved for files whose content changed, contents
    are not moved at all.
    """
    before = state.select("file_path", F.col("content_hash").alias("_old"), F.col("line_hashes").alias("_was"))
    now = with_hash(files).select("file_path", "content_hash")
    differs = hold(
        now.join(before.select("file_path", "_old"), "file_path", "full")
        .filter("_old IS NULL OR content_hash IS NULL OR _old <> content_hash")
        .select(
            "file_path",
            F.when(F.col("_old").isNull(), "added").when(F.col("content_hash").isNull(), "deleted")
            .otherwise("changed").alias("change"),
        ),
        "changed-files",
    )
    there = differs.filter("change <> 'deleted'")
    after = file_state(files.join(there.select("file_path"), "file_path", "left_semi")).select("file_path", "line_hashes")
    both = there.join(after, "file_path").join(before.select("file_path", "_was"), "file_path", "left")
    was = F.coalesce("_was", F.array().cast("array<bigint>"))
    numbers = F.sequence(F.lit(1), F.greatest(F.size("line_hashes"), F.size(was)))
    other = F.filter(numbers, lambda i: ~F.get("line_hashes", i - 1).eqNullSafe(F.get(was, i - 1)))
    longest = F.greatest(F.size("line_hashes"), F.size(was)) > 0
    lines = F.when(longest, other).otherwise(F.array().cast("array<int>"))
    gone = differs.filter("change = 'deleted'").withColumn("lines", F.lit(None).cast("array<int>"))
    return both.select("file_path", "change", lines.alias("lines")).unionByName(gone)


def delta_records(
    files: DataFrame, delta: DataFrame, phases: Sequence[str], run: RunInfo = RunInfo()
) -> DataFrame:
    """The records of the lines that `delta` names, as a whole run over `files` would make them."""
    wanted = delta.filter("lines IS NOT NULL").select("file_path", F.col("lines").alias("_at"))
    raw = files.select("file_path", "content").join(wanted, "file_path").select(
        "file_path", _lines(F.col("content")).alias("_raw"), "_at"
    )
    lines = raw.select("file_path", "_raw", F.explode(F.filter("_at", lambda i: i <= F.size("_raw"))).alias("_n")).select(
        "file_path", F.col("_n").cast("long").alias("line_no"), F.get("_raw", F.col("_n") - 1).alias("line"),
        F.get("_raw", F.col("_n") - 2).alias("context_before"), F.get("_raw", F.col("_n")).alias("context_after"),
    )
    return phase_records(lines, phases, run)


def bucket_of(path: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def _by_bucket(records: DataFrame):
    return records.hint("rebalance", F.col("phase"), F.col("bucket")).write.partitionBy("phase", "bucket")


def write_bucketed(records: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Records below phase=<name>/bucket=<n>/, by the hash of their path."""
    _by_bucket(records.withColumn("bucket", bucket_of(F.col("file_path"), buckets))).parquet(path)


def apply_delta(
    spark: SparkSession, path: str, delta: DataFrame, records: DataFrame, buckets: int = BUCKETS
) -> None:
    """Bring a dataset written by `write_bucketed` up to date; then it holds what a whole run makes.

    Records of lines that `delta` names, and of deleted files, go; `records` come. Only buckets that
    hold a changed file are read and rewritten, others are not touched. The new content of a bucket is
    written beside the dataset first, since it is made of the old one, and put in its place by dynamic
    partition overwrite, which Spark commits as a whole: a job that fails leaves the dataset as it was.
    A bucket that is left without records is written empty.
    """
    named = hold(delta.select("file_path", F.col("lines").alias("_lines"), bucket_of(F.col("file_path"), buckets).alias("bucket")), "delta")
    touched = named.select("bucket").distinct()
    stored = spark.read.option("basePath", path).parquet(path)
    shape = [c for c in stored.columns if c != "bucket"]
    # A row per bucket, of which there is a fixed number.
    chosen = [r[0] for r in touched.collect()]
    old = stored.filter(F.col("bucket").isin(chosen)).select(*shape, "bucket")
    withdrawn = named.select(
        "file_path", F.explode_outer("_lines").alias("line"), F.col("_lines").isNull().alias("all")
    )
    single = withdrawn.filter("NOT all").select("file_path", F.col("line").cast("long").alias("line"))
    kept = (
        old.join(single, ["file_path", "line"], "left_anti")
        .join(withdrawn.filter("all").select("file_path"), "file_path", "left_anti")
    )
    made = records.select(*shape).withColumn("bucket", bucket_of(F.col("file_path"), buckets))
    fresh = hold(kept.select(*shape, "bucket").unionByName(made), "delta-buckets")
    # Overwriting leaves alone what gets no row, so folders that lose all records are emptied after it.
    # There are as many as buckets and phases at most.
    left = fresh.select("phase", "bucket").distinct()
    emptied = old.select("phase", "bucket").distinct().join(left, ["phase", "bucket"], "left_anti").collect()
    _by_bucket(fresh).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for r in emptied:
        fresh.filter("false").drop("phase", "bucket").write.mode("overwrite").parquet(f"{path}/phase={r.phase}/bucket={r.bucket}")
