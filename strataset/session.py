"""Session helper and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "strataset", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC and adaptive execution; further settings override the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def open_together(spark: SparkSession, folders: int = 16) -> Iterator[None]:
    """Tasks of the block write to up to so many folders at once; only with more of them a task sorts its
    rows by folder, for which it would hold as many as there is memory for."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, folders)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a URI of the file system it lives on; without a scheme that is Spark's default."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or one that a pattern stands for, exists."""
    store, path = _file_system(spark, pattern)
    return bool(store.globStatus(path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths a pattern stands for, as URIs; for few of them."""
    store, path = _file_system(spark, pattern)
    return [f.getPath().toString() for f in store.globStatus(path) or ()]


def delete(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete files."""
    for name in paths:
        store, path = _file_system(spark, name)
        store.delete(path, False)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or one in the warehouse, which
    executors share too, where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


# The folder of the running job, see `scratch`; else one per session, deleted when Spark ends.
_JOB: ContextVar[str | None] = ContextVar("job", default=None)
_SESSIONS: dict[str, str] = {}


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of the block go to a folder that is deleted when the block ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield
    finally:
        _JOB.reset(token)
        store, path = _file_system(spark, folder)
        store.delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    folder = _JOB.get()
    if folder is None:
        app = spark.sparkContext.applicationId
        if app not in _SESSIONS:
            _SESSIONS[app] = f"{shared_dir(spark).rstrip('/')}/session-{uuid.uuid4().hex}"
            store, path = _file_system(spark, _SESSIONS[app])
            store.mkdirs(path)
            store.deleteOnExit(path)
        folder = _SESSIONS[app]
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """`df`, narrow, in as many tasks as it has `rows` rows.

    A scan is cut by bytes, which do not show how much is made of a row: where a whole file comes from a
    few numbers, one split would make all of them. Equal rows stay together.
    """
    tasks = -(-df.count() // rows)
    return df if tasks <= 1 else df.repartition(tasks, *[F.col(f"`{c}`") for c in df.columns])


def hold(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage like a checkpoint does and outlives lost executors, but stays columnar, so
    later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    _HELD[held] = path
    return held


# Where the tables are that `hold` gave and that are still in use.
_HELD: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def release(*tables: DataFrame) -> None:
    """Delete tables that `hold` gave, when nothing reads them any more: not even a frame made of them
    that has not been run yet. Other frames are left alone."""
    for df in tables:
        path = _HELD.pop(df, None)
        if path is not None:
            store, folder = _file_system(df.sparkSession, path)
            store.delete(folder, True)
