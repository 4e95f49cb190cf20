"""First records of a stream, kept up to date over batches and restarts."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from strataset.functions.keys import digest_of, order_of
from strataset.functions.names import unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BUCKETS = 4096  # groups of keys whose state is kept together
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least row by the last column of those with one value in the column before it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, order = batch.schema.names[-2:]
        pair = pa.table({"key": batch[key], "order": batch[order]})
        at = pc.sort_indices(pair, sort_keys=[("key", "ascending"), ("order", "ascending")])
        keys = pair["key"].combine_chunks().take(at)
        starts = pc.not_equal(keys[1:], keys[:-1])
        yield batch.take(at.filter(pa.concat_arrays([pa.array([True]), starts])))


class _Firsts(StatefulProcessor):
    """Per bucket of keys, for each key the order of the best record so far and how many records have been
    the best, as JSON: a bucket is fetched and stored once a batch, not each of its keys."""

    def __init__(self, key: str, order: str, columns: Sequence[str], made: Sequence[str]):
        self._key, self._order, self._columns, self._row = key, order, list(columns), Row(*columns, *made)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._best = handle.getValueState("best", T.StructType().add("firsts", T.StringType()))

    def handleInputRows(self, key, rows, timerValues):
        held = self._best.get()
        known = json.loads(held[0]) if held else {}
        found = {}
        for row in rows:
            k, order = row[self._key], row[self._order]
            best = found[k][self._order] if k in found else known[k][0] if k in known else None
            if best is None or order < best:
                found[k] = row
        for k, row in found.items():
            known[k] = (row[self._order], known[k][1] + 1 if k in known else 1)
        if found:
            self._best.update((json.dumps(known),))
        for k, row in found.items():
            yield self._row(*[row[c] for c in self._columns], k, known[k][1])

    def close(self) -> None:
        pass


def dedup_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The log of first records by `order` among those of a stream that agree in `keys`.

    A record enters the log when it comes before all earlier ones of its key, with the digest of the
    key and a revision counted from 1 in the two last columns (`record_key` and `revision`, longer if the
    stream has such columns). A record that arrives late may so replace one that arrived early; among
    records equal in `order` the one that arrived first stays. `current_records` gives the latest
    revisions: what `dedup_records` gives for all rows together. Nulls agree with each other and come first.

    Records of a task are thinned to one per key and Arrow batch before they are shuffled, so a key of very
    many copies is neither one task's work nor long in the state; that holds an order and a count per key,
    in buckets of keys.
    """
    key, revision = unused(stream.columns, "record_key", "revision")
    place, bucket = unused([*stream.columns, key, revision], "_order", "_bucket")
    keyed = stream.withColumns({key: digest_of(stream, keys), place: order_of(stream, order)})
    out = T.StructType([*stream.schema.fields, T.StructField(key, T.StringType()), T.StructField(revision, T.LongType())])
    return (
        keyed.mapInArrow(_first_of_each, keyed.schema)
        .withColumn(bucket, F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(_BUCKETS))).groupBy(bucket)
        .transformWithState(_Firsts(key, place, stream.columns, (key, revision)), out, "Append", "None")
    )


def current_records(log: DataFrame) -> DataFrame:
    """The record of the latest revision of each key of a log, without the key and the revision."""
    key, revision = log.columns[-2:]
    rank, = unused(log.columns, "_rank")
    latest = Window.partitionBy(F.col(f"`{key}`")).orderBy(F.col(f"`{revision}`").desc())
    return (
        log.withColumn(rank, F.row_number().over(latest)).filter(F.col(rank) == 1).drop(key, revision, rank)
    )


def start_dedup(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], log: str, checkpoint: str
) -> StreamingQuery:
    """Append the log of a stream to a folder until all that is there has been read.

    The state is in the checkpoint: a run that was stopped, or lost, goes on from its last whole batch, and
    the log has each revision exactly once.
    """
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)  # the store that keeps named states; a query takes it when it starts
    try:
        return (
            dedup_stream(stream, keys, order).writeStream.format("parquet").option("path", log)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)
