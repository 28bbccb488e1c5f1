"""Start streaming queries with the settings their state needs."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..session import ROCKSDB_PROVIDER, conf_override

# What a checkpoint keeps: state as of the last batches only, from which a query goes on, in the smaller codec.
# Changes since the last snapshot are kept as well, so snapshots come often.
# Without row counts RocksDB need not look each key up before it is put.
STATE_CONF = {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "20s",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def start(
    spark: SparkSession,
    writer: DataStreamWriter,
    checkpoint: str,
    *,
    interval: str | None = None,
    state_partitions: int | None = None,
    rocksdb: bool | None = None,
    empty_batches: bool = True,
) -> StreamingQuery:
    """Start a query: every `interval`, or once over all that is available.

    The number of state partitions is fixed with the first batch of a checkpoint; by default it
    follows the cores of the cluster. On a cluster state lives in RocksDB, outside the heap; in
    local mode, where it is small, in memory. Without `empty_batches` a watermark that moves on its own
    starts no batch: for queries whose results never wait for it.
    """
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    conf = {
        **STATE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.noDataMicroBatches.enabled": str(empty_batches).lower(),
    }
    if rocksdb if rocksdb is not None else not spark.sparkContext.master.startswith("local"):
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    _listener(spark)
    with conf_override(spark, conf):
        return writer.start()


def drain(spark: SparkSession, writer: DataStreamWriter, checkpoint: str, **options) -> StreamingQuery:
    """Run a query over all that is available and wait for its end."""
    query = start(spark, writer, checkpoint, **options)
    query.awaitTermination()
    return query


class _LateRows(StreamingQueryListener):
    """Adds up rows dropped by watermarks over the whole life of each query run."""

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        self.dropped[str(event.runId)] += 0

    def onQueryProgress(self, event) -> None:
        for operator in event.progress.stateOperators:
            self.dropped[str(event.progress.runId)] += operator.numRowsDroppedByWatermark

    def onQueryTerminated(self, event) -> None:
        pass


_LISTENERS: dict[int, _LateRows] = {}


def _listener(spark: SparkSession) -> _LateRows:
    """The session's listener, added with the first query that is started here."""
    if id(spark) not in _LISTENERS:
        _LISTENERS[id(spark)] = _LateRows()
        spark.streams.addListener(_LISTENERS[id(spark)])
    return _LISTENERS[id(spark)]


def late_rows(spark: SparkSession, query: StreamingQuery) -> int:
    """Rows a query started here dropped because they came after the watermark, since its start."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return _listener(spark).dropped[str(query.runId)]


def batch_seconds(query: StreamingQuery) -> list[float]:
    """How long each micro-batch with input took."""
    return [
        progress["durationMs"]["triggerExecution"] / 1000
        for progress in query.recentProgress
        if progress["numInputRows"]
    ]
