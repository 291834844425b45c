"""Starting and awaiting streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

Sink = Callable[[DataFrame, int], None]

# Fixed value: the micro-batch interval.
EVERY_5_SECONDS = {"processingTime": "5 seconds"}
# Everything there is, in batches bounded by the source's options, then stop.
AVAILABLE_NOW = {"availableNow": True}

_starting = Lock()


def _writer(df: DataFrame, name: str, checkpoints: str, trigger: dict, mode: str) -> DataStreamWriter:
    # A checkpoint for every query: without one its offsets and running totals
    # end with the process.
    return (df.writeStream.queryName(name).trigger(**trigger).outputMode(mode)
            .option("checkpointLocation", f"{checkpoints}/{name}"))


def start(df: DataFrame, sink: Sink, name: str, checkpoints: str,
          trigger: dict = EVERY_5_SECONDS, mode: str = "append") -> StreamingQuery:
    """Run ``sink(batch, epoch_id)`` on every micro-batch."""
    return _writer(df, name, checkpoints, trigger, mode).foreachBatch(sink).start()


def start_totals(df: DataFrame, sink: Sink, name: str, checkpoints: str,
                 trigger: dict = EVERY_5_SECONDS, state_partitions: int = 16) -> StreamingQuery:
    """``start`` in update mode for a running total over few keys.

    Every state partition is a store that commits in every micro-batch, so there
    should be as many as the keys need, not as the cluster's shuffles do. The
    query takes the setting along when it starts; its checkpoint then keeps it.
    The session has the setting for that moment only: start totals before other
    threads plan in the same session, or in one of their own.
    """
    conf = df.sparkSession.conf
    with _starting:
        shuffle = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(min(state_partitions, int(shuffle))))
        try:
            return start(df, sink, name, checkpoints, trigger, "update")
        finally:
            conf.set("spark.sql.shuffle.partitions", shuffle)


def start_format(df: DataFrame, fmt: str, name: str, checkpoints: str, trigger: dict = EVERY_5_SECONDS,
                 partition_by: tuple[str, ...] = (), **options: str) -> StreamingQuery:
    """Append through one of Spark's own stream sinks. The file formats
    (``path=...``) are exactly once by their log, ``kafka`` is at least once."""
    writer = _writer(df, name, checkpoints, trigger, "append").format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def await_any(queries: list[StreamingQuery]) -> None:
    """Block until one of the queries ends, stop the others, raise if it failed."""
    manager = SparkSession.active().streams
    try:
        while all(query.isActive for query in queries):
            # Forget queries that ended earlier, or the wait returns at once.
            manager.resetTerminated()
            if all(query.isActive for query in queries):
                try:
                    manager.awaitAnyTermination()
                except StreamingQueryException:
                    pass  # raised below if the query is one of ours
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for all of a list of ``AVAILABLE_NOW`` queries; raise the first failure."""
    for query in queries:
        query.awaitTermination()
