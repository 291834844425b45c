"""Micro-batch sinks: functions of (batch, epoch_id).

File sinks write one directory per epoch and log it when it is whole; a replayed epoch
that is in the log is left as it is. Epochs are numbered by the checkpoint: keep
outputs and checkpoints together, and start a new root with a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.keyed import ARRIVAL, last_write
from tillflow.operators.totals import named
from tillflow.schema import ARCHIVE, HOT, HOT_KEY
from tillflow.sources.epochs import EpochLog, Folder
from tillflow.streaming.run import Sink


@dataclass(frozen=True)
class Tuning:
    """How outputs are laid out; rows do not depend on it.

    The rows of a file are what one task writes in about a second: a micro-batch must
    not wait for longer than its interval. Upkeep makes files as large as scans want them.
    """
    archive_rows_per_file: int = 50_000
    rows_per_file: int = 200_000
    files_per_year: int = 1
    state_partitions: int = 16
    console_rows: int = 20


class EpochFiles:
    """Writes the batch as one epoch of a path (see ``sources.epochs``).

    Every partition of the batch writes files of its own, which at one epoch in a
    few seconds is far too many. ``rows_per_file`` lets that many rows share a file (per
    directory); the caller hands over how many there are at most, or they are counted.
    ``read`` tells how many rows they are picked from: where few files would make each task
    read many more than it writes, the rows are dealt to them instead.
    ``files`` is for batches known to be small.
    """

    def __init__(self, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (),
                 rows_per_file: int | None = None, files: int | None = None, **options: str):
        self.path, self.fmt, self.partition_by = path, fmt, partition_by
        self.rows_per_file, self.files, self.options = rows_per_file, files, options

    def __call__(self, batch: DataFrame, epoch: int, rows: int | None = None, read: int = 0) -> None:
        log = EpochLog(batch.sparkSession, self.path)
        last = log.finished
        if last is not None and epoch <= last:
            return
        if rows != 0:
            self._write(batch, epoch, rows, read)
        log.finish(epoch)

    def _write(self, batch: DataFrame, epoch: int, rows: int | None, read: int) -> None:
        if self.files is not None:
            # Not coalesce: that would also narrow the aggregate the batch comes from.
            batch = batch.repartition(self.files)
        elif self.rows_per_file is not None:
            rows = batch.count() if rows is None else rows
            files = 1 + rows // self.rows_per_file
            picked = read > 2 * files * self.rows_per_file
            batch = batch.repartition(files) if picked else batch.coalesce(files)
        writer = batch.write.format(self.fmt).mode("overwrite").options(**self.options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.save(f"{self.path}/epochs/batch_id={epoch}")


epoch_files = EpochFiles


def send(sink: Sink, batch: DataFrame, epoch: int, rows: int | None, read: int = 0) -> None:
    """Hand a batch over, with its number of rows, and of those it is picked from, where
    the sink has a use for them."""
    if isinstance(sink, EpochFiles):
        sink(batch, epoch, rows, read)
    elif rows != 0:
        sink(batch, epoch)


@contextmanager
def cached(batch: DataFrame) -> Iterator[DataFrame]:
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


@contextmanager
def written(batch: DataFrame, path: str) -> Iterator[DataFrame]:
    """The batch as compressed files, for as long as they are needed. A cached batch that
    does not fit in memory takes ten times as much disk. What a run left behind that did
    not come to its end is overwritten."""
    spark = batch.sparkSession
    try:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(path)
        yield spark.read.schema(batch.schema).parquet(path)
    finally:
        Folder(spark, path).delete("")


def connector(fmt: str, mode: str = "append", epoch_column: str | None = None, **options: str) -> Sink:
    """Write the batch through a connector, for example a keyed table's
    (``org.apache.spark.sql.cassandra``) or a document store's (``mongodb``).

    Hosts and credentials come from the caller's options. ``epoch_column`` adds
    the epoch to each record: it orders snapshots and tells replayed ones.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        if epoch_column is not None:
            batch = batch.withColumn(epoch_column, F.lit(epoch).cast("bigint"))
        batch.write.format(fmt).mode(mode).options(**options).save()
    return write


def keyed(target: Sink, rejected: Sink | None = None, keep_arrival: bool = True) -> Callable[..., None]:
    """Upsert hot rows: the last row of each key goes to the target.

    Rows without a key cannot be stored under one and go to ``rejected``. A
    target that keeps a history (``epoch_files``) needs the arrival columns to
    order writes; a keyed table overwrites by itself.
    """
    def write(batch: DataFrame, epoch: int, count: int | None = None) -> None:
        rows = batch.select(*HOT, *ARRIVAL)
        # Two writes must not read and parse the batch twice.
        with cached(rows) if rejected is not None else nullcontext():
            unkeyed = None
            if rejected is not None:
                count, unkeyed = rows.agg(F.count(F.lit(1)), F.count_if(F.col(HOT_KEY).isNull())).first()
            kept = last_write(rows.where(F.col(HOT_KEY).isNotNull()), HOT_KEY)
            send(target, kept if keep_arrival else kept.select(*HOT), epoch, count)
            if rejected is not None:
                send(rejected, null_keys(rows), epoch, unkeyed, count)
    return write


def null_keys(rows: DataFrame) -> DataFrame:
    """Hot rows without a key, in the form of the quarantine."""
    return rows.where(F.col(HOT_KEY).isNull()).select(
        F.col("record_id").alias("message_id"), "ingest_ts",
        F.lit("null key").alias("reject_reason"),
        F.to_json(F.struct(*HOT)).alias("value"))


def snapshots(targets: dict[str, Sink], of: Callable[[DataFrame, str], DataFrame]) -> Sink:
    """Append the changed running totals of a batch to each collection.

    ``of(batch, collection)`` takes a collection's rows out of the batch, one per
    changed key.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        # Cached and filled: no write may update the state a second time.
        with cached(batch) as totals:
            totals.count()

            # Tiny writes, each mostly waiting for its commit: side by side.
            @inheritable_thread_target(batch.sparkSession)
            def append(collection: str) -> None:
                targets[collection](of(totals, collection), epoch)

            with ThreadPool(len(targets)) as pool:
                pool.map(append, targets)
    return write


def together(path: str) -> Sink:
    """Append the changed running totals of all collections in one write, a folder for
    each below the epoch. One action on the batch, so the state is updated once."""
    files = EpochFiles(path, partition_by=("collection",), files=1)

    def write(batch: DataFrame, epoch: int) -> None:
        files(named(batch), epoch)
    return write


def console(rows: int = 20, out: Callable[[str], None] = print) -> Sink:
    """Print the first rows of each batch in full width, and whether there are more.

    Spark's console format gathers the whole batch on the driver before it
    prints these; here only they are fetched.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        first = batch.limit(rows + 1).collect()
        shown = [batch.columns, *([_cell(v) for v in r] for r in first[:rows])]
        widths = [max(len(r[i]) for r in shown) for i in range(len(batch.columns))]
        line = "-------------------------------------------"
        text = "\n".join("|" + "|".join(v.ljust(w) for v, w in zip(r, widths)) + "|" for r in shown)
        more = f"\nonly showing top {rows} rows" if len(first) > rows else ""
        out(f"{line}\nBatch: {epoch}\n{line}\n{text}{more}\n")
    return write


def _cell(value: object) -> str:
    return "NULL" if value is None else str(value)


def fan_out(archive: Sink, hot: Callable[..., None], quarantine: Sink, scratch: str | None = None) -> Sink:
    """All row sinks off one read and one parse of the batch.

    Expects ``explode_users_outer`` rows that went through flattening and
    enrichment, with the quarantine columns. One count tells every sink its rows.
    ``scratch`` is a folder that holds the rows meanwhile; without it they are cached.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        with written(batch, scratch) if scratch else cached(batch) as rows:
            is_user = F.col("pos").isNotNull()
            read, n, refused = rows.agg(
                F.count(F.lit(1)), F.count_if(is_user),
                F.count_if(_rejected()) + F.count_if(is_user & F.col(HOT_KEY).isNull())).first()
            users = rows.where(is_user)
            send(archive, users.select(*ARCHIVE, "tran_year"), epoch, n, read)
            hot(users, epoch, n)
            send(quarantine, rejected_messages(rows).unionByName(
                null_keys(users.select(*HOT, *ARRIVAL))), epoch, refused, read)
    return write


def _rejected():
    return F.col("reject_reason").isNotNull() & (F.col("pos").isNull() | (F.col("pos") == 0))


def rejected_messages(rows: DataFrame) -> DataFrame:
    """The unfit messages among outer-exploded rows, each once."""
    return rows.where(_rejected()).select("message_id", "ingest_ts", "reject_reason", "value")
