"""SQL over the archive, and upkeep of what the streams have written."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.keyed import WRITES, last_write
from tillflow.operators.totals import COLLECTIONS
from tillflow.plans.pipelines import Layout
from tillflow.schema import HOT, HOT_KEY
from tillflow.sources import stored
from tillflow.sources.epochs import EpochLog, Folder, read_epochs

HISTORY_VIEW = "transactions"

# A fold works in parts of about so many bytes of files: what it shuffles lies on disk,
# several times as large, until the part is done.
FOLD_BYTES = 256 << 20
# A year's rows that need no shuffle get a file for so many bytes of theirs.
FILE_BYTES = 32 << 20


def open_history(spark: SparkSession, path: str, view: str = HISTORY_VIEW) -> DataFrame:
    """Register the archive as a view; a predicate on ``tran_year`` prunes directories."""
    archive = stored.read_archive(spark, path)
    archive.createOrReplaceTempView(view)
    return archive


def _fold(spark: SparkSession, path: str, parts, write) -> None:
    """Write all finished epochs of a path as one base, part by part, and log it. The
    stream may go on meanwhile: its later epochs come after the base."""
    log = EpochLog(spark, path)
    last = log.finished
    if last is None or last == log.base:
        return
    # What a fold left behind that did not come to its end.
    log.folder.delete(f"bases/through={last}")
    for rows in parts(log, last):
        write(rows, f"{log.folder.path}/bases/through={last}")
    log.add_base(last)


def _folders(log: EpochLog, last: int) -> list[str]:
    """The folders that a fold through ``last`` reads."""
    base = -1 if log.base is None else log.base
    epochs = [n for n in log.folder.names("epochs") if n.startswith("batch_id=") and base < int(n.removeprefix("batch_id=")) <= last]
    return [f"epochs/{n}" for n in epochs] + [f"bases/through={base}"] * (base >= 0)


def _years(log: EpochLog, last: int) -> list[tuple[list[int | None], int]]:
    """The archive's years in groups of about ``FOLD_BYTES``, each with its bytes; larger
    years alone."""
    years: dict[int | None, int] = {}
    for folder in _folders(log, last):
        for name, size in log.folder.sizes(folder).items():
            if name.startswith("tran_year="):
                text = name.removeprefix("tran_year=")
                year = int(text) if text.lstrip("-").isdigit() else None
                years[year] = years.get(year, 0) + size
    groups: list[tuple[list[int | None], int]] = []
    for year, size in sorted(years.items(), key=lambda y: y[1]):
        if groups and groups[-1][1] + size <= FOLD_BYTES:
            groups[-1] = [*groups[-1][0], year], groups[-1][1] + size
        else:
            groups.append(([year], size))
    return groups


def compact_archive(spark: SparkSession, path: str) -> None:
    """An archive's many small files as few large ones, a few years at a time.

    ``rebalance`` lets AQE join small partitions and split a year too large for
    one task. A year large enough to fill files alone is written as it is read, without a
    shuffle. Spark's own file sink keeps a log that a rewrite would contradict, so
    an archive of that kind is refused.
    """
    if Folder(spark, path).exists("_spark_metadata"):
        raise ValueError(f"{path} was written by Spark's file sink, whose log forbids a rewrite")

    def parts(log: EpochLog, last: int) -> Iterator[DataFrame]:
        rows, groups = read_epochs(spark, path, stored.ARCHIVE_ROWS, "json", last), _years(log, last)
        if len(groups) <= 1:
            yield rows.hint("rebalance", "tran_year")
            return
        for years, size in groups:
            known = F.col("tran_year").isin([y for y in years if y is not None])
            part = rows.where(known | F.col("tran_year").isNull() if None in years else known)
            yield part.coalesce(-(-size // FILE_BYTES)) if size > FOLD_BYTES else part.hint("rebalance", "tran_year")

    _fold(spark, path, parts,
          lambda rows, out: rows.write.mode("append").option("compression", "gzip").partitionBy("tran_year").json(out))


def compact_hot(spark: SparkSession, path: str) -> None:
    """Fold the keyed table into one row per key, in folders by the key's hash, so that
    the row of one key is found in one of them; a few folders at a time."""
    def parts(log: EpochLog, last: int) -> Iterator[DataFrame]:
        size = sum(sum(log.folder.sizes(folder).values()) for folder in _folders(log, last))
        n = min(stored.HOT_BUCKETS, 1 + size // FOLD_BYTES)
        for i in range(n):
            first, end = (stored.HOT_BUCKETS * k // n for k in (i, i + 1))
            rows = stored.read_hot_buckets(spark, path, lambda b: b.between(first, end - 1), last)
            yield last_write(rows.select(*HOT, *WRITES), HOT_KEY, WRITES)

    def write(rows: DataFrame, out: str) -> None:
        rows = rows.withColumn("bucket", stored.bucket(rows[HOT_KEY]))
        rows.hint("rebalance", "bucket").write.mode("append").option("compression", "zstd").partitionBy("bucket").parquet(out)

    _fold(spark, path, parts, write)


def compact_documents(spark: SparkSession, path: str, schema, by: str | None = None) -> None:
    """Collections and quarantines: every document stays, with its epoch."""
    def write(rows: DataFrame, out: str) -> None:
        writer = rows.hint("rebalance").write.mode("append").option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(out)

    _fold(spark, path, lambda log, last: [read_epochs(spark, path, schema, through=last)], write)


def compact(spark: SparkSession, layout: Layout) -> None:
    """Fold all outputs of a pipeline, running or stopped. Every answer stays as it was;
    ``vacuum`` frees the space."""
    stored.require_root(spark, layout.root)
    if EpochLog(spark, layout.archive).started or Folder(spark, layout.archive).exists("_spark_metadata"):
        compact_archive(spark, layout.archive)
    compact_hot(spark, layout.hot)
    for path in (layout.quarantine, layout.null_keys):
        compact_documents(spark, path, stored._QUARANTINE_ROW)
    compact_documents(spark, layout.collections, stored.SHARED_ROWS, "collection")
    for name in COLLECTIONS:
        compact_documents(spark, layout.collection(name), stored.collection_row(name))


def vacuum(spark: SparkSession, layout: Layout) -> None:
    """Delete the epochs and bases that a newer base covers, once no reader needs them."""
    stored.require_root(spark, layout.root)
    for path in (layout.archive, layout.hot, layout.quarantine, layout.null_keys, layout.collections,
                 *map(layout.collection, COLLECTIONS)):
        EpochLog(spark, path).vacuum()
