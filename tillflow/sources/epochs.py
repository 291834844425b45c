"""Epoch directories of the file sinks, and the log of those that are finished.

    <path>/epochs/batch_id=N   the rows of epoch N
    <path>/bases/through=N     all rows up to epoch N, folded by upkeep
    <path>/_log/finished-N     epoch N is whole
    <path>/_log/base-N         base N is whole

An entry is made after its rows are written, a finished epoch is not written again, and
epochs finish in order. So readers take the newest base and the epochs after it up to the
last finished one; what is being written or replayed lies beyond.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = T.StructField("batch_id", T.LongType())


class Folder:
    """A folder in any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._at(name))]

    def sizes(self, name: str = "") -> dict[str, int]:
        """What lies in the folder, with the bytes of all files at or below it."""
        if not self.exists(name):
            return {}
        return {status.getPath().getName(): self._fs.getContentSummary(status.getPath()).getLength()
                for status in self._fs.listStatus(self._at(name))}

    def touch(self, name: str) -> None:
        self._fs.create(self._at(name), True).close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class EpochLog:
    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def _last(self, kind: str) -> int | None:
        found = [int(n.removeprefix(f"{kind}-")) for n in self.folder.names("_log") if n.startswith(f"{kind}-")]
        return max(found, default=None)

    @property
    def finished(self) -> int | None:
        """The last whole epoch."""
        return self._last("finished")

    @property
    def base(self) -> int | None:
        """The last epoch that the newest base covers."""
        return self._last("base")

    @property
    def started(self) -> bool:
        return self.folder.exists("epochs") or self.folder.exists("_log")

    def finish(self, epoch: int) -> None:
        before = self.finished
        self.folder.touch(f"_log/finished-{epoch}")
        if before is not None and before < epoch:
            self.folder.delete(f"_log/finished-{before}")

    def add_base(self, through: int) -> None:
        self.folder.touch(f"_log/base-{through}")

    def vacuum(self) -> None:
        """Delete what the newest base has replaced. Readers that have planned before
        may still need it: run it when they are done."""
        base = self.base
        if base is None:
            return
        for name in self.folder.names("epochs"):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= base:
                self.folder.delete(f"epochs/{name}")
        for name in self.folder.names("bases"):
            if name.startswith("through=") and int(name.removeprefix("through=")) < base:
                self.folder.delete(f"_log/base-{name.removeprefix('through=')}")
                self.folder.delete(f"bases/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    return Folder(spark, path).exists()


def read_epochs(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                through: int | None = None) -> DataFrame:
    """The rows of all finished epochs with their ``batch_id``; typed and empty before
    the first. ``through`` leaves later epochs out. A base keeps each row's epoch if its
    rows carry one."""
    log = EpochLog(spark, path)
    last, base = log.finished, log.base
    if through is not None:
        last = through if last is None else min(last, through)
    schema = T.StructType([f for f in schema.fields if f.name != BATCH.name] + [BATCH])
    parts = []
    if base is not None:
        parts.append(spark.read.schema(schema).format(fmt).load(f"{log.folder.path}/bases/through={base}").select(*schema.names))
    if last is not None and (base is None or last > base):
        epochs = _load(spark, f"{log.folder.path}/epochs", schema, fmt)
        if epochs is not None:
            after = F.col("batch_id") <= last
            if base is not None:
                after = after & (F.col("batch_id") > base)
            parts.append(epochs.where(after).select(*schema.names))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _load(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame | None:
    """None where no epoch had rows, so that nothing was written."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
