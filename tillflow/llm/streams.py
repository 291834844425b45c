"""Tables read as streams: every file once, in micro-batches of bounded size, by
queries that end when the files are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillflow.session import child

#: Bytes of input that a micro-batch has for each core: enough to keep all of them busy.
BYTES_A_CORE = 32 << 20
#: What is left of a text's bytes in a row of digests and masks, about.
NARROW = 64
#: Memory of all state stores of an executor together; what is beyond lies on its disk.
STORE_MB = 256


def session(spark: SparkSession) -> SparkSession:
    """A session of its own whose state lies in RocksDB, on disk, with its memory bounded.
    A store must not allocate space in advance: that is 4 MB for each partition of the state."""
    own = child(spark)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(STORE_MB))
    return own


def _batch(spark: SparkSession, batch_bytes: int | None) -> dict[str, int]:
    return {"maxBytesPerTrigger": batch_bytes or BYTES_A_CORE * spark.sparkContext.defaultParallelism}


def files(spark: SparkSession, path: str, batch_bytes: int | None = None) -> DataFrame:
    """The Parquet files at ``path`` (a folder or one file) as a stream. The last letter is
    made a pattern: Spark streams from a folder or from a pattern, not from a file."""
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**_batch(spark, batch_bytes)).parquet(f"{path[:-1]}[{path[-1]}]")


def written(spark: SparkSession, path: str, schema: T.StructType, batch_bytes: int | None = None) -> DataFrame:
    """The narrow rows that were made of a table and written to ``path``, as a stream."""
    size = batch_bytes or max(BYTES_A_CORE * spark.sparkContext.defaultParallelism // NARROW, 1)
    return spark.readStream.schema(schema).options(**_batch(spark, size)).parquet(path)
