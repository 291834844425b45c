"""Batch reads of what the streams have written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.keyed import WRITES, last_write
from tillflow.operators.offsets import INTERVALS, gaps
from tillflow.operators.totals import COLLECTIONS, SHARED
from tillflow.schema import ARCHIVE_ROW, HOT_KEY, HOT_ROW, struct
from tillflow.sources.epochs import BATCH, EpochLog, Folder, read_epochs

_KEY_TYPES = {"tran_year": T.IntegerType(), "nationality": T.StringType(),
              "tran_card_type": T.StringType()}
_ARRIVAL_ROW = struct(ingest_ts=T.TimestampType(), partition=T.IntegerType(),
                      offset=T.LongType(), pos=T.IntegerType(), record_id=T.StringType())
_QUARANTINE_ROW = struct(message_id=T.StringType(), ingest_ts=T.TimestampType(),
                         reject_reason=T.StringType(), value=T.StringType())
ARCHIVE_ROWS = T.StructType([*ARCHIVE_ROW.fields, T.StructField("tran_year", T.IntegerType())])
HOT_CHANGES = T.StructType([*HOT_ROW.fields, *_ARRIVAL_ROW.fields])
SHARED_ROWS = T.StructType([
    *(T.StructField(k, kind) for k, kind in _KEY_TYPES.items()),
    T.StructField("count_value", T.LongType()), T.StructField("sum_value", T.DoubleType()),
    T.StructField("collection", T.StringType())])

#: The base of a keyed table lies in this many folders by a hash of the key.
HOT_BUCKETS = 64


def bucket(key, buckets: int = HOT_BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def collection_row(collection: str) -> T.StructType:
    keys, value = COLLECTIONS[collection]
    kind = T.LongType() if value.endswith("_count") else T.DoubleType()
    return T.StructType([*(T.StructField(k, _KEY_TYPES[k]) for k in keys),
                         T.StructField(value, kind), BATCH])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archived rows and ``tran_year``, the partition column.

    The schema is given, never inferred: the JSON writer leaves NULLs out. Spark's own
    file sink keeps a log of its own, which Spark reads by itself.
    """
    if Folder(spark, path).exists("_spark_metadata"):
        return spark.read.schema(ARCHIVE_ROWS).json(path).select(*ARCHIVE_ROWS.names)
    return read_epochs(spark, path, ARCHIVE_ROWS, "json").select(*ARCHIVE_ROWS.names)


def read_collection(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """Every snapshot document of a collection, with its ``batch_id``: from its own
    folder, or out of the one that all collections share beside it."""
    parent = path.rstrip("/").rsplit("/", 1)[0]
    shared = f"{parent}/{SHARED}"
    row = collection_row(collection)
    if EpochLog(spark, path).started or not EpochLog(spark, shared).started:
        return read_epochs(spark, path, row)
    keys, value = COLLECTIONS[collection]
    source = "count_value" if value.endswith("_count") else "sum_value"
    rows = read_epochs(spark, shared, SHARED_ROWS).where(F.col("collection") == collection)
    return rows.select(*keys, F.col(source).alias(value), "batch_id")


def read_hot_changes(spark: SparkSession, path: str) -> DataFrame:
    """Every kept write of the keyed table with its epoch and arrival."""
    return read_epochs(spark, path, HOT_CHANGES)


def read_hot_table(spark: SparkSession, path: str) -> DataFrame:
    """The keyed table: one row per ``user_id``, the last one written."""
    return last_write(read_hot_changes(spark, path), HOT_KEY, WRITES).drop(*WRITES)


def read_hot_buckets(spark: SparkSession, path: str, here: Callable[[Column], Column], through: int | None = None) -> DataFrame:
    """The kept writes of the keys whose bucket is ``here``: those buckets of the base, and
    of the epochs since, which have none, every file."""
    schema = T.StructType([*HOT_CHANGES.fields, T.StructField("bucket", T.IntegerType())])
    rows = read_epochs(spark, path, schema, through=through)
    folder = F.coalesce(here(F.col("bucket")), F.lit(True))
    return rows.where(here(bucket(F.col(HOT_KEY))) & folder).drop("bucket")


def read_hot_key(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The keyed table's row of one key: one bucket of the base, and the epochs since."""
    rows = read_hot_buckets(spark, path, lambda b: b == bucket(F.lit(key))).where(F.col(HOT_KEY) == key)
    return last_write(rows, HOT_KEY, WRITES).drop(*WRITES)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_epochs(spark, path, _QUARANTINE_ROW)


def read_gaps(spark: SparkSession, path: str) -> DataFrame:
    """The offsets that no micro-batch got (see ``operators.offsets``)."""
    return gaps(read_epochs(spark, path, INTERVALS).select(*INTERVALS.names))


def require_root(spark: SparkSession, root: str) -> None:
    """For commands over a pipeline's root: a mistyped one must not look empty."""
    if not Folder(spark, root).exists():
        raise FileNotFoundError(f"nothing is stored at {root}")
