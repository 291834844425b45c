"""Message sources. All deliver the columns of ``schema.TOPIC``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.messages import identity
from tillflow.schema import HEADERS, TOPIC


def kafka_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A Kafka topic as a stream; the connector package comes with spark-submit.

    ``starting_offsets`` counts on the first start only, later ones resume from
    the checkpoint. A topic with few partitions needs ``min_partitions``: Spark
    then splits each partition's offset range over several tasks.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **options,
    }
    if max_offsets_per_trigger is not None:
        settings["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        settings["minPartitions"] = str(min_partitions)
    return spark.readStream.format("kafka").options(**settings).load()


# A task reads so many bytes of topic files. Messages of one kind shrink to a tenth in
# Parquet, and the rows made from them are larger than they: a task of Spark's 128 MB would
# hold gigabytes of a micro-batch.
SPLIT_BYTES = 8 << 20


def topic_files(spark: SparkSession, path: str, streaming: bool = True, headers: bool = False, **options: str) -> DataFrame:
    """A topic exported to Parquet files, positions included.

    ``maxFilesPerTrigger`` and ``maxBytesPerTrigger`` bound a micro-batch. ``headers`` also
    reads the messages' headers, as the option ``includeHeaders`` of a Kafka topic does.
    A stream's tasks read ``SPLIT_BYTES`` each, or a file's row group if that is larger; the
    session keeps that setting, unless it has a smaller one.
    """
    if streaming:
        split = spark.conf.get("spark.sql.files.maxPartitionBytes")
        if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split) > SPLIT_BYTES:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    reader = spark.readStream if streaming else spark.read
    schema = T.StructType([*TOPIC.fields, HEADERS]) if headers else TOPIC
    return reader.schema(schema).options(**options).parquet(path)


def once(raw: DataFrame, within: str = "1 hour") -> DataFrame:
    """The topic without messages that it delivers again ``within`` that time: the first
    of each identity (see ``operators.messages.identity``) passes.

    Delivery and publishing are at least once, so restarts repeat messages. The time is
    that of processing, not the producer's: no message is ever late, so none is lost,
    whatever times the messages carry, and the state holds the identities of that time
    only. On a batch every later double goes.
    """
    seen = raw.select("*", identity(raw).alias("__id"), F.current_timestamp().alias("__seen"))
    if raw.isStreaming:
        seen = seen.withWatermark("__seen", within).dropDuplicatesWithinWatermark(["__id"])
    else:
        seen = seen.dropDuplicates(["__id"])
    return seen.drop("__id", "__seen")


def text_files(spark: SparkSession, path: str, topic: str, streaming: bool = True, **options: str) -> DataFrame:
    """Plain files of one JSON message per line: payload only, no positions."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.options(**options).text(path)
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
