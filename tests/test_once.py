"""Doubles of at-least-once delivery."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators import messages as msg
from tillflow.plans import pipelines
from tillflow.schema import HEADERS, TOPIC
from tillflow.sources.topics import once, topic_files
from tillflow.streaming.run import AVAILABLE_NOW, drain, start


def deliver(spark, path, offsets, headers=None):
    """A file of messages; a message's time is far from when it is delivered."""
    rows = spark.createDataFrame([(o, f'{{"n":{o}}}') for o in offsets], "offset long, value string").select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        "offset", F.timestamp_seconds(1_000_000_000 - 86400 * F.col("offset")).alias("timestamp"), F.lit(0).alias("timestampType"),
        *([F.array(F.struct(F.lit("message_id").alias("key"), F.concat(F.lit("id-"), F.col("offset") % headers).cast("binary").alias("value")))
           .alias("headers")] if headers else []))
    rows.coalesce(1).write.mode("append").parquet(path)


def passed(spark, raw, root, name="q"):
    got = []

    def keep(batch, epoch):
        got.append(sorted(r["offset"] for r in batch.select("offset").collect()))
    query = start(raw, keep, name, f"{root}/checkpoints", AVAILABLE_NOW)
    drain([query])
    return [g for g in got if g], query


def test_doubles_of_one_and_of_later_micro_batches_and_of_a_restart(spark, tmp_path):
    path = f"{tmp_path}/topic"
    for offsets in ([1, 2, 2, 3], [3, 4], [1, 2, 3, 4, 5]):
        deliver(spark, path, offsets)
    raw = once(topic_files(spark, path, maxFilesPerTrigger="1"))
    assert passed(spark, raw, tmp_path)[0] == [[1, 2, 3], [4], [5]]
    deliver(spark, path, [5, 6, 1])
    assert passed(spark, raw, tmp_path)[0] == [[6]]


def test_state_is_bounded_by_time(spark, tmp_path):
    path = f"{tmp_path}/topic"
    for i in range(6):
        deliver(spark, path, range(10 * i, 10 * i + 10))
    got, query = passed(spark, once(topic_files(spark, path, maxFilesPerTrigger="1"), "0 seconds"), tmp_path)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert sum(map(len, got)) == 60
    assert max(held) <= 20 and sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 0


def test_published_identity_tells_doubles_at_other_offsets(spark, tmp_path):
    path = f"{tmp_path}/topic"
    deliver(spark, path, range(8), headers=4)
    raw = topic_files(spark, path, headers=True)
    assert [len(g) for g in passed(spark, once(raw), tmp_path)[0]] == [4]
    batch = topic_files(spark, path, streaming=False, headers=True)
    assert once(batch).count() == 4
    assert {r.message_id for r in msg.decode(batch).collect()} == {f"id-{i}" for i in range(4)}


def test_publishing_twice_is_told_by_its_readers(spark, tmp_path):
    path = f"{tmp_path}/topic"
    deliver(spark, path, range(5))
    for run in "ab":
        drain(pipelines.publish_pipeline(topic_files(spark, path), pipelines.Layout(f"{tmp_path}/{run}"), "parquet", AVAILABLE_NOW,
                                         path=f"{tmp_path}/{run}/out"))
    given = T.StructType([f for f in TOPIC.fields if f.name in ("key", "value")] + [HEADERS])
    both = spark.read.schema(given).parquet(f"{tmp_path}/a/out").union(spark.read.schema(given).parquet(f"{tmp_path}/b/out"))
    again = both.select("*", F.lit("next").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
                        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    assert again.count() == 10 and once(again).count() == 5
