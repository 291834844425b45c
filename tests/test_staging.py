"""Staged topics, and what a task of a micro-batch reads."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow import workload
from tillflow.plans import pipelines
from tillflow.schema import struct
from tillflow.session import child, shared_dir
from tillflow.sources import stored, topics
from tillflow.sources.epochs import Folder, read_epochs
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, drain, start


def tables(path, keys):
    """Orders of these keys, all of one customer."""
    def put(name, **columns):
        pq.write_table(pa.table(columns), f"{path}/{name}.parquet")
    n = len(keys)
    put("orders", o_orderkey=pa.array(keys, pa.int64()), o_custkey=pa.array([1] * n, pa.int64()),
        o_totalprice=[1.5] * n, o_orderdate=pa.array([0] * n, pa.timestamp("us")))
    put("customer", c_custkey=pa.array([1], pa.int64()), c_name=["c"], c_nationkey=pa.array([1], pa.int64()), c_mktsegment=["m"])
    put("nation", n_nationkey=pa.array([1], pa.int64()), n_name=["n"])
    return str(path)


@pytest.mark.parametrize("keys", [range(2400), [*range(1500), 1700, 2399], [*range(700), 2399]])
def test_files_are_small_and_a_delivery_is_a_micro_batch(spark, tmp_path, monkeypatch, keys):
    """F2 to F16: a file held a million messages, which one task read; parts without rows
    must not shift the deliveries."""
    monkeypatch.setattr(workload, "MESSAGES_PER_FILE", 100)
    own = child(spark)
    path = tables(tmp_path, [*keys])
    staged = workload.stage(own, path)
    files = [f for f in Folder(own, staged).names() if f.startswith("part-")]
    assert len(files) == 3 * -(-len(keys) // 300)
    assert max(r["count"] for r in own.read.parquet(staged).groupBy(F.input_file_name()).count().collect()) <= 3 * 100
    got = {}
    raw = workload.staged_stream(own, path)
    drain([start(raw, lambda batch, epoch: got.update({epoch: {(r.partition, r.offset) for r in batch.collect()}}), "r",
                 shared_dir(own, "staging-test"), AVAILABLE_NOW)])
    want = {}
    for k in keys:
        want.setdefault(k // 8 * 3 // 300, set()).add((k % 8, k // 8))
    assert {e: rows for e, rows in got.items() if rows} == want


def test_topic_files_come_in_small_splits(spark, tmp_path):
    own, key = child(spark), "spark.sql.files.maxPartitionBytes"
    own.conf.set(key, "128m")
    topics.topic_files(own, str(tmp_path), streaming=False)
    assert own.conf.get(key) == "128m"
    topics.topic_files(own, str(tmp_path))
    assert int(own.conf.get(key)) == topics.SPLIT_BYTES
    own.conf.set(key, "1m")
    topics.topic_files(own, str(tmp_path))
    assert own.conf.get(key) == "1m"


def test_few_rows_picked_from_many_are_not_read_by_one_task(spark, tmp_path):
    """F2 to F10: the refused messages of a micro-batch were read in one task, and with
    them all its rows."""
    task = F.udf(lambda i: TaskContext.get().taskAttemptId(), "long").asNondeterministic()
    batch = spark.range(0, 1000, 1, 8).select("id", task("id").alias("task")).where("id % 100 = 0")
    seen = {}
    for name, read in (("picked", 1000), ("whole", 10)):
        path = str(tmp_path / name)
        sinks.epoch_files(path, rows_per_file=100)(batch, 0, 10, read)
        rows = read_epochs(spark, path, struct(id=T.LongType(), task=T.LongType()))
        assert sorted(r.id for r in rows.collect()) == [*range(0, 1000, 100)]
        seen[name] = rows.select("task").distinct().count()
    assert seen == {"picked": 8, "whole": 1}


def test_rows_without_a_key_are_not_written_by_one_task(spark, tmp_path):
    """all of a micro-batch's went into one file."""
    own, layout = child(spark), pipelines.Layout(str(tmp_path / "root"))
    users = [f'{{"user":{{"username":{name}}}}}' for name in ('"a"', "null", "null")]
    message = '{"results":[' + ",".join(users) + '],"nationality":"n"}'
    raw = own.range(20).selectExpr(
        "CAST(NULL AS binary) AS key", f"CAST('{message}' AS binary) AS value", "'t' AS topic", "0 AS partition", "id AS offset",
        "timestamp_seconds(id) AS timestamp", "0 AS timestampType")
    raw.coalesce(4).write.option("maxRecordsPerFile", 5).parquet(str(tmp_path / "topic"))
    tuning = pipelines.Tuning(rows_per_file=10)
    drain([pipelines.start_hot(topics.topic_files(own, str(tmp_path / "topic")), layout, trigger=AVAILABLE_NOW, tuning=tuning)])
    files = [f for f in Folder(own, layout.null_keys).names("epochs/batch_id=0") if f.startswith("part-")]
    assert len(files) > 1
    assert stored.read_quarantine(own, layout.null_keys).count() == 40
