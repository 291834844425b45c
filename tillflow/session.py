"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on. Dates are rendered as text in the session
# time zone, so it is pinned; running totals live in RocksDB so that state size
# is bounded by executor disk, not heap, and a commit uploads only its changes.
# What a job shuffled goes when it ends; else it stays until the driver collects garbage.
# A cached micro-batch lives for seconds and may spill; compressing its columns
# cost about an eighth of the main pipeline's time.
RUNTIME_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def child(spark: SparkSession) -> SparkSession:
    """A pinned session of its own with the caller's other settings: neither settings
    nor views of a query stay behind in the caller's session."""
    own = spark.newSession()
    for key, value in spark.sql("SET").collect():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    return pin(own)


def build_session(app_name: str = "tillflow", **conf: str) -> SparkSession:
    """A new session; the master and cluster sizes come from spark-submit.

    ``spark.sql.shuffle.partitions`` is frozen into a streaming checkpoint by
    its first run, so choose it for the cluster before that.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local-mode session without
    that setting may fall back to a folder of this machine, which goes when the
    application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tillflow-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/tillflow/{name}-{uuid.uuid4().hex}"
