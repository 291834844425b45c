"""Settings, and where scratch data may lie."""

import pytest

from tillflow.session import RUNTIME_CONF, child, pin, shared_dir


class Session:
    def __init__(self, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{base}/tillflow/x-") and first != second


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(spark__master="yarn"), "x")
    assert shared_dir(Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///c/"), "x").startswith(
        "hdfs:///c/tillflow/x-")
    assert "tillflow-" in shared_dir(Session(spark__master="local[2]"), "x")


def test_pinned_settings(spark):
    own = pin(spark.newSession())
    assert all(own.conf.get(key) == value for key, value in RUNTIME_CONF.items())


def test_a_child_has_the_callers_settings_and_changes_none(spark, confs):
    confs(spark__sql__shuffle__partitions="5", spark__sql__session__timeZone="Asia/Tokyo")
    own = child(spark)
    assert own.conf.get("spark.sql.shuffle.partitions") == "5"
    assert own.conf.get("spark.sql.session.timeZone") == "UTC" and spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
