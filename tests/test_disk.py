"""What the main pipeline keeps on disk."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tillflow.catalog import QUERIES
from tillflow.operators.keyed import last_write
from tillflow.plans import pipelines
from tillflow.session import child
from tillflow.sources import stored
from tillflow.sources.epochs import Folder
from tillflow.sources.topics import topic_files
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, drain
from test_streams import YEAR_2010, YEAR_2011, drop, message


def files(spark, path, below=""):
    """The names of all files at or below a folder."""
    folder = Folder(spark, path)
    out = []
    for status in folder._fs.listStatus(folder._at(below)):
        name = f"{below}/{status.getPath().getName()}".lstrip("/")
        out += files(spark, path, name) if status.isDirectory() else [name]
    return out


def test_outputs_are_compressed(spark, tmp_path):
    """F2 to F14: the JSON of the archive took most of the disk."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010), message("b", YEAR_2011), "{"])
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    for path, end in ((layout.archive, ".json.gz"), (layout.hot, ".zstd.parquet"), (layout.quarantine, ".zstd.parquet")):
        names = [n for n in files(spark, path, "epochs") if "/part-" in n]
        assert names and all(n.endswith(end) for n in names), (path, names)
    assert stored.read_archive(spark, layout.archive).count() == 2


def test_rows_of_a_micro_batch_are_kept_compressed_and_only_meanwhile(spark, tmp_path, monkeypatch):
    """F2 to F14: they were cached uncompressed, and what did not fit in memory went to disk."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010), message("b", YEAR_2011), "{"])
    # Left behind by a run that was killed.
    spark.range(50).write.parquet(layout.batch)
    kept, write = [], sinks.EpochFiles.__call__

    def spy(self, batch, *more):
        if self.path in (layout.archive, layout.hot, layout.quarantine):
            kept.append(sorted(n for n in files(spark, layout.batch) if n.startswith("part-")))
        return write(self, batch, *more)

    monkeypatch.setattr(sinks.EpochFiles, "__call__", spy)
    monkeypatch.setattr(sinks, "cached", lambda batch: pytest.fail("a micro-batch is cached"))
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    assert len(kept) == 3 and kept[0] and kept[0] == kept[1] == kept[2]
    assert all(n.endswith(".zstd.parquet") for n in kept[0])
    assert not Folder(spark, layout.batch).exists()
    assert stored.read_archive(spark, layout.archive).count() == 2
    assert stored.read_quarantine(spark, layout.quarantine).count() == 1


def test_shuffled_rows_go_with_their_job(spark):
    """F2 to F14: they stayed until the driver collected garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    own = child(spark)

    def shuffled():
        blocks = disk.getAllBlocks()
        return {b for b in (str(blocks.apply(i)) for i in range(blocks.size())) if b.startswith("shuffle_")}

    before = shuffled()
    rows = own.range(0, 4000, 1, 4).select((F.col("id") % 50).cast("string").alias("user_id"), F.col("id").alias("n"))
    answer = last_write(rows, "user_id", ["n"])
    assert answer.count() == 50
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    # An answer taken twice shuffles its rows again.
    assert sorted(answer.collect()) == sorted(answer.collect())
    assert len(QUERIES["agg_year_count"](spark, SMALL).collect()) > 1
