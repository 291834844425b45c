"""Folding in parts: what a fold shuffles and writes."""

import pytest

from tillflow.plans import history, pipelines
from tillflow.sources import stored
from tillflow.sources.epochs import EpochLog, Folder
from tillflow.sources.topics import topic_files
from tillflow.streaming.run import AVAILABLE_NOW, drain
from test_disk import files
from test_streams import YEAR_2010, YEAR_2011, answers, drop, message, one_file_per_batch


def test_bases_are_compressed(spark, tmp_path):
    """the JSON of the archive took most of the disk, and again after folding."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010), message("b", YEAR_2011), "{"])
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    before = answers(spark, layout)
    history.compact(spark, layout)
    assert answers(spark, layout) == before
    for path, end in ((layout.archive, ".json.gz"), (layout.hot, ".zstd.parquet"), (layout.quarantine, ".zstd.parquet")):
        names = [n for n in files(spark, path, "bases") if "/part-" in n]
        assert names and all(n.endswith(end) for n in names), (path, names)


@pytest.mark.parametrize("fold", [400, 1 << 30])
def test_folding_in_parts_keeps_answers(spark, tmp_path, monkeypatch, fold):
    """all rows of an output were shuffled at once."""
    monkeypatch.setattr(history, "FOLD_BYTES", fold)
    monkeypatch.setattr(history, "FILE_BYTES", 600)
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))

    def step(i):
        users = [message(f"u{k % 7}", YEAR_2010 + k * 2 * 10**7, float(k)) for k in range(40)]
        drop(spark, source, [*users, message("none", None), message(None, YEAR_2010), "{"], 100 * i)
        drain(pipelines.main_pipeline(one_file_per_batch(spark, source), layout, trigger=AVAILABLE_NOW, mode="passthrough"))

    step(0), step(1)
    # Of a fold that did not come to its end.
    spark.range(3).selectExpr("CAST(id AS string) AS seed", "2010 AS tran_year").write.partitionBy("tran_year").json(
        f"{layout.archive}/bases/through=1")
    for i in (2, 3):
        before = answers(spark, layout)
        assert sum(before[0].values()) == 42 * i and None in {r[-1] for r in before[0]}
        history.compact(spark, layout)
        assert answers(spark, layout) == before
        if i == 2:
            assert len(stored.read_archive(spark, layout.archive).inputFiles()) > 3
            step(2)
    history.vacuum(spark, layout)
    assert answers(spark, layout) == before
    assert not Folder(spark, f"{layout.archive}/epochs").names()


def test_a_large_year_is_folded_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "FOLD_BYTES", 1)
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010), message("b", YEAR_2011), message("c", None)])
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    log, plans = EpochLog(spark, layout.archive), []
    fold = history._fold

    def spy(session, path, parts, write):
        def seen(rows, out):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            write(rows, out)
        fold(session, path, parts, seen)

    monkeypatch.setattr(history, "_fold", spy)
    assert sorted(years for years, _ in history._years(log, log.finished) if None not in years) == [[2010], [2011]]
    history.compact_archive(spark, layout.archive)
    assert len(plans) == 3 and not any("Exchange" in plan for plan in plans)
    monkeypatch.setattr(history, "FOLD_BYTES", sum(Folder(spark, layout.hot).sizes("epochs").values()) // 2)
    plans.clear()
    history.compact_hot(spark, layout.hot)
    assert 2 <= len(plans) <= 4
