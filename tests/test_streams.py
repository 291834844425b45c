"""Sinks and pipelines: stream equals batch, restart, replay, agreement."""

import json
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle
from conftest import SMALL
from edges import EDGES
from tillflow import workload
from tillflow.operators import serving, totals
from tillflow.operators.keyed import ARRIVAL
from tillflow.plans import history, pipelines
from tillflow.plans.rows import ALL, transactions
from tillflow.schema import HOT, TOPIC, struct
from tillflow.sources import stored
from tillflow.sources.epochs import EpochLog, Folder, read_epochs
from tillflow.sources.topics import kafka_topic, text_files, topic_files
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, await_any, drain, start_totals
from tillflow.streaming.run import start as start_sink

YEAR = "year_wise_total_sales_count"
YEAR_2010, YEAR_2011 = 1270000000, 1300000000


def message(username, registered, amount=10.0, nationality="US"):
    return json.dumps({"results": [{"user": {"username": username, "registered": registered}}],
                       "nationality": nationality,
                       "tran_detail": {"tran_card_type": ["Visa"], "product_id": "P", "tran_amount": amount}})


def drop(spark, path, payloads, first_offset=0):
    """Add one file of messages to a topic directory."""
    rows = [(None, p.encode(), "t", 0, first_offset + i, None, 0) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, TOPIC).coalesce(1).write.mode("append").parquet(path)


def one_file_per_batch(spark, path):
    return topic_files(spark, path, maxFilesPerTrigger="1")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_update_snapshots_hold_running_totals(spark, tmp_path):
    """T1, T3: three files; the latest total is true, the summed one counts again."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    for i in range(3):
        drop(spark, source, [message("a", YEAR_2010)] * 2 + [message("b", YEAR_2011)] * 2, i * 4)
    drain([pipelines.start_collection(one_file_per_batch(spark, source), layout, YEAR, trigger=AVAILABLE_NOW)])
    docs = stored.read_collection(spark, layout.collection(YEAR), YEAR)
    assert bag(docs.select("batch_id", "tran_year", "tran_year_count")) == Counter(
        [(b, y, 2 * b + 2) for b in range(3) for y in (2010, 2011)])
    assert bag(serving.latest_totals(docs, YEAR)) == Counter([(2010, 6), (2011, 6)])
    assert bag(serving.dashboard_rollup(docs, YEAR)) == Counter([(2010, 12), (2011, 12)])
    assert bag(serving.dashboard_rollup(docs, YEAR, n=2)) == Counter([(2010, 6), (2011, 6)])


@pytest.mark.parametrize("pipeline", [pipelines.main_pipeline, pipelines.separate_pipeline])
def test_restart_neither_loses_nor_doubles(spark, tmp_path, pipeline):
    """T2 for every output: run, rerun without input, rerun after one more file."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))

    def run():
        drain(pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
        totals_now = {n: bag(serving.latest_totals(stored.read_collection(spark, layout.collection(n), n), n))
                      for n in totals.COLLECTIONS}
        return stored.read_archive(spark, layout.archive).count(), totals_now[YEAR], totals_now

    drop(spark, source, [message("a", YEAR_2010)])
    archived, years, before = run()
    assert (archived, years) == (1, Counter([(2010, 1)]))
    assert run() == (archived, years, before)
    drop(spark, source, [message("b", YEAR_2010)], 1)
    archived, years, _ = run()
    assert (archived, years) == (2, Counter([(2010, 2)]))


def test_replayed_epochs_change_nothing(spark, tmp_path):
    """T4: every batch written twice under its epoch."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    for i in range(3):
        drop(spark, source, [message(f"c{k % 4}", YEAR_2010, float(100 * i + k)) for k in range(8)], 8 * i)
    once = sinks.keyed(sinks.epoch_files(layout.hot))

    def twice(batch, epoch):
        once(batch, epoch)
        once(batch, epoch)

    rows = transactions(one_file_per_batch(spark, source), HOT, mode="passthrough")
    drain([start_sink(rows, twice, "twice", layout.checkpoints, AVAILABLE_NOW)])
    assert stored.read_hot_changes(spark, layout.hot).count() == 12
    assert bag(stored.read_hot_table(spark, layout.hot).select("user_id", "tran_amount")) == Counter(
        [(f"c{k}", 204.0 + k) for k in range(4)])


def test_the_last_write_wins_whatever_the_producers_clock_says(spark, tmp_path):
    """A later micro-batch wins, in it the later position; the file table and a table
    that overwrites by itself agree."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    start = datetime(2020, 1, 1)
    for i, offsets in enumerate([(5, 4), (1, 0), (3, 2)]):
        rows = [(None, message("a", YEAR_2010, float(o)).encode(), "t", 0, o, start - timedelta(days=o + 10 * i), 0) for o in offsets]
        spark.createDataFrame(rows, TOPIC).coalesce(1).write.mode("append").parquet(source)
    table = {}

    def overwrite(batch, epoch):
        table.update({r.user_id: r.tran_amount for r in batch.collect()})

    def both(batch, epoch):
        sinks.keyed(overwrite, keep_arrival=False)(batch, epoch)
        sinks.keyed(sinks.epoch_files(layout.hot))(batch, epoch)

    rows = transactions(one_file_per_batch(spark, source), HOT, mode="passthrough")
    drain([start_sink(rows, both, "both", layout.checkpoints, AVAILABLE_NOW)])
    assert {r.user_id: r.tran_amount for r in stored.read_hot_table(spark, layout.hot).collect()} == table == {"a": 3.0}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Both pipelines over the same multi-user messages."""
    layouts = {}
    for pipeline in (pipelines.main_pipeline, pipelines.separate_pipeline):
        layout = pipelines.Layout(str(tmp_path_factory.mktemp("run")))
        raw = workload.staged_stream(spark, SMALL, workload.party_topic)
        drain(pipeline(raw, layout, trigger=AVAILABLE_NOW))
        layouts[pipeline.__name__] = layout
    batch = transactions(topic_files(spark, workload.stage(spark, SMALL, workload.party_topic), False))
    return layouts, batch


@pytest.mark.parametrize("name", ["main_pipeline", "separate_pipeline"])
def test_stream_equals_batch(spark, run, name):
    layout, batch = run[0][name], run[1]
    assert bag(stored.read_archive(spark, layout.archive)) == bag(batch.select(*ALL))
    for collection in totals.COLLECTIONS:
        docs = stored.read_collection(spark, layout.collection(collection), collection)
        assert docs.select("batch_id").distinct().count() > 1
        assert bag(serving.latest_totals(docs, collection)) == bag(totals.total(batch, collection))


@pytest.mark.parametrize("name", ["main_pipeline", "separate_pipeline"])
def test_sinks_agree(spark, run, name):
    """Every hot row is, value by value, an archived row."""
    layout = run[0][name]
    hot = bag(stored.read_hot_table(spark, layout.hot))
    archived = bag(stored.read_archive(spark, layout.archive).select(*HOT))
    assert set(hot) <= set(archived)
    assert {r[0] for r in hot} == {r[0] for r in archived}
    assert max(hot.values()) == 1


def test_invariants(spark, run):
    batch = run[1].cache()
    value = {n: totals.total(batch, n).agg(F.sum(v)).first()[0] for n, (_, v) in totals.COLLECTIONS.items()}
    known = batch.agg(F.count("tran_amount"), F.count("nationality"), F.count("tran_card_type")).first()
    assert list(value.values())[:3] == list(known)
    amount = sum(round(r[0] * 100) for r in batch.select("tran_amount").collect()) / 100
    assert value["card_type_wise_total_sales"] == pytest.approx(amount, abs=0.005)
    assert value["year_country_wise_total_sales"] == pytest.approx(amount, abs=0.005)
    users = workload.party_topic(spark, SMALL).select(
        F.size(F.from_json(F.col("value").cast("string"), "results ARRAY<STRING>")["results"]).alias("n"))
    assert batch.count() == users.agg(F.sum("n")).first()[0]
    batch.unpersist()


def answers(spark, layout):
    docs = {n: stored.read_collection(spark, layout.collection(n), n) for n in totals.COLLECTIONS}
    return (bag(stored.read_archive(spark, layout.archive)), bag(stored.read_hot_table(spark, layout.hot)),
            bag(stored.read_quarantine(spark, layout.quarantine)), bag(stored.read_quarantine(spark, layout.null_keys)),
            {n: (bag(d), bag(serving.latest_totals(d, n))) for n, d in docs.items()})


def test_upkeep_keeps_answers_and_lets_the_stream_go_on(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))

    def go():
        drain(pipelines.main_pipeline(one_file_per_batch(spark, source), layout, trigger=AVAILABLE_NOW, mode="passthrough"))

    def step(i):
        drop(spark, source, [message("a", YEAR_2010, i + 0.5), message("b", YEAR_2011, i + 1.0), "{", message(None, YEAR_2010)], 4 * i)
        go()

    for i in range(5):
        step(i)
        if i % 2:
            before = answers(spark, layout)
            history.compact(spark, layout)
            assert answers(spark, layout) == before
        if i == 3:
            history.vacuum(spark, layout)
            assert answers(spark, layout) == before
            assert not Folder(spark, f"{layout.archive}/epochs").names()
    archive, hot, quarantine, _, collections = answers(spark, layout)
    assert sum(archive.values()) == 15 and sum(quarantine.values()) == 10
    assert {r[0]: r[-1] for r in hot} == {"a": 4.5, "b": 5.0}
    assert collections[YEAR][1] == Counter([(2010, 10), (2011, 5)]) and sum(collections[YEAR][0].values()) == 10


def test_upkeep_under_a_running_stream(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010)])
    queries = pipelines.main_pipeline(topic_files(spark, source), layout, trigger={"processingTime": "0 seconds"}, mode="passthrough")
    try:
        for i in range(1, 4):
            drop(spark, source, [message("a", YEAR_2010, float(i))], i)
            history.compact(spark, layout)
            for query in queries:
                query.processAllAvailable()
        assert [r.tran_amount for r in stored.read_hot_table(spark, layout.hot).collect()] == [3.0]
        assert stored.read_archive(spark, layout.archive).count() == 4
        docs = stored.read_collection(spark, layout.collection(YEAR), YEAR)
        assert bag(serving.latest_totals(docs, YEAR)) == Counter([(2010, 4)])
    finally:
        for query in queries:
            query.stop()


def test_upkeep_of_an_archive_with_sparks_own_log_is_refused(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010)])
    drain(pipelines.separate_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    with pytest.raises(ValueError, match="file sink"):
        history.compact(spark, layout)
    assert stored.read_archive(spark, layout.archive).count() == 1
    with pytest.raises(FileNotFoundError):
        history.compact(spark, pipelines.Layout(str(tmp_path / "nowhere")))


def test_readers_see_finished_epochs_only(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = struct(id=T.LongType())
    write = sinks.epoch_files(path)
    assert read_epochs(spark, path, schema).count() == 0
    write(spark.range(3), 0)
    # A write that has not come to its end, or not to its log entry.
    spark.range(10).write.parquet(f"{path}/epochs/batch_id=1")
    assert read_epochs(spark, path, schema).count() == 3
    write(spark.range(4), 1)
    assert read_epochs(spark, path, schema).groupBy("batch_id").count().sort("batch_id").collect() == [(0, 3), (1, 4)]
    # A replay of a whole epoch leaves its files alone, so a reader of them goes on.
    reading = read_epochs(spark, path, schema)
    write(spark.range(99), 1)
    assert reading.count() == 7
    # An epoch without rows is finished, too.
    write(spark.range(0), 2, 0)
    assert EpochLog(spark, path).finished == 2 and read_epochs(spark, path, schema).count() == 7


def test_one_key_is_read_from_one_bucket(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message(f"u{i}", YEAR_2010, float(i)) for i in range(300)])
    go = lambda: drain([pipelines.start_hot(topic_files(spark, source), layout, trigger=AVAILABLE_NOW, mode="passthrough")])
    go()
    history.compact_hot(spark, layout.hot)
    assert [r.tran_amount for r in stored.read_hot_key(spark, layout.hot, "u7").collect()] == [7.0]
    plan = stored.read_hot_key(spark, layout.hot, "u7")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan)
    held = stored.read_hot_changes(spark, layout.hot).inputFiles()
    here = spark.range(1).select(stored.bucket(F.lit("u7"))).first()[0]
    assert 0 < sum(f"bucket={here}/" in f for f in held) <= len(held) / 10
    drop(spark, source, [message("u7", YEAR_2010, 99.0)], 300)
    go()
    assert [r.tran_amount for r in stored.read_hot_key(spark, layout.hot, "u7").collect()] == [99.0]
    assert stored.read_hot_key(spark, layout.hot, "nobody").count() == 0


def test_few_jobs_a_trigger(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message(f"u{i}", YEAR_2010 + i * 10**7) for i in range(50)])
    queries = pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW)
    drain(queries)
    jobs = sum(len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))) for q in queries)
    assert 0 < jobs <= 12
    names = Folder(spark, layout.collections)
    assert names.names("epochs") == ["batch_id=0"] and not Folder(spark, layout.quarantine).names("epochs")
    years = Folder(spark, f"{layout.archive}/epochs/batch_id=0")
    assert all(sum(n.startswith("part-") for n in years.names(y)) == 1 for y in years.names() if y.startswith("tran_year="))


def test_sparks_own_archive_sink_writes_few_files(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    for i in range(6):
        drop(spark, source, [message(f"u{i}{k}", YEAR_2010) for k in range(20)], 20 * i)
    drain([pipelines.start_archive(topic_files(spark, source), layout, AVAILABLE_NOW)])
    assert len(spark.read.json(layout.archive).inputFiles()) == 1
    salted = pipelines.Layout(str(tmp_path / "salted"))
    drain([pipelines.start_archive(topic_files(spark, source), salted, AVAILABLE_NOW, tuning=sinks.Tuning(files_per_year=3))])
    assert 1 <= len(spark.read.json(salted.archive).inputFiles()) <= 3


@pytest.mark.parametrize("pipeline, queries", [
    (pipelines.main_pipeline, 2), (pipelines.separate_pipeline, 8), (pipelines.keyed_pipeline, 4)])
def test_each_query_reads_each_message_once(spark, tmp_path, pipeline, queries):
    """However many sinks a query has, a micro-batch is not recomputed for them."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message(f"u{i}", YEAR_2010) for i in range(50)])
    running = pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW)
    drain(running)
    read = {q.name: sum(p["numInputRows"] for p in q.recentProgress) for q in running}
    assert len(read) == queries and set(read.values()) == {50}


def test_an_epoch_writes_few_files(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 40).withColumn("k", F.col("id") % 2).persist()
    sinks.epoch_files(str(tmp_path / "few"), rows_per_file=300)(rows, 0)
    sinks.epoch_files(str(tmp_path / "by_key"), "json", ("k",), 600)(rows, 0)
    few = spark.read.parquet(str(tmp_path / "few" / "epochs"))
    assert len(few.inputFiles()) == 4 and few.count() == 1000
    assert len(spark.read.json(str(tmp_path / "by_key" / "epochs")).inputFiles()) == 4
    rows.unpersist()


CHECKPOINTS = [(pipelines.main_pipeline, q) for q in ("rows", "totals")] + [
    (pipelines.separate_pipeline, q) for q in ("archive", "hot", "quarantine", *totals.COLLECTIONS)] + [
    (pipelines.keyed_pipeline, q) for q in ("archive", "hot", "quarantine")]


@pytest.mark.parametrize("pipeline, lost", CHECKPOINTS, ids=[f"{p.__name__}-{q}" for p, q in CHECKPOINTS])
def test_no_output_goes_on_from_a_lost_checkpoint(spark, tmp_path, pipeline, lost):
    """Any one checkpoint lost: nothing starts and nothing changes."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010), "{"])
    drain(pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    before = answers(spark, layout)
    (tmp_path / "out" / "checkpoints" / lost).rename(tmp_path / "lost")
    drop(spark, source, [message("a", YEAR_2010)], 2)
    with pytest.raises(ValueError, match="checkpoint"):
        pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW)
    assert not spark.streams.active and answers(spark, layout) == before


def test_damaged_messages_are_set_aside_and_the_rest_flows(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    payloads = [p for p, _, _ in EDGES.values()]
    rows = [(None, None if p is None else p.encode(), "t", 0, i, None, 0) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, TOPIC).write.parquet(source)
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    users = [row for _, _, rows in EDGES.values() for row in rows]
    archive = stored.read_archive(spark, layout.archive)
    assert archive.count() == len(users)
    batch = transactions(topic_files(spark, source, streaming=False))
    assert bag(archive) == bag(batch.select(*ALL))
    reasons = Counter(r.reject_reason for r in stored.read_quarantine(spark, layout.quarantine).collect())
    expected = Counter(reason for _, reason, _ in EDGES.values() if reason)
    expected["null key"] = sum(row[3] is None for row in users)
    assert reasons == expected
    assert stored.read_hot_table(spark, layout.hot).where("user_id IS NULL").count() == 0


def test_text_files_make_a_topic(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.json").write_text(message(f"u{i}", YEAR_2010) + "\n")
    layout = pipelines.Layout(str(tmp_path / "out"))
    raw = text_files(spark, str(tmp_path / "in"), "commerce", pathGlobFilter="*.json", maxFilesPerTrigger="1")
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in TOPIC]
    drain(pipelines.main_pipeline(raw, layout, trigger=AVAILABLE_NOW, mode="passthrough"))
    assert {r.user_id for r in stored.read_hot_table(spark, layout.hot).collect()} == {"u0", "u1"}


def test_default_fill_in_the_stream(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, ['{"results":[{"user":{"username":"u"}}],"nationality":"US"}'])
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW,
                                  mode="passthrough", defaults=True))
    row = stored.read_hot_table(spark, layout.hot).first()
    assert (row.tran_card_type, row.product_id, row.tran_amount) == ("Visa", "PID-001", 150.5)
    name = "card_type_wise_total_sales"
    assert bag(serving.latest_totals(
        stored.read_collection(spark, layout.collection(name), name), name)) == Counter([("Visa", 150.5)])


def test_five_second_trigger_picks_up_new_files(spark, tmp_path):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010, 1.0)])
    queries = pipelines.main_pipeline(topic_files(spark, source), layout, mode="passthrough")
    try:
        for offset, expected in enumerate((1, 2)):
            if offset:
                drop(spark, source, [message("a", YEAR_2010, 2.0)], offset)
            for query in queries:
                query.processAllAvailable()
            docs = stored.read_collection(spark, layout.collection(YEAR), YEAR)
            assert bag(serving.latest_totals(docs, YEAR)) == Counter([(2010, expected)])
            assert [r.tran_amount for r in stored.read_hot_table(spark, layout.hot).collect()] == [float(expected)]
    finally:
        for query in queries:
            query.stop()


def test_collections_are_empty_and_typed_before_the_first_batch(spark, tmp_path):
    nowhere = str(tmp_path / "none")
    for name, (keys, value) in totals.COLLECTIONS.items():
        docs = stored.read_collection(spark, nowhere, name)
        assert serving.latest_totals(docs, name).columns == [*keys, value]
        assert serving.dashboard_rollup(docs, name).count() == 0
    assert stored.read_hot_table(spark, nowhere).columns == list(HOT)
    assert stored.read_archive(spark, nowhere).count() == 0


def test_console_prints_the_first_rows_in_full_width(spark, tmp_path, capfd):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("someone-with-a-rather-long-user-name", YEAR_2010)])
    drain(pipelines.keyed_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    drain(pipelines.raw_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW))
    printed = capfd.readouterr().out
    assert "Batch: 0" in printed and "someone-with-a-rather-long-user-name" in printed
    assert "timestampType" in printed


def test_main_pipeline_prints_year_by_country(spark, tmp_path, capfd):
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010)])
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, trigger=AVAILABLE_NOW, console=True))
    assert "tran_year_country_total_sales" in capfd.readouterr().out
    assert stored.read_collection(spark, layout.collection(pipelines.CONSOLE_COLLECTION),
                                  pipelines.CONSOLE_COLLECTION).count() == 1


def test_connector_sinks_take_the_place_of_files(spark, tmp_path):
    """A file format stands in for the connectors, whose jars are not here."""
    source, layout = str(tmp_path / "in"), pipelines.Layout(str(tmp_path / "out"))
    drop(spark, source, [message("a", YEAR_2010, 1.0), message("a", YEAR_2010, 2.0)])
    targets = pipelines.Targets(
        hot=sinks.connector("parquet", path=str(tmp_path / "table")),
        collections=lambda name: sinks.connector("json", path=str(tmp_path / name), epoch_column="batch_id"))
    drain(pipelines.main_pipeline(topic_files(spark, source), layout, targets, AVAILABLE_NOW, "passthrough"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.columns == list(HOT) and [r.tran_amount for r in table.collect()] == [2.0]
    assert [r.asDict() for r in spark.read.json(str(tmp_path / YEAR)).collect()] == [
        {"batch_id": 0, "tran_year": 2010, "tran_year_count": 2}]


def test_few_state_partitions_are_used_and_the_setting_is_restored(spark, tmp_path, confs):
    confs(spark__sql__shuffle__partitions="8")
    source = str(tmp_path / "in")
    drop(spark, source, [message("a", YEAR_2010)])
    rows = transactions(topic_files(spark, source), totals.needed([YEAR]))
    query = start_totals(totals.total(rows, YEAR), sinks.epoch_files(str(tmp_path / "out")), "few",
                         str(tmp_path / "cp"), AVAILABLE_NOW, state_partitions=2)
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    (progress,) = [p for p in query.recentProgress if p["stateOperators"] and p["numInputRows"]][:1]
    assert progress["stateOperators"][0]["numShufflePartitions"] == 2


def test_a_failing_query_is_seen(spark, tmp_path):
    source = str(tmp_path / "in")
    drop(spark, source, [message("a", YEAR_2010)])

    def fail(batch, epoch):
        raise RuntimeError("no such table")

    layout = pipelines.Layout(str(tmp_path / "out"))
    queries = [start_sink(topic_files(spark, source), fail, "failing", layout.checkpoints),
               *pipelines.raw_pipeline(topic_files(spark, source), layout)]
    with pytest.raises(StreamingQueryException, match="no such table"):
        await_any(queries)
    assert not any(query.isActive for query in queries)


class Recorder:
    """Stands in for a session and its reader: the connector is not installed."""

    def __init__(self):
        self.seen = {}
        self.readStream = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self


def test_kafka_source_options():
    session = Recorder()
    kafka_topic(session, "h1:9092,h2:9092", "commerce", max_offsets_per_trigger=10, min_partitions=4)
    assert session.seen == {
        "format": "kafka", "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "commerce",
        "startingOffsets": "latest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "10", "minPartitions": "4"}
    session = Recorder()
    kafka_topic(session, "h:9092", "t", "earliest", fail_on_data_loss=False, includeHeaders="true")
    assert session.seen == {
        "format": "kafka", "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "includeHeaders": "true"}


def test_arrival_is_part_of_every_row(spark, run):
    assert run[1].columns[:len(ARRIVAL)] == list(ARRIVAL)


def test_oracle_compares_cells():
    con = oracle.connect(SMALL)
    assert con.execute("SELECT count(*) FROM orders").fetchone()[0] == 1500
