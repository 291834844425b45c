"""The streaming jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.enrich import hot_rows
from tillflow.operators.messages import decode
from tillflow.operators.offsets import intervals
from tillflow.operators.totals import COLLECTIONS, SHARED, all_totals, needed, pick, total
from tillflow.plans.publish import completed_messages, refused_messages
from tillflow.plans.rows import ALL, audited_transactions, transactions
from tillflow.schema import HOT
from tillflow.sources.epochs import EpochLog, exists
from tillflow.streaming import sinks
from tillflow.streaming.run import EVERY_5_SECONDS, Sink, start, start_format, start_totals
from tillflow.streaming.sinks import Tuning

CONSOLE_COLLECTION = "year_country_wise_total_sales"
# Fixed value: the keyed table's name.
HOT_TABLE = "trans_message_detail_tbl"


@dataclass(frozen=True)
class Layout:
    """Where a pipeline keeps its outputs and, next to them, its checkpoints."""
    root: str
    checkpoint_root: str | None = None

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def hot(self) -> str:
        return f"{self.root}/{HOT_TABLE}"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def null_keys(self) -> str:
        return f"{self.root}/null_keys"

    @property
    def offsets(self) -> str:
        """The intervals of offsets that arrived."""
        return f"{self.root}/offsets"

    @property
    def collections(self) -> str:
        """All collections of one aggregate, written together."""
        return f"{self.root}/{SHARED}"

    @property
    def batch(self) -> str:
        """The rows of the micro-batch that is being written."""
        return f"{self.root}/_batch"

    @property
    def checkpoints(self) -> str:
        return self.checkpoint_root or f"{self.root}/checkpoints"

    def collection(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass(frozen=True)
class Targets:
    """Connector sinks to use in place of files; None or a missing name means files."""
    hot: Sink | None = None
    collections: Callable[[str], Sink] | None = None


def _hot_sink(layout: Layout, targets: Targets, rejected: Sink | None, tuning: Tuning) -> Callable[..., None]:
    if targets.hot is not None:
        return sinks.keyed(targets.hot, rejected, keep_arrival=False)
    return sinks.keyed(sinks.epoch_files(layout.hot, rows_per_file=tuning.rows_per_file, compression="zstd"), rejected)


def _refuse_lost_checkpoints(raw: DataFrame, layout: Layout, outputs: dict[str, str]) -> None:
    """Every output against the checkpoint of the query that writes it, before any
    query starts. A new checkpoint counts epochs from 0 again: its epochs would be taken
    for replays of old ones, or Spark's file sink, finding them in its log, would drop
    them, and running totals would start from nothing."""
    spark = raw.sparkSession
    for output, query in outputs.items():
        written = EpochLog(spark, output).started or exists(spark, f"{output}/_spark_metadata")
        checkpoint = f"{layout.checkpoints}/{query}"
        if written and not exists(spark, f"{checkpoint}/metadata"):
            raise ValueError(f"{output} has epochs of a checkpoint that is not at {checkpoint}")


def start_collection(raw: DataFrame, layout: Layout, collection: str, targets: Targets = Targets(),
                     trigger: dict = EVERY_5_SECONDS, mode: str = "draw", defaults: bool = False,
                     tuning: Tuning = Tuning()) -> StreamingQuery:
    """Running totals of one collection; each batch emits the keys that changed."""
    _refuse_lost_checkpoints(raw, layout, {layout.collection(collection): collection})
    rows = transactions(raw, needed([collection]), mode, defaults)
    sink = targets.collections(collection) if targets.collections else sinks.epoch_files(layout.collection(collection), files=1)
    return start_totals(total(rows, collection), sink, collection, layout.checkpoints, trigger, tuning.state_partitions)


def start_archive(raw: DataFrame, layout: Layout, trigger: dict = EVERY_5_SECONDS, mode: str = "draw",
                  defaults: bool = False, tuning: Tuning = Tuning()) -> StreamingQuery:
    """JSON files of the archive rows, in one directory per year, by Spark's own sink.

    Rows are dealt by year and a salt, so a batch makes ``files_per_year`` files a year
    and not one for each task.
    """
    _refuse_lost_checkpoints(raw, layout, {layout.archive: "archive"})
    rows = transactions(raw, ALL, mode, defaults)
    salt = F.pmod(F.xxhash64("record_id"), F.lit(tuning.files_per_year))
    rows = rows.repartition("tran_year", salt).select(*ALL)
    return start_format(rows, "json", "archive", layout.checkpoints,
                        trigger, partition_by=("tran_year",), path=layout.archive)


def start_hot(raw: DataFrame, layout: Layout, targets: Targets = Targets(), trigger: dict = EVERY_5_SECONDS,
              mode: str = "draw", defaults: bool = False, tuning: Tuning = Tuning()) -> StreamingQuery:
    """The keyed table: each micro-batch upserts the last row of each key; rows without
    a key are set aside."""
    _refuse_lost_checkpoints(raw, layout, {layout.hot: "hot", layout.null_keys: "hot"})
    sink = _hot_sink(layout, targets, sinks.epoch_files(layout.null_keys, rows_per_file=tuning.rows_per_file), tuning)
    return start(transactions(raw, HOT, mode, defaults), sink, "hot", layout.checkpoints, trigger)


def start_offsets(raw: DataFrame, layout: Layout, trigger: dict = EVERY_5_SECONDS) -> StreamingQuery:
    """The intervals of offsets of every micro-batch; ``stored.read_gaps`` tells what is
    missing. Reads no payload, so it is cheap beside any pipeline."""
    _refuse_lost_checkpoints(raw, layout, {layout.offsets: "offsets"})
    files = sinks.epoch_files(layout.offsets, files=1)
    rows = raw.select("topic", "partition", "offset")
    return start(rows, lambda batch, epoch: files(intervals(batch), epoch), "offsets", layout.checkpoints, trigger)


def start_quarantine(raw: DataFrame, layout: Layout, trigger: dict = EVERY_5_SECONDS,
                     tuning: Tuning = Tuning()) -> StreamingQuery:
    """The messages that yield no row or lost a mistyped field, with their payload."""
    _refuse_lost_checkpoints(raw, layout, {layout.quarantine: "quarantine"})
    return _start_refused(sinks.rejected_messages(audited_transactions(raw)), layout, trigger, tuning)


def _start_refused(messages: DataFrame, layout: Layout, trigger: dict, tuning: Tuning) -> StreamingQuery:
    files = sinks.epoch_files(layout.quarantine, rows_per_file=tuning.rows_per_file)

    def write(batch: DataFrame, epoch: int) -> None:
        with sinks.cached(batch) as rows:
            files(rows, epoch, rows.count())
    return start(messages, write, "quarantine", layout.checkpoints, trigger)


def main_pipeline(raw: DataFrame, layout: Layout, targets: Targets = Targets(),
                  trigger: dict = EVERY_5_SECONDS, mode: str = "draw", defaults: bool = False,
                  console: bool = False, tuning: Tuning = Tuning()) -> list[StreamingQuery]:
    """Archive, keyed table, quarantine and all five collections.

    Two queries, so the topic is read and parsed twice however many outputs there
    are: rows fan out inside one micro-batch, totals share one aggregate. The archive is
    gzipped, since its JSON repeats every field's name in every row.
    """
    _refuse_lost_checkpoints(raw, layout, {
        layout.archive: "rows", layout.hot: "rows", layout.quarantine: "rows", layout.collections: "totals",
        **{layout.collection(name): "totals" for name in COLLECTIONS}})
    rows = audited_transactions(raw, mode, defaults)
    totals = all_totals(transactions(raw, needed(), mode, defaults))
    row_sink = sinks.fan_out(
        archive=sinks.epoch_files(layout.archive, "json", ("tran_year",), tuning.archive_rows_per_file, compression="gzip"),
        hot=_hot_sink(layout, targets, None, tuning),
        quarantine=sinks.epoch_files(layout.quarantine, rows_per_file=tuning.rows_per_file, compression="zstd"),
        scratch=layout.batch)
    return [
        start(rows, row_sink, "rows", layout.checkpoints, trigger),
        start_totals(totals, _totals_sink(layout, targets, console, tuning), "totals", layout.checkpoints, trigger,
                     tuning.state_partitions),
    ]


def _totals_sink(layout: Layout, targets: Targets, console: bool, tuning: Tuning) -> Sink:
    stored = (sinks.snapshots({name: targets.collections(name) for name in COLLECTIONS}, pick)
              if targets.collections else sinks.together(layout.collections))
    if not console:
        return stored
    screen = sinks.console(tuning.console_rows)

    def both(batch: DataFrame, epoch: int) -> None:
        # Cached and filled: showing must not update the state a second time.
        with sinks.cached(batch) as totals:
            totals.count()
            stored(totals, epoch)
            screen(pick(totals, CONSOLE_COLLECTION), epoch)
    return both


def separate_pipeline(raw: DataFrame, layout: Layout, targets: Targets = Targets(),
                      trigger: dict = EVERY_5_SECONDS, mode: str = "draw", defaults: bool = False,
                      tuning: Tuning = Tuning()) -> list[StreamingQuery]:
    """The same outputs from one query each, every one with its own source read.

    Costs a parse per output; use it where outputs must fail or lag apart.
    """
    _refuse_lost_checkpoints(raw, layout, {
        layout.archive: "archive", layout.hot: "hot", layout.null_keys: "hot", layout.quarantine: "quarantine",
        **{layout.collection(name): name for name in COLLECTIONS}})
    return [
        start_archive(raw, layout, trigger, mode, defaults, tuning),
        start_hot(raw, layout, targets, trigger, mode, defaults, tuning),
        start_quarantine(raw, layout, trigger, tuning),
        *(start_collection(raw, layout, name, targets, trigger, mode, defaults, tuning) for name in COLLECTIONS),
    ]


def keyed_pipeline(raw: DataFrame, layout: Layout, targets: Targets = Targets(),
                   trigger: dict = EVERY_5_SECONDS, mode: str = "draw", console: bool | Sink = True,
                   defaults: bool = False, tuning: Tuning = Tuning()) -> list[StreamingQuery]:
    """The variant without aggregates: archive, keyed table, quarantine, and hot rows on
    the console (or another sink in its place)."""
    _refuse_lost_checkpoints(raw, layout, {
        layout.archive: "archive", layout.hot: "hot", layout.null_keys: "hot", layout.quarantine: "quarantine"})
    queries = [start_archive(raw, layout, trigger, mode, defaults, tuning),
               start_hot(raw, layout, targets, trigger, mode, defaults, tuning),
               start_quarantine(raw, layout, trigger, tuning)]
    if console:
        screen = console if callable(console) else sinks.console(tuning.console_rows)
        queries.append(start(hot_rows(transactions(raw, HOT, mode, defaults)), screen, "console",
                             layout.checkpoints, trigger))
    return queries


def publish_pipeline(raw: DataFrame, layout: Layout, fmt: str, trigger: dict = EVERY_5_SECONDS,
                     tuning: Tuning = Tuning(), **options: str) -> list[StreamingQuery]:
    """Messages completed with default transaction details, onto the next topic
    (``kafka`` with ``kafka_options``) or into files; those that cannot be completed
    into the quarantine, by a query of their own. Keys go along, but for ``text`` files,
    which have no place for them."""
    _refuse_lost_checkpoints(raw, layout, {
        layout.quarantine: "quarantine", **({options["path"]: "publish"} if "path" in options else {})})
    decoded = decode(raw)
    messages = completed_messages(decoded)
    return [start_format(messages.select("value") if fmt == "text" else messages, fmt, "publish", layout.checkpoints, trigger, **options),
            _start_refused(refused_messages(decoded), layout, trigger, tuning)]


def raw_pipeline(raw: DataFrame, layout: Layout, sink: Sink | None = None,
                 trigger: dict = EVERY_5_SECONDS, tuning: Tuning = Tuning()) -> list[StreamingQuery]:
    """The topic's own columns, undecoded, on the console."""
    return [start(raw, sink or sinks.console(tuning.console_rows), "raw", layout.checkpoints, trigger)]
