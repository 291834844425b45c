"""What filters take from each other, audited over a stream.

Every row fails some of the filters; which ones is a mask. Four filters look at the text
alone, the fifth at all texts: a row fails it if its text is that of a smaller key, seen
or still to come. The files are processed in micro-batches. A state per text holds the
smallest key so far; a row with a smaller one takes its place, and the mask counted for
the earlier holder is retracted from the counters of its part and counted anew. The
counters of parts and masks are all that the orders of the filters need.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillflow.llm import frames, streams
from tillflow.llm import text as tx
from tillflow.session import shared_dir
from tillflow.sources.epochs import read_epochs
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, drain, start, start_format

#: The filters in the order of their bits; the last one is that of repeated texts.
FILTERS = "ABCDE"
REPEATED = 1 << 4
GOOD, TOXIC = 1 << 5, 1 << 6
#: A: fewer words; B: a smaller share of distinct words, in percent; C: a larger share of
#: capitals A to Z among the code points, in percent; D: any of these characters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
#: Texts of one entry of the state, on average: a call of Python for each costs more
#: than what it does.
TEXTS_AN_ENTRY = 64

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def masks(texts: tx.Texts) -> np.ndarray:
    """The bits of the filters that look at the text alone."""
    words, data = texts.words, texts.data
    n = words.per_doc
    # A word and its text in one number, the text in the low bits.
    low = np.uint64(len(texts).bit_length())
    doc = words.doc.astype(np.uint64)
    pairs, _ = tx.distinct(tx.mix(words.hash + doc * tx.STEP) >> low << low | doc)
    distinct = np.bincount((pairs & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64), minlength=len(texts))
    per_text = lambda which: np.diff(np.searchsorted(np.flatnonzero(which), texts.offsets))
    points = texts.sizes - per_text(data & 0xC0 == 0x80)
    capitals = per_text((data >= 65) & (data <= 90))
    fails = (n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * points,
             per_text(_SYMBOL[data]) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


_MEASURED = "id long, part string, mask int, digest binary"


def _measured(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("text"))

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for a, b, texts in tx.batches(table.column(3)):
                own = table.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(masks(texts)), own.column(2)],
                                                 names=["id", "part", "mask", "digest"])

    return rows.mapInArrow(run, _MEASURED)


_COMBINED = "digest binary, id long, part string, flags int, n long"


def _combined(rows: DataFrame) -> DataFrame:
    """Equal texts of a batch as few rows: those of the smallest key, and counts without a
    key of all others, which are sure to repeat it. A text on any share of the rows sends
    no more than that from each batch."""
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            batch = table.to_pandas()
            least = batch.groupby("digest")["id"].transform("min")
            batch["id"] = batch["id"].astype("Int64").where(batch["id"] == least)
            few = batch.groupby(["digest", "id", "part", "flags"], dropna=False).size().reset_index(name="n")
            yield pa.RecordBatch.from_pandas(few, schema=pa.schema([
                ("digest", pa.binary()), ("id", pa.int64()), ("part", pa.string()), ("flags", pa.int32()), ("n", pa.int64())]),
                preserve_index=False)

    return rows.select("digest", "id", "part", "flags").mapInArrow(run, _COMBINED)


#: An entry: the rows of the smallest key of each of its texts.
_STATE = "digest array<binary>, id array<long>, part array<string>, flags array<int>, n array<long>"


def _fold(_: tuple, frames_of: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """New rows of an entry's texts into its state; what they change in the counters."""
    held: dict[bytes, tuple[int, Counter]] = {}
    if state.exists:
        for digest, key, part, flags, n in zip(*state.get):
            held.setdefault(bytes(digest), (key, Counter()))[1][part, flags] += n
    changed: Counter = Counter()
    for frame in frames_of:
        ids = [None if pd.isna(i) else int(i) for i in frame["id"]]
        for digest, key, part, flags, n in zip(frame["digest"], ids, frame["part"], frame["flags"].tolist(), frame["n"].tolist()):
            first = held.get(digest)
            if key is None or first is not None and key > first[0]:
                changed[part, flags | REPEATED] += n
                continue
            changed[part, flags] += n
            if first is not None and key == first[0]:
                first[1][part, flags] += n
                continue
            for (p, f), m in first[1].items() if first else ():
                changed[p, f] -= m
                changed[p, f | REPEATED] += m
            held[digest] = key, Counter({(part, flags): n})
    rows = [(digest, key, p, f, n) for digest, (key, counts) in held.items() for (p, f), n in counts.items()]
    state.update(tuple(map(list, zip(*rows))) if rows else ([], [], [], [], []))
    yield pd.DataFrame([(p, f, n) for (p, f), n in changed.items() if n], columns=["part", "flags", "delta"])


def _flags(labels: DataFrame | None, key: str) -> DataFrame | None:
    if labels is None:
        return None
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic"))
    return marks.select("id", F.col("good").bitwiseOR(F.col("toxic")).alias("marks"))


def counted(spark: SparkSession, path: str, labels: DataFrame | None = None, *, key: str = "doc_id", text: str = "text",
            part: str = "lang", batch_bytes: int | None = None) -> DataFrame:
    """``part``, ``mask`` (bits of the filters failed), ``good``, ``toxic`` and ``n``, the
    rows of the Parquet table at ``path`` with these.

    ``labels`` has the key, ``quality`` and ``toxic``: a row is good or toxic if any label
    of its key says 1. Null text counts as empty, a null part as an empty one. Rows that
    share their key and text are none the smaller one; a null key is smaller than none
    and none is smaller than it. Texts of any length are whole: they are measured where
    they are read, and only masks and digests travel. Other columns, whatever their names,
    are not read. An empty table has no parts.

    A first stream measures the files, a join adds the labels, a second stream counts. Its
    state lies on disk under the shared checkpoint, and each micro-batch's changes are
    logged once, so one that is lost with its executor runs again.
    """
    frames.ship(spark)
    own = streams.session(spark)
    root = shared_dir(own, "filter-audit")
    rows = _measured(streams.files(own, path, batch_bytes), key, text, part)
    drain([start_format(rows, "parquet", "measured", f"{root}/checkpoints", AVAILABLE_NOW, path=f"{root}/measured")])
    rows = own.read.schema(rows.schema).parquet(f"{root}/measured")

    marks = _flags(labels, key)
    named = rows.where(F.col("id").isNotNull())
    flags = F.col("mask")
    if marks is not None:
        own_marks = own.read.schema(marks.schema).parquet(_written(marks, f"{root}/labels"))
        named = named.join(own_marks, "id", "left")
        flags = flags.bitwiseOR(F.coalesce("marks", F.lit(0)))
    named = named.select("digest", "id", "part", flags.alias("flags"))
    named.write.option("compression", "zstd").parquet(f"{root}/labelled")

    entries = max(named.sparkSession.read.parquet(f"{root}/labelled").count() // TEXTS_AN_ENTRY, 1)
    fresh = streams.written(own, f"{root}/labelled", named.schema, batch_bytes)
    entry = F.pmod(F.xxhash64("digest"), F.lit(entries)).alias("entry")
    changes = _combined(fresh).select(entry, "*").groupBy("entry").applyInPandasWithState(
        _fold, "part string, flags int, delta long", _STATE, "update", GroupStateTimeout.NoTimeout)
    counters = T.StructType.fromDDL("part string, flags int, n long")
    files = sinks.epoch_files(f"{root}/counters", files=1)

    def add(batch: DataFrame, epoch: int) -> None:
        files(batch.groupBy("part", "flags").agg(F.sum("delta").alias("n")), epoch)

    drain([start(changes, add, "counters", f"{root}/checkpoints", AVAILABLE_NOW, "update")])
    nameless = rows.where(F.col("id").isNull()).select("part", F.col("mask").alias("flags"), F.lit(1).cast("long").alias("n"))
    total = read_epochs(own, f"{root}/counters", counters).select(*counters.names).union(nameless)
    total = total.groupBy("part", "flags").agg(F.sum("n").alias("n")).where("n <> 0")
    return total.select("part", F.col("flags").bitwiseAND(GOOD - 1).alias("mask"), _has(F.col("flags"), GOOD).alias("good"),
                        _has(F.col("flags"), TOXIC).alias("toxic"), "n")


def _written(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


def _has(mask: Column, bits: Column | int) -> Column:
    return mask.bitwiseAND(bits) != 0


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step, from ``counted`` rows: what the step
    ``kept`` and ``removed``, its filter's ``redundant`` failures (removed earlier) and
    ``unique_fails`` (no other filter fails), the ``good_lost`` and ``toxic_lost`` rows, and
    ``shapley``, what the filter removes summed over all orders."""
    orders = ["".join(p) for p in permutations(filters)]
    bit = {name: 1 << i for i, name in enumerate(filters)}
    step, order, mask = F.col("step"), F.col("filter_order"), F.col("mask")
    place = {name: F.instr(order, name) for name in filters}
    here = sum((F.when(place[f] == step, b).otherwise(0) for f, b in bit.items()), F.lit(0))
    earlier = sum((F.when(place[f] < step, b).otherwise(0) for f, b in bit.items()), F.lit(0))
    rows = (counts.select("*", F.explode(F.lit(orders)).alias("filter_order"))
            .select("*", F.explode(F.lit(list(range(1, len(filters) + 1)))).alias("step"))
            .select("*", here.alias("here"), earlier.alias("earlier")))
    fails, before = _has(mask, F.col("here")), _has(mask, F.col("earlier"))
    kept = ~_has(mask, F.col("here").bitwiseOR(F.col("earlier")))
    lost = fails & ~before
    # Of the filters that a row fails, each comes first in as many orders as the others.
    total = lambda which, each=F.lit(1): F.sum(F.when(which, F.col("n") * each).otherwise(0))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(kept).alias("kept"), total(lost).alias("removed"), total(fails & before).alias("redundant"),
        total(mask == F.col("here")).alias("unique_fails"), total(lost & F.col("good")).alias("good_lost"),
        total(lost & F.col("toxic")).alias("toxic_lost"),
        total(fails, F.expr(f"{len(orders)} div greatest(bit_count(mask), 1)")).alias("shapley"))
