"""Exact dedup as a stream with keyed state.

A first stream reads every file once and writes a fingerprint of each row: the digest of
its normalised text, its size, its identifier and its place (file and row). A second one
keeps a state per digest, on disk and without expiry: the row that stays so far, with
identifier and place, and how many there were. Rows of a digest seen before are hits;
the full bytes of their texts are compared, and texts that only share a digest are told
apart. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames, streams
from tillflow.session import shared_dir
from tillflow.sources.epochs import read_epochs
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, drain, start, start_format

#: Characters that do not count in a comparison.
IGNORED = " \t\n\x0b\x0c\r"
#: The runtime filter that Spark may put on texts before it shuffles them: any size of
#: table may have one, made from up to this much of the hits. The filter itself is at most 8 MB.
_FILTER = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
           "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
           "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), IGNORED, "")


def _order() -> Column:
    """The row that stays is the least: most code points, smallest identifier, first place."""
    return F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("nameless"), "id", "file", "row")


def _fingerprints(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    body = F.col(text)
    return docs.select(
        F.col(key).alias("id"), digest(normalised(body)).alias("digest"),
        F.coalesce(F.length(body), F.lit(0)).alias("chars"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def deduplicated(spark: SparkSession, path: str, *, key: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256, batch_bytes: int | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``: ``doc_id`` (the key), ``keep_id``
    (key of the row that stays), ``group_size``, ``kept``, ``digest`` and the place (``file``,
    ``row``) of the row and of the one that stays (``keep_file``, ``keep_row``).

    Texts are equal if they are once blanks are deleted. Of equal ones that with the most
    code points stays, then that of the smallest key, a null key last, then the first in
    its file: of rows that repeat wholly one stays. Null text counts as empty, and all
    empty texts are equal. A text of any length is one row: only its digest travels, and
    the text itself only where its digest occurs twice. Other columns, whatever their
    names, are not read. An empty table gives an empty result.

    The streams' checkpoints and what they write lie in the shared folder. A micro-batch
    that is lost with its executor runs again from there. Equal rows of a task are one row
    before they are shuffled, so a text on any share of the rows sends one row per task.
    """
    own = streams.session(spark)
    for name, value in _FILTER.items():
        own.conf.set(name, value)
    root = shared_dir(own, "stream-dedup")
    prints = _fingerprints(streams.files(own, path, batch_bytes), key, text, digest)
    drain([start_format(prints, "parquet", "fingerprints", f"{root}/checkpoints", AVAILABLE_NOW, path=f"{root}/fingerprints")])

    written = streams.written(own, f"{root}/fingerprints", prints.schema, batch_bytes)
    state = written.groupBy("digest").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("size"))
    drain([start(state, sinks.epoch_files(f"{root}/groups"), "groups", f"{root}/checkpoints", AVAILABLE_NOW, "update")])

    prints = own.read.schema(prints.schema).parquet(f"{root}/fingerprints")
    # Every micro-batch that met a digest wrote its state anew; the largest is the last.
    groups = read_epochs(own, f"{root}/groups", T.StructType(state.schema.fields))
    groups = groups.groupBy("digest").agg(F.max(F.struct("size", "first")).alias("last")).select("digest", "last.*")
    groups = frames.saved(groups, "stream-dedup-groups")
    split = _told_apart(own, path, prints, groups, key, text, digest)
    if split is not None:
        return _rows(prints.join(split, ["file", "row"], "left_anti"), groups).union(
            _rows(prints, split.drop("digest"), ["file", "row"]))
    return _rows(prints, groups)


def _rows(prints: DataFrame, groups: DataFrame, on: list[str] | str = "digest") -> DataFrame:
    kept = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    return prints.join(groups, on).select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"),
        "digest", "file", "row", F.col("first.file").alias("keep_file"), F.col("first.row").alias("keep_row"))


def _told_apart(spark: SparkSession, path: str, prints: DataFrame, groups: DataFrame, key: str, text: str,
                digest: Callable[[Column], Column]) -> DataFrame | None:
    """Compares the full bytes of all texts whose digest occurs twice. (file, row, digest,
    first, size) of the rows whose digest is that of different texts; None without any.

    Equal texts fall together in the task that reads them. Digests go by a 64-bit mark
    here, so that the list of hits is short; a mark that fits by chance does no harm.
    """
    mark = lambda column: F.xxhash64(column).alias("mark")
    hits = groups.where("size > 1").select(mark("digest"))
    body = normalised(F.col(text))
    bodies = spark.read.parquet(path).select(body.alias("body"), mark(digest(body)), *(
        F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("row_index", "row"))))
    bodies = bodies.join(hits, "mark", "left_semi")
    several = bodies.select("mark", "body").distinct().groupBy("mark").agg(F.count(F.lit(1)).alias("texts"))
    several = frames.saved(several.where("texts > 1").select("mark"), "stream-dedup-collisions")
    if several.isEmpty():
        return None
    rows = bodies.join(several, "mark", "left_semi").join(prints, ["file", "row"])
    own = rows.groupBy("digest", "body").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("size"))
    return frames.saved(rows.select("file", "row", "digest", "body").join(own, ["digest", "body"]).select(
        "file", "row", "digest", "first", "size"), "stream-dedup-split")


def without_copies(spark: SparkSession, path: str, **options) -> DataFrame:
    """The table's rows, those that stay, with all their columns: read by their places."""
    kept = deduplicated(spark, path, **options).where("kept").select(F.col("file").alias("__file"), F.col("row").alias("__row"))
    docs = kept.sparkSession.read.parquet(path)
    places = docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return places.join(kept, ["__file", "__row"], "left_semi").drop("__file", "__row")
