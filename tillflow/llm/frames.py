"""Spark helpers of the operators: written intermediate tables, running totals
that no hot group lands in one task of, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tillflow
from tillflow.session import shared_dir

BLOCKS = 1024
#: Bytes of rows that Spark hands to Python at once; its own 64 MB are held several times
#: over, by the JVM and by the worker.
ARROW_BYTES = 8 << 20


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: the plan ends here,
    the work is done once, and losing an executor loses none of it."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow_files(spark: SparkSession) -> int:
    """In how many files rows of a few numbers are saved: four a core, or an eighth of the
    shuffle partitions if those are more."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def saved_narrow(df: DataFrame, name: str, dealt: bool = False) -> DataFrame:
    """``saved`` for rows of a few numbers, which need not be a file for each shuffle
    partition: every file costs a rename, and on a local disk perhaps a process that sets its
    mode. ``dealt`` shuffles the rows to their files, for those that are made from far wider
    ones; else the tasks that make them are fewer."""
    files = narrow_files(df.sparkSession)
    return saved(df.repartition(files) if dealt else df.coalesce(files), name)


@contextmanager
def held(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings (two underscores for a dot) for the jobs started inside, and no
    shuffle files beyond the job that made them: else they stay until the driver collects
    garbage."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    wanted |= {name.replace("__", "."): value for name, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, as ``--py-files`` does, once an application,
    and the session small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")
    sc, root = spark.sparkContext, Path(tillflow.__file__).parent
    if getattr(sc, "_tillflow_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tillflow-code-")) / "tillflow.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._tillflow_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_md5(key: Column, text: Column) -> Column:
    """32 hex digits from a row's key and whole text: an order without meaning that
    spreads evenly even if one key or one text holds most of the rows."""
    return F.md5(F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("null")), F.coalesce(text, F.lit(""))))


def hex_block(digest: Column, blocks: int = BLOCKS) -> Column:
    """The leading digits of a hex digest as a block number; blocks keep its order."""
    return F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * blocks / F.lit(1 << 32)).cast("int")


def running_total(df: DataFrame, groups: Sequence[str], block: str, order: Sequence[Column], value: str,
                  out: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same group that come before.

    ``block`` cuts each group into a bounded number of parts that follow ``order``.
    Parts are summed first, their totals run up, and rows are ordered only inside
    their part, so a group of any size is spread over as many tasks as it has parts.
    A null in ``groups`` is a group of its own.
    """
    keys = [*groups, block]
    parts = df.groupBy(*keys).agg(F.sum(value).alias("__part"))
    earlier = Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*(F.col(k).alias(f"__{k}") for k in keys),
                         F.coalesce(F.sum("__part").over(earlier), F.lit(0)).alias("__base"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(parts, same)
    total = F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn(out, total.cast("long")).drop("__base", *(f"__{k}" for k in keys))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id that links reach, for each id of an edge.

    ``edges`` has long columns a and b. Alternates large-star and small-star steps:
    every node points its larger, then its smaller neighbours to the smallest one it
    knows, which ends in stars after a logarithmic number of rounds. Each round is
    two groupings and two joins, written to the shared folder; only two numbers a
    round come to the driver.
    """
    pairs = saved_narrow(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                         "components")
    before = None
    while True:
        ends = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if ends == before or ends[0] == 0:
            break
        before = ends
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # All neighbours are smaller now: they and the node itself go to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        pairs = saved_narrow(small.where("u <> v").distinct(), "components")
    heads = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)
