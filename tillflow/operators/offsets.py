"""Which offsets of a topic arrived, and which never did.

A source that may not fail on lost data goes on without a word. What a micro-batch got is
kept as intervals, a row for each unbroken one, and the holes between them are rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schema import TEXT, struct

#: Offsets are put in order by so many at a time: a partition is as many tasks as it has blocks.
BLOCK = 1_000_000
INTERVALS = struct(topic=TEXT, partition=T.IntegerType(), first=T.LongType(), last=T.LongType())
_PARTITION = ("topic", "partition")


def _merged(intervals: DataFrame, *within: str) -> DataFrame:
    """Intervals that touch or overlap as one."""
    order = Window.partitionBy(*_PARTITION, *within).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") <= before + 1, 0).otherwise(1)
    numbered = intervals.select("*", begins.alias("__new")).select("*", F.sum("__new").over(order).alias("__run"))
    return numbered.groupBy(*_PARTITION, *within, "__run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("__run")


def intervals(rows: DataFrame) -> DataFrame:
    """The unbroken intervals of offsets that rows of a topic have: ``topic``,
    ``partition``, ``first``, ``last``. An offset may come several times; rows without one
    have no place. A row for each hole and partition, however many messages there are."""
    block = F.expr(f"`offset` div {BLOCK}").alias("__block")
    one = rows.where(F.col("offset").isNotNull()).select(*_PARTITION, block, F.col("offset").alias("first"), F.col("offset").alias("last"))
    return _merged(_merged(one, "__block").drop("__block"))


def gaps(intervals: DataFrame) -> DataFrame:
    """The offsets that no interval holds, between the first and the last of each
    partition: ``topic``, ``partition``, ``first``, ``last`` and how many, ``offsets``.
    Intervals may overlap, as those of replayed or repeated deliveries do. A topic that is
    compacted, or has transactions, has gaps of its own."""
    whole = _merged(intervals)
    order = Window.partitionBy(*_PARTITION).orderBy("first")
    following = whole.select(*_PARTITION, (F.col("last") + 1).alias("first"), (F.lead("first").over(order) - 1).alias("last"))
    return following.where(F.col("last").isNotNull()).select("*", (F.col("last") - F.col("first") + 1).alias("offsets"))
