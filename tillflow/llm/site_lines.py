"""Line dedup by site-relative frequency.

A line is boilerplate of a host if the share of the host's pages that contain it
exceeds a ratio; boilerplate lines are dropped from that host's pages and stay on all
others. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import frames

#: A line on more than this share of a host's pages is boilerplate …
RATIO = 0.05
#: … if that is at least this many pages: a host of two pages shows nothing.
LEAST_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """A line's hash, white space at its ends set aside; null for a blank line."""
    bare = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO,
                least: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): hashes of each host's boilerplate lines; null host is a host.

    A page counts a line once. Counts are combined before the shuffle, so a line on
    most pages of a huge host sends one row per task. A host's boilerplate has at most
    as many lines as its mean page divided by the ratio.
    """
    rows = pages.select(F.col(host).alias("host"), F.col(text).alias("text"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(_lines(F.col("text")), _key))
    lines = rows.select("host", F.explode(keys).alias("line")).where(F.col("line").isNotNull())
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    totals = totals.withColumnRenamed("host", "__host")
    found = counts.join(totals, F.col("host").eqNullSafe(F.col("__host"))).where(F.col("n") > F.col("pages") * ratio)
    return found.groupBy("host").agg(F.collect_set("line").alias("lines"))


def without_boilerplate(pages: DataFrame, *, host: str = "source", text: str = "text", ratio: float = RATIO,
                        least: int = LEAST_PAGES) -> DataFrame:
    """All rows and columns; ``text`` loses its host's boilerplate lines, and
    ``n_lines`` and ``n_dropped`` say how many lines it had and lost.

    Lines are parted by \\n; blank ones are never dropped. A text without boilerplate
    is left as it is, one of boilerplate only becomes empty, null stays null with 0
    lines. Columns named ``n_lines`` or ``n_dropped`` are replaced. An empty table
    stays empty.

    The hosts' lists are written first, so that their size is known when the join is
    planned: Spark broadcasts them below its own threshold and otherwise shuffles,
    splitting a skewed host.
    """
    lists = frames.saved(boilerplate(pages, host, text, ratio, least), "boilerplate")
    lists = lists.select(F.col("host").alias("__host"), F.col("lines").alias("__drop"))
    rows = pages.join(lists, F.col(host).eqNullSafe(F.col("__host")), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__drop"), _key(x)), F.lit(False)))
    rows = rows.withColumn("__kept", F.when(F.col("__drop").isNotNull(), kept))
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    rows = rows.withColumns({
        "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(n).cast("long"),
        "n_dropped": F.when(F.col("__kept").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("__kept")).cast("long")})
    cleaned = F.when(F.col("n_dropped") > 0, F.array_join("__kept", "\n")).otherwise(F.col(text))
    return rows.withColumn(text, cleaned).drop("__host", "__drop", "__kept")
