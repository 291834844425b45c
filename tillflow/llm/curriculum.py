"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1. The integral of the
schedule is the source's target; its running integral is how many words of the
source training has asked for up to a moment. Documents of a source stand in a hashed
order, passes one after the other, and the moment at which the running demand
reaches a document's first word is its training position. Sorting all sources by
position gives the mixed order.

DataFrame functions only. The sources are a small table; it is windowed, never
collected, and documents of a source are summed in blocks, so a source of any size
is spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import frames

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Schedule:
    """A mean weight and its course over time: (time, relative weight) knots,
    joined by straight lines; the course is scaled to a mean of 1."""

    weight: float
    course: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def segments(self) -> list[tuple[float, float, float, float]]:
        """(time, integral up to it, value, slope) of each straight piece."""
        knots = self.course
        if knots[0][0] != 0 or knots[-1][0] != 1 or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])):
            raise ValueError("knots run from time 0 to time 1")
        if any(w < 0 for _, w in knots):
            raise ValueError("weights are not negative")
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        out, done = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            a, b = w0 / area, w1 / area
            if a + b > 0:
                out.append((t0, done, a, (b - a) / (t1 - t0)))
            done += (t1 - t0) * (a + b) / 2
        return out


# Heavy sources fade in, light ones fade out, the middle ones stay level.
SCHEDULES = (
    Schedule(5, ((0.0, 0.5), (1.0, 1.5))),
    Schedule(2),
    Schedule(1, ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5))),
)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """(source, source_size, class, target) from (source, source_size).

    Sources in code-point order, null last, take the schedules in turn. They share
    ``share`` times all words by weight; a target stops at ``cap`` times its source,
    and what is over goes to the others by weight until none is above. That is the
    level L with sum(min(weight * L, cap * size)) = share * total: sources are taken in
    order of cap * size / weight, and the first one whose own ratio reaches the level
    left for it and the rest fixes the level.
    """
    if share > cap:
        raise ValueError("the caps hold less than the share")
    rank = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*(F.lit(float(s.weight)) for s in schedules))
    klass = ((F.row_number().over(rank) - 1) % len(schedules)).cast("int")
    out = sizes.withColumn("class", klass).withColumn("__w", F.element_at(weights, F.col("class") + 1))
    out = out.withColumn("__cap", F.col("source_size") * cap).withColumn("__ratio", F.col("__cap") / F.col("__w"))
    by_ratio = Window.orderBy("__ratio", F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    left = (F.sum("source_size").over(whole) * share
            - F.coalesce(F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    weight_left = F.sum("__w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = out.withColumn("__level", left / weight_left)
    level = F.max(F.when(F.col("__ratio") >= F.col("__level"), F.col("__level"))).over(whole)
    target = F.coalesce(F.least(F.col("__cap"), F.col("__w") * level), F.col("__cap"))
    return out.select("source", "source_size", "class", target.alias("target"))


def _moment(part: Column, klass: Column, schedules: Sequence[Schedule]) -> Column:
    """The time at which a schedule of this class has asked for ``part`` of its words."""
    pieces = F.array(*(F.array(*(F.struct(*(F.lit(float(v)).alias(n) for n, v in zip(("t", "done", "a", "slope"), p)))
                                 for p in s.segments())) for s in schedules))
    piece = F.element_at(F.filter(F.element_at(pieces, klass + 1), lambda p: p["done"] <= part), -1)
    more = part - piece["done"]
    root = F.sqrt(F.greatest(piece["a"] * piece["a"] + 2 * piece["slope"] * more, F.lit(0.0)))
    return F.when(more <= 0, piece["t"]).otherwise(
        F.least(piece["t"] + 2 * more / (piece["a"] + root), F.lit(1.0)))


def assign(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
           keep: Sequence[str] = (), schedules: Sequence[Schedule] = SCHEDULES, share: float = 1.5,
           cap: float = 2.0) -> DataFrame:
    """One row per document: ``doc_id`` (the key), ``source``, ``size`` (words),
    ``source_size``, ``target``, ``taken`` (words the mix takes, repeats counted) and
    ``passes``, an array of (pass, words, position), besides the ``keep`` columns.

    A source gives whole documents in hashed order until its target, rounded down, is
    met; the document on the border gives its first words only. A target over the
    source's size starts a second pass, at most ``cap`` of them. Position is the
    training time, 0 to 1, of the pass's first word.

    Null source: a source of its own. Null or empty text: no words, nothing taken.
    Equal rows are told apart only by an arbitrary but fixed order. An empty table
    gives an empty result.
    """
    if cap != int(cap):
        raise ValueError("cap counts whole passes")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"),
                       frames.text_md5(F.col(key), F.col(text)).alias("__digest"),
                       *(F.col(c).alias(f"__keep_{c}") for c in keep))
    sizes = docs.select(F.col(source).alias("source"), words(F.col(text)).alias("size"))
    plan = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), schedules, share, cap)
    plan = plan.select(F.col("source").alias("__source"), "source_size", "class", "target")
    rows = rows.withColumn("__block", frames.hex_block(F.col("__digest")))
    rows = frames.running_total(rows, ["source"], "__block", [F.col("__digest"), F.col("doc_id"), F.col("size")],
                                "size", "__start")
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    begin = lambda p: F.col("__start") + p * F.col("source_size")
    taken = lambda p: F.greatest(F.least(
        F.floor("target").cast("long") - begin(p), F.col("size")), F.lit(0).cast("long"))
    passes = F.transform(F.sequence(F.lit(0), F.lit(int(cap) - 1)), lambda p: F.struct(
        p.alias("pass"), taken(p).alias("words"),
        _moment(F.coalesce(F.try_divide(begin(p).cast("double"), F.col("target")), F.lit(0.0)), F.col("class"),
                schedules).alias("position")))
    out = rows.withColumn("passes", F.filter(passes, lambda p: p["words"] > 0))
    total = F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"])
    return out.select("doc_id", "source", "size", "source_size", "target", total.alias("taken"), "passes",
                      *(F.col(f"__keep_{c}").alias(c) for c in keep))


def in_order(assigned: DataFrame) -> DataFrame:
    """One row per pass of a document, range-sorted by training position."""
    rows = assigned.select("*", F.explode("passes").alias("__p")).drop("passes")
    rows = rows.select("*", F.col("__p.pass").alias("pass"), F.col("__p.words").alias("pass_words"),
                       F.col("__p.position").alias("position")).drop("__p")
    return rows.orderBy("position", "doc_id", "pass")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents as training meets them: their own columns, one row per pass, in
    order of position; a pass on the border keeps its first words only."""
    columns = docs.columns
    packed = docs.withColumn("__row", F.struct(*(F.col(f"`{c}`") for c in columns)))
    rows = in_order(assign(packed, keep=("__row",), **options))
    name = options.get("text", "text")
    # Pieces of a word and the white space after it, so that joining them keeps both.
    head = F.split(F.col(f"__row.{name}"), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.col(f"__row.{name}").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    cut = F.array_join(F.slice(head, F.lit(1), (F.col("pass_words") + lead).cast("int")), "")
    text = F.when(F.col("pass_words") < F.col("size"), cut).otherwise(F.col(f"__row.{name}"))
    return rows.select(*(text.alias(c) if c == name else F.col(f"__row.`{c}`").alias(c) for c in columns))
