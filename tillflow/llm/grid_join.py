"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors of cosine c or more are at most e = sqrt(2 - 2c) apart. Vectors are turned
to their principal axes and sorted by the cells, e wide, of a grid over the leading
ones; the sorted sequence is cut into blocks, and blocks into ever longer intervals.
Starting from the whole sequence, pairs of intervals are split into pairs of their parts
and dropped as soon as their bounding boxes lie more than e apart. What is left are
pairs of blocks, whose cosines are computed exactly: a few intervals at a time go to all
tasks, and meet the others where those are read. So what is shuffled and kept on disk grows
with the vectors, not with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames
from tillflow.session import shared_dir

COSINE = 0.9
#: Vectors of a block; parts of an interval; leading axes of the grid; axes of the boxes.
BLOCK, PARTS, GRID_AXES, BOX_AXES = 256, 8, 6, 16
#: Bytes of the intervals that go to all tasks at once; rows of links that a task puts
#: together before it hands them on.
ROUND_BYTES, MERGED = 8 << 20, 1 << 19
#: Distances are compared with this much to spare, so that rounding skips no pair.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Has components, all of them finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Unit rows in double precision; shorter vectors are filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def _axes(nodes: DataFrame, width: int) -> np.ndarray:
    """Principal axes, the leading one first, from the second moments of all vectors:
    width x width sums, added up by Spark."""
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for table in tables:
            for first in range(0, table.num_rows, 4096):
                part = _matrix(table.column(0).slice(first, 4096), width)
                total += part.T @ part
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])

    sums = nodes.select("vector").mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(
        F.sum("s").alias("s")).toArrow()
    moment = np.zeros((width, width))
    i, j, s = (c.to_numpy() for c in sums.columns)
    moment[i, j] = moment[j, i] = s
    return np.linalg.eigh(moment)[1][:, ::-1].copy()


def _blocks(nodes: DataFrame, axes: np.ndarray, reach: float) -> DataFrame:
    """The sorted sequence as blocks: (part, seq, node[], copies[], size[], data, lo…, hi…)."""
    width, n_box = len(axes), min(BOX_AXES, len(axes))
    n_grid = min(GRID_AXES, width)
    cells = [f"c{i}" for i in range(n_grid)]
    placed = T.StructType([*nodes.schema.fields, *(T.StructField(c, T.IntegerType()) for c in cells),
                           T.StructField("first", T.DoubleType())])

    def place(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for at in range(0, table.num_rows, 4096):
                part = table.slice(at, 4096)
                turned = _matrix(part.column(2), width) @ axes[:, :n_grid]
                grid = np.floor(turned / reach).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(grid[:, i]) for i in range(n_grid)), pa.array(turned[:, 0])],
                    names=placed.names)

    boxes = [f"{side}{i}" for side in ("lo", "hi") for i in range(n_box)]
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
        T.StructField("node", T.ArrayType(T.LongType())), T.StructField("copies", T.ArrayType(T.LongType())),
        T.StructField("size", T.ArrayType(T.IntegerType())), T.StructField("data", T.BinaryType()),
        *(T.StructField(b, T.DoubleType()) for b in boxes)])

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def block(rows: pa.Table) -> pa.RecordBatch:
            vectors = rows.column("vector").combine_chunks()
            data = _matrix(vectors, width)
            turned = data @ axes[:, :n_box]
            box = [*turned.min(axis=0), *turned.max(axis=0)]
            sizes = np.diff(vectors.offsets.to_numpy()).astype(np.int32)
            values = [part, seq, rows.column("node").to_numpy(), rows.column("copies").to_numpy(), sizes,
                      data.tobytes(), *box]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(),
                     *[pa.float64()] * len(box)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=schema.names)

        for table in tables:
            held.append(pa.Table.from_batches([table]))
            while sum(map(len, held)) >= BLOCK:
                rows = pa.concat_tables(held)
                yield block(rows.slice(0, BLOCK))
                held, seq = [rows.slice(BLOCK)], seq + 1
        if sum(map(len, held)):
            yield block(pa.concat_tables(held))

    order = [*cells, "first", "node"]
    rows = nodes.mapInArrow(place, placed).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = frames.saved(rows.mapInArrow(cut, schema), "grid-blocks")
    # Numbers without gaps: a row per task, not per block, goes through the window.
    tasks = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(tasks), "part").withColumn("block", F.col("base") + F.col("seq")).drop("base")


def _near_blocks(boxes: DataFrame, n_blocks: int, n_box: int, reach: float) -> DataFrame:
    """(a, b), a <= b, of blocks whose boxes are near: from the whole sequence down."""
    sides = [f"{side}{i}" for side in ("lo", "hi") for i in range(n_box)]
    levels = 0
    while PARTS ** levels < n_blocks:
        levels += 1
    widest = [F.min(c).alias(c) if c.startswith("lo") else F.max(c).alias(c) for c in sides]
    spark, pairs = boxes.sparkSession, None
    for level in range(levels, -1, -1):
        size = PARTS ** level
        part = F.floor(F.col("block") / size).cast("long")
        here = boxes.groupBy(part.alias("id")).agg(*widest)
        here = here.withColumn("up", F.floor(F.col("id") / PARTS).cast("long"))
        left = here.select(F.col("id").alias("a"), F.col("up").alias("up_a"), *(F.col(c).alias(f"a_{c}") for c in sides))
        right = here.select(F.col("id").alias("b"), F.col("up").alias("up_b"), *(F.col(c).alias(f"b_{c}") for c in sides))
        if pairs is None:
            pairs = spark.range(1).select(F.col("id").alias("up_a"), F.col("id").alias("up_b"))
        gap = sum((F.greatest(F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.lit(0.0))
                   ** 2 for i in range(n_box)), F.lit(0.0))
        near = pairs.join(left, "up_a").join(right, "up_b").where(
            (F.col("a") <= F.col("b")) & (gap <= reach * reach + SLACK)).select("a", "b")
        near = frames.saved(near, "grid-pairs")
        pairs = near.withColumnsRenamed({"a": "up_a", "b": "up_b"})
    return near


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which unit rows of a and b have that cosine; near the limit the product is
    summed anew, term by term."""
    product = a @ b.T
    found = product >= cosine
    for i, j in zip(*np.nonzero(np.abs(product - cosine) < SLACK)):
        found[i, j] = math.fsum(a[i] * b[j]) >= cosine
    return found


def spanning(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) of the links between two blocks: one
    for each linked vector, however many links it has."""
    top = np.iinfo(np.int64).max
    low, high = np.where(found.any(axis=1), left, top), np.where(found.any(axis=0), right, top)
    while True:
        down = np.minimum(high, np.where(found, low[:, None], top).min(axis=0, initial=top))
        up = np.minimum(low, np.where(found, down[None, :], top).min(axis=1, initial=top))
        if (down == high).all() and (up == low).all():
            break
        low, high = up, down
    node, head = np.concatenate([left, right]), np.concatenate([low, high])
    return node[head < top], head[head < top]


def forest(ends: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components from one edge for each node: (node, smallest node)."""
    nodes, at = np.unique(np.concatenate([ends, heads]), return_inverse=True)
    a, b = at[:len(ends)], at[len(ends):]
    low = np.arange(len(nodes))
    while True:
        least, next_low = np.minimum(low[a], low[b]), low.copy()
        for side in (a, b, low[a], low[b]):
            np.minimum.at(next_low, side, least)
        next_low = next_low[next_low]
        if (next_low == low).all():
            return nodes, nodes[low]
        low = next_low


def summed(nodes: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node once, with all its links."""
    found, at = np.unique(nodes, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, links)
    return found, total


def _compared(pairs: DataFrame, blocks: DataFrame, n_blocks: int, width: int, cosine: float) -> DataFrame:
    """(node, other, links): with other null, links of a node in some pairs of blocks;
    else an edge. Blocks travel as intervals. In each round some of them, ``ROUND_BYTES``,
    are broadcast and compared with all that they are near to, as those are read: a shuffle
    would have to hold every interval as often as it meets another."""
    spark, parts = blocks.sparkSession, PARTS
    up = lambda c: F.floor(F.col(c) / parts).cast("long")
    n_intervals = -(-n_blocks // parts)
    a_round = max(1, ROUND_BYTES // (parts * BLOCK * (8 * width + 20)))
    pack = F.struct("block", "node", "copies", "size", "data")
    where = shared_dir(spark, "grid-intervals")
    dealt = blocks.withColumn("id", up("block")).repartition(min(n_intervals, frames.narrow_files(spark)), "id")
    dealt = dealt.groupBy("id").agg(F.collect_list(pack).alias("blocks")).withColumn("round", F.floor(F.col("id") / a_round).cast("int"))
    dealt.write.partitionBy("round").parquet(where)
    intervals = spark.read.schema(dealt.schema).parquet(where)
    place = ((F.col("a") % parts) * parts + F.col("b") % parts).cast("int")
    wanted = frames.saved(pairs.groupBy(up("a").alias("i"), up("b").alias("j")).agg(F.collect_list(place).alias("todo")), "grid-todo")
    schema = "node long, other long, links long"

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        trees: list[tuple[np.ndarray, np.ndarray]] = []

        def together() -> int:
            counts[:] = [summed(*(np.concatenate(x) for x in zip(*counts)))]
            trees[:] = [forest(*(np.concatenate(x) for x in zip(*trees)))]
            return len(counts[0][0]) + len(trees[0][0])

        def rows() -> pa.RecordBatch:
            (node, n), (ends, heads) = counts[0], trees[0]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node, ends])),
                 pa.array(np.concatenate([node, heads]), mask=np.arange(len(node) + len(ends)) < len(node)),
                 pa.array(np.concatenate([n, np.zeros(len(ends), np.int64)]))], names=["node", "other", "links"])

        waiting = 0
        for table in tables:
            for r in range(table.num_rows):
                first_a, first_b = (table.column(c)[r].as_py() * parts for c in range(2))
                todo, *sides = (table.column(c)[r] for c in range(2, 5))
                held = {}
                for side in sides:
                    for b in side:
                        data = np.frombuffer(b["data"].as_buffer(), np.float64).reshape(-1, width)
                        held[b["block"].as_py()] = (data, *(b[k].values.to_numpy() for k in ("node", "copies", "size")))
                links: dict[int, np.ndarray] = {k: np.zeros(len(v[0]), np.int64) for k, v in held.items()}
                edges = []
                for pair in todo.as_py():
                    a, b = first_a + pair // parts, first_b + pair % parts
                    (u, nodes_u, copies_u, size_u), (v, nodes_v, copies_v, size_v) = held[a], held[b]
                    found = linked(u, v, cosine) & (size_u[:, None] == size_v[None, :])
                    if a == b:
                        np.fill_diagonal(found, False)
                    if found.any():
                        links[a] += found @ copies_v
                        if a != b:
                            links[b] += found.T @ copies_u
                        edges.append(spanning(found, nodes_u, nodes_v))
                if edges:
                    found = [(held[k][1][n > 0], n[n > 0]) for k, n in links.items() if n.any()]
                    counts += found
                    trees.append(forest(*(np.concatenate(x) for x in zip(*edges))))
                    waiting += sum(len(n) for n, _ in found) + len(trees[-1][0])
                if waiting > MERGED:
                    waiting = together()
                    if waiting > MERGED // 2:
                        yield rows()
                        counts.clear(), trees.clear()
                        waiting = 0
        if waiting:
            together()
            yield rows()

    out = shared_dir(spark, "vector-links")
    for k in range(-(-n_intervals // a_round)):
        near = wanted.where(F.col("i").between(k * a_round, (k + 1) * a_round - 1))
        x = intervals.where(F.col("round") == k).select(F.col("id").alias("i"), F.col("blocks").alias("x"))
        y = intervals.where(F.col("round") >= k).select(F.col("id").alias("j"), F.col("blocks").alias("y"))
        met = y.join(F.broadcast(near), "j").join(F.broadcast(x), "i").select("i", "j", "todo", "x", "y")
        met.mapInArrow(run, schema).write.mode("append").option("compression", "zstd").parquet(out)
    return spark.read.schema(schema).parquet(out)


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id`` (the key), ``n_links`` (other rows of at least that
    cosine), ``component_id`` (smallest key that links reach, its own included), ``kept``
    (whether that is its own).

    A vector that is null, empty, zero, or has a null or non-finite component links
    with nothing and is its own component; so do vectors of different length. Equal
    vectors are one while they are compared and count as links of each other. Links are
    counted where blocks are compared and only a spanning edge for each linked vector
    leaves, so a clique of any size costs as many rows as it has vectors. A null key is
    the smallest only where no other is. An empty table gives an empty result.
    """
    if not 0 < cosine < 1:
        raise ValueError("the cosine lies between 0 and 1")
    reach = math.sqrt(2 - 2 * cosine)
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector"))
    rows = rows.withColumn("node", F.when(usable(F.col("vector")), F.xxhash64("vector")))
    nodes = rows.where("node is not null").groupBy("node", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    nodes = frames.saved(nodes, "distinct-vectors")
    widths = nodes.agg(F.max(F.size("vector"))).first()[0]
    if widths is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    spark = vectors.sparkSession
    # Intervals are few and each a lot of work, so they are read by more tasks than their bytes ask for.
    with frames.held(spark, spark__sql__files__minPartitionNum=str(4 * spark.sparkContext.defaultParallelism)):
        axes = _axes(nodes, widths)
        blocks = _blocks(nodes.select("node", "copies", "vector"), axes, reach)
        n_box = min(BOX_AXES, widths)
        boxes = frames.saved(blocks.drop("node", "copies", "size", "data"), "numbered-boxes")
        n_blocks = boxes.count()
        pairs = _near_blocks(boxes, n_blocks, n_box, reach)
        compared = _compared(pairs, blocks, n_blocks, widths, cosine)
        links = compared.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
        parts = frames.components(compared.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))

    known = nodes.select("node", "copies", "first_id").join(links, "node", "left").join(parts, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    heads = known.groupBy("component").agg(F.min("first_id").alias("head"))
    known = known.join(heads, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "head")
    out = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("head"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
