"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard. At each level every child of the chosen node
draws ``-ln(u) / weight``, u a uniform hash of key and node, and the smallest draw
wins. A child's chance is its share of the weight, and a draw depends on nothing
else, so raising one node's weight only moves keys into that node's subtree and
lowering it only out of it; the descent inside untouched subtrees stays as it was.

DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import frames


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. An inner node weighs what its children weigh."""

    name: str
    children: tuple[Node, ...] = ()
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return math.fsum(c.weight for c in self.children) if self.children else float(self.own_weight)


def tree(regions: Sequence[Sequence[Sequence[float]]]) -> Node:
    """A tree from nested shard weights: regions of racks of shards.

    Nodes are named by their place (0, 0.1, 0.1.2), so a node keeps its draws as
    long as it keeps its place. Shards are numbered in this order.
    """
    return Node("", tuple(
        Node(f"{i}", tuple(
            Node(f"{i}.{j}", tuple(Node(f"{i}.{j}.{k}", (), w) for k, w in enumerate(rack)))
            for j, rack in enumerate(racks)))
        for i, racks in enumerate(regions)))


def grown(regions: Sequence[Sequence[Sequence[float]]], weight: float = 1.0) -> list:
    """One more shard. It gets a region of its own: the new region is the only
    subtree whose weight changes, so rows move into the new shard only."""
    return [*regions, [[weight]]]


def _draw(key: Column, name: Column, weight: Column) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit("@"), name)), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def _winner(key: Column, children: Column) -> Column:
    """Name and number of the child with the smallest draw."""
    drawn = F.transform(children, lambda c: F.struct(
        _draw(key, c["name"], c["weight"]).alias("draw"), c["index"].alias("index"), c["name"].alias("name")))
    return F.array_min(drawn)


def _literal(children: Sequence[Node]) -> Column:
    alive = [(i, c) for i, c in enumerate(children) if c.weight > 0]
    return F.array(*(F.struct(F.lit(i).alias("index"), F.lit(c.name).alias("name"),
                              F.lit(c.weight).alias("weight")) for i, c in alive))


def place(df: DataFrame, key: Column, root: Node, prefix: str = "") -> DataFrame:
    """Adds ``region``, ``rack`` (number inside the region) and ``shard`` (number in
    the tree), each behind ``prefix``; columns of these names are replaced. The key
    and the tree alone decide; a null key is a key of its own, equal keys share a
    shard. Nodes of no weight get nothing. An empty table stays empty."""
    if root.weight <= 0:
        raise ValueError("the tree has no weight")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    at = [f"__{prefix}{n}" for n in ("region", "rack", "shard")]
    df = df.withColumn(at[0], _winner(key, _literal(root.children)))
    region = F.col(f"{at[0]}.index")
    racks = F.array(*(_literal(r.children) if r.weight > 0 else _literal(root.children) for r in root.children))
    df = df.withColumn(at[1], _winner(key, F.element_at(racks, region + 1)))
    flat = [rack for r in root.children for rack in r.children]
    base = [sum(len(r.children) for r in root.children[:i]) for i in range(len(root.children))]
    shards = F.array(*(_literal(rack.children) if rack.weight > 0 else _literal(root.children) for rack in flat))
    rack_at = F.element_at(F.array(*map(F.lit, base)), region + 1) + F.col(f"{at[1]}.index")
    df = df.withColumn(at[2], _winner(key, F.element_at(shards, rack_at + 1)))
    before = [sum(len(rack.children) for rack in flat[:i]) for i in range(len(flat))]
    shard = F.element_at(F.array(*map(F.lit, before)), rack_at + 1) + F.col(f"{at[2]}.index")
    return df.withColumns({f"{prefix}region": region, f"{prefix}rack": F.col(f"{at[1]}.index"),
                           f"{prefix}shard": shard}).drop(*at)


def slots(df: DataFrame, shard: str, digest: str, ties: Sequence[str] = ()) -> DataFrame:
    """Adds ``slot``: 0, 1, 2 … without gaps inside a shard, in the order of a hex
    digest and then of ``ties``. No shard is gathered in one task."""
    df = df.withColumn("__one", F.lit(1)).withColumn("__block", frames.hex_block(F.col(digest)))
    out = frames.running_total(df, [shard], "__block", [F.col(c) for c in (digest, *ties)], "__one", "slot")
    return out.drop("__one", "__block")
