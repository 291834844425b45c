import random

import pytest

from tillflow.operators import offsets


def frame(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long")


def missing(rows):
    """(partition, first, last) of every hole, by walking the offsets."""
    out = []
    for p in {p for _, p, _ in rows}:
        own = sorted({o for _, q, o in rows if q == p and o is not None})
        out += [(p, a + 1, b - 1) for a, b in zip(own, own[1:]) if b > a + 1]
    return sorted(out)


def found(df):
    rows = df.collect()
    assert all(r["offsets"] == r["last"] - r["first"] + 1 for r in rows)
    return sorted((r["partition"], r["first"], r["last"]) for r in rows)


@pytest.mark.parametrize("block", [1, 7, 1000, 1_000_000])
def test_gaps_of_any_blocks_by_walking(spark, monkeypatch, block):
    monkeypatch.setattr(offsets, "BLOCK", block)
    rng = random.Random(block)
    rows = [("t", p, o) for p in range(3) for o in range(300) if rng.random() < 0.8] + [("t", 0, None), ("t", 4, 9), ("t", 0, 5), ("t", 0, 5)]
    assert found(offsets.gaps(offsets.intervals(frame(spark, rows)))) == missing(rows)


def test_intervals_of_many_micro_batches_overlap_and_come_in_any_order(spark):
    rng = random.Random(4)
    rows = [("t", p, o) for p in range(2) for o in range(200) if o % 17 and not 60 < o < 90]
    parts = [rng.sample(rows, 120) for _ in range(6)] + [rows]
    kept = None
    for part in parts:
        own = offsets.intervals(frame(spark, part))
        kept = own if kept is None else kept.union(own)
    assert found(offsets.gaps(kept)) == missing(rows)


def test_unbroken_partitions_are_one_interval(spark):
    rows = [("t", p, o) for p in range(2) for o in range(5000)]
    got = offsets.intervals(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == [("t", 0, 0, 4999), ("t", 1, 0, 4999)]
    assert offsets.gaps(offsets.intervals(frame(spark, []))).count() == 0
