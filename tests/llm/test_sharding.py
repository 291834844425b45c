import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import llm_edges
from tillflow.llm import queries, sharding


def placed(df, regions, prefix=""):
    return sharding.place(df, F.col("doc_id"), sharding.tree(regions), prefix)


def shards(spark, regions, n=20_000):
    return {r["doc_id"]: (r["region"], r["rack"], r["shard"]) for r in
            placed(spark.range(n).withColumnRenamed("id", "doc_id"), regions).collect()}


def test_shares_follow_weights(spark):
    regions = [[[1, 2], [1]], [[4]]]
    got = Counter(s for _, _, s in shards(spark, regions).values())
    for shard, share in enumerate([1 / 8, 2 / 8, 1 / 8, 4 / 8]):
        assert abs(got[shard] / 20_000 - share) < 4 * math.sqrt(share * (1 - share) / 20_000)


def test_movement_stays_in_the_changed_subtree(spark):
    before = shards(spark, [[[1, 1], [1, 1]], [[1, 1], [1, 1]]])
    after = shards(spark, [[[1, 1], [1, 1]], [[1, 1], [1, 3]]])
    moved = [(before[k], after[k]) for k in before if before[k] != after[k]]
    assert moved
    for old, new in moved:
        # Into the heavier region, in it into the heavier rack, in that into the heavier shard,
        # and never from one untouched place to another within them.
        assert new[0] == 1
        if old[0] == 1:
            assert new[1] == 1
            if old[1] == 1:
                assert new[2] == 7


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before, after = shards(spark, queries.REGIONS), shards(spark, sharding.grown(queries.REGIONS))
    moved = [after[k][2] for k in before if before[k][2] != after[k][2]]
    assert set(moved) == {16} and abs(len(moved) / 20_000 - 1 / 17) < 0.01


def test_nodes_without_weight_get_nothing(spark):
    got = shards(spark, [[[0, 1], [0, 0]], [[0]], [[2]]], 2000)
    assert {s for _, _, s in got.values()} == {1, 5}
    with pytest.raises(ValueError):
        placed(spark.range(1).withColumnRenamed("id", "doc_id"), [[[0]]])


def test_edges(spark):
    docs = llm_edges.crowded(spark)
    rows = placed(docs, queries.REGIONS).withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    rows = sharding.slots(rows, "shard", "digest", ("doc_id", "n_chars"))
    assert rows.columns == [*docs.columns[:-1], "digest", "rack"] or set(rows.columns) == {*docs.columns, "rack"}
    got = rows.select("doc_id", "shard", "slot").collect()
    assert len(got) == len(llm_edges.rows())
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    of = {}
    for r in got:
        assert of.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    nothing = sharding.slots(placed(llm_edges.empty(spark).withColumn("digest", F.md5("text")), queries.REGIONS),
                             "shard", "digest")
    assert nothing.count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op1_hash_tree_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
