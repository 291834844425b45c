import hashlib
import re

import pytest
from pyspark.sql import functions as F

import llm_edges
from tillflow.llm import stream_dedup as sd


def brute(rows):
    """rows of (doc_id, text): sorted (doc_id, keep_id, group_size, kept, digest)."""
    groups = {}
    for at, (i, text) in enumerate(rows):
        groups.setdefault(re.sub("[ \t-\r]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, at, i))
    out = []
    for body, members in groups.items():
        first = min(members)
        out += [(m[4], first[4], len(members), m == first, hashlib.sha256(body.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in df.collect()), key=str)


def stored(df, path, files=1):
    df.coalesce(1).write.parquet(path) if files == 1 else df.repartition(files).write.parquet(path)
    return path


CASES = [(i, t) for i, t in enumerate(["a b", "ab", " a\tb\r\n", "abc", None, "", " \x0b\x0c", "b a", "ab", "é", "é", " ab"] * 9)]


@pytest.mark.parametrize("files,batch", [(1, None), (8, None), (8, 1), (8, 3000)])
def test_any_cut_into_micro_batches(spark, tmp_path, files, batch):
    path = stored(spark.createDataFrame(CASES, "doc_id long, text string"), f"{tmp_path}/t", files)
    assert rows_of(sd.deduplicated(spark, path, batch_bytes=batch)) == brute(CASES)


@pytest.mark.parametrize("files", [1, 6])
def test_edges_and_clashing_columns(spark, tmp_path, files):
    docs = llm_edges.crowded(spark).withColumns({c: F.lit("mine") for c in ("id", "digest", "chars", "file", "row", "first", "mark")})
    path = stored(docs, f"{tmp_path}/t", files)
    got = rows_of(sd.deduplicated(spark, path, batch_bytes=1))
    want = brute([r[:2] for r in llm_edges.rows()])
    assert got == want
    left = sd.without_copies(spark, path)
    assert left.columns == docs.columns
    assert left.count() == sum(r[3] for r in want)


@pytest.mark.parametrize("digest", [
    lambda t: F.substring(sd.sha256(t), 1, 1), lambda t: F.lit("same").cast("binary"), lambda t: F.crc32(t.cast("binary")).cast("string").cast("binary")])
def test_texts_that_share_a_digest_are_told_apart(spark, tmp_path, digest):
    path = stored(spark.createDataFrame(CASES, "doc_id long, text string"), f"{tmp_path}/t", 5)
    got = sd.deduplicated(spark, path, digest=digest, batch_bytes=1).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got), key=str) == sorted((r[:4] for r in brute(CASES)), key=str)


def test_hot_text(spark, tmp_path):
    rows = [(i, "hot  text" if i % 3 == 0 else f"text {i}") for i in range(6000)]
    path = stored(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/t", 8)
    assert rows_of(sd.deduplicated(spark, path, batch_bytes=100_000)) == brute(rows)


def test_empty_table(spark, tmp_path):
    path = stored(llm_edges.empty(spark), f"{tmp_path}/t")
    assert sd.deduplicated(spark, path).count() == 0
    assert sd.without_copies(spark, path).count() == 0


def test_no_python_and_one_row_a_task_for_a_text(spark, tmp_path):
    path = stored(spark.createDataFrame(CASES, "doc_id long, text string"), f"{tmp_path}/t", 4)
    plan = sd.deduplicated(spark, path)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
