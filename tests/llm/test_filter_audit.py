import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import llm_edges
from tillflow.llm import filter_audit as fa
from tillflow.llm import text as tx


def mask_of(text):
    words = re.findall("[^ \t-\r]+", text)
    fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
             100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), bool(set(text) & set("#$%&*|")))
    return sum(f << i for i, f in enumerate(fails))


def brute(rows, labels):
    """rows of (doc_id, text, part): a Counter of (part, mask, good, toxic)."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = Counter()
    for i, text, part in rows:
        again = i is not None and i > first[text or ""]
        out[part or "", mask_of(text or "") | again << 4, *labels.get(i, (False, False))] += 1
    return out


def steps(counts):
    """Every row sent through every order."""
    out = {}
    for part in {p for p, *_ in counts}:
        shapley = Counter()
        own = []
        for order in map("".join, permutations("ABCDE")):
            left = {k: n for k, n in counts.items() if k[0] == part}
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                gone = {k: n for k, n in left.items() if k[1] & bit}
                left = {k: n for k, n in left.items() if not k[1] & bit}
                failing = {k: n for k, n in counts.items() if k[0] == part and k[1] & bit}
                shapley[name] += sum(gone.values())
                own.append((order, step, name, sum(left.values()), sum(gone.values()), sum(failing.values()) - sum(gone.values()),
                            sum(n for k, n in failing.items() if k[1] == bit), sum(n for k, n in gone.items() if k[2]),
                            sum(n for k, n in gone.items() if k[3])))
        out |= {(part, order, step): (*values, shapley[name]) for order, step, name, *values in own}
    return out


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def counts_of(df):
    return Counter({(r["part"], r["mask"], r["good"], r["toxic"]): r["n"] for r in df.collect()})


def table(spark, rows, path, files):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (df.repartition(files) if files > 1 else df.coalesce(1)).write.parquet(path)
    return path


def made(seed, n=300):
    rng = random.Random(seed)
    texts = ["", "a b", "x " * 250, " ".join(f"w{i}" for i in range(230)), "ABC def", "a # b", None, " ".join(f"W{i}|" for i in range(201))]
    ids = rng.sample(range(-n, n), n)
    return [(i, rng.choice(texts) if rng.random() < 0.8 else f"own {i}", rng.choice(["en", "de", None, ""])) for i in ids]


@given(st.lists(st.text(alphabet="aB#é日 \n|", max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_masks(texts):
    for _, _, batch in tx.batches(pa.array(texts, pa.string())):
        assert fa.masks(batch).tolist() == [mask_of(t) for t in texts]


def test_masks_at_their_limits():
    many = [f"w{i}" for i in range(199)]
    texts = [" ".join(many), " ".join([*many, "x"]), "a b " * 100, "a b c " * 100, "a a b b", "a a b b b", "ABC" + "x" * 97, "ABCD" + "x" * 96]
    batch = next(tx.batches(pa.array(texts)))[2]
    assert fa.masks(batch).tolist() == [mask_of(t) for t in texts]


@pytest.mark.parametrize("files,batch,texts", [(1, None, 64), (9, 1, 64), (9, 1, 3), (4, 1, 100_000)])
def test_masks_are_retracted_in_any_order_of_files(spark, tmp_path, monkeypatch, files, batch, texts):
    monkeypatch.setattr(fa, "TEXTS_AN_ENTRY", texts)
    rows = made(files)
    labels = [(i, i % 2, i % 3 if i % 5 else None) for i, *_ in rows[:200]] + [(rows[0][0], 1, 1), (None, 1, 1)]
    marks = {i: (any(q == 1 for j, q, _ in labels if j == i), any(t == 1 for j, _, t in labels if j == i)) for i, *_ in rows}
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = counts_of(fa.counted(spark, table(spark, rows, f"{tmp_path}/t", files), frame, batch_bytes=batch))
    assert got == brute(rows, marks)


def test_edges_and_clashing_columns(spark, tmp_path):
    docs = llm_edges.crowded(spark).withColumns({c: F.lit("mine") for c in ("id", "part", "mask", "flags", "n", "entry", "good", "marks")})
    docs.repartition(5).write.parquet(f"{tmp_path}/t")
    rows = [(r[0], r[1], r[2]) for r in llm_edges.rows()]
    assert counts_of(fa.counted(spark, f"{tmp_path}/t", batch_bytes=1)) == brute(rows, {})


def test_a_text_on_a_third_of_the_rows_stays_few_rows(spark, tmp_path, confs):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i}", "en") for i in range(9000)]
    path = table(spark, rows, f"{tmp_path}/t", 6)
    assert counts_of(fa.counted(spark, path, batch_bytes=40_000)) == brute(rows, {})
    hot = spark.createDataFrame([(bytearray(b"x"), i, "en", 1) for i in range(5000)], "digest binary, id long, part string, flags int")
    few = fa._combined(hot.coalesce(1)).collect()
    assert sorted((r["id"] is None, r["n"]) for r in few) == [(False, 1), (True, 4999)]


def test_every_order_and_step(spark):
    rng = random.Random(3)
    counts = Counter({(p, m, g, t): rng.randint(0, 9) for p in ("", "en") for m in range(32) for g in (False, True) for t in (False, True)
                      if rng.random() < 0.7})
    df = spark.createDataFrame([(*k, n) for k, n in counts.items()], "part string, mask int, good boolean, toxic boolean, n long")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in fa.interactions(df).collect()}
    assert got == steps(counts)
    assert len(got) == 2 * 600


def test_empty_table(spark, tmp_path):
    llm_edges.empty(spark).write.parquet(f"{tmp_path}/t")
    assert fa.interactions(fa.counted(spark, f"{tmp_path}/t")).count() == 0
