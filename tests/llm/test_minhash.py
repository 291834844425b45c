import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import llm_edges
from conftest import SMALL
from tillflow.llm import dart_minhash as dm
from tillflow.llm import frames
from tillflow.llm import text as tx


def bag(text, n=5):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or Counter([tuple(words)])


def jaccard(a, b):
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 0.0


def brute(rows, at_least=0.8):
    """Class of each row of (id, text) by comparing all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    head = list(range(len(texts)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= at_least:
                head[find(i)] = find(j)
    ids = defaultdict(list)
    at = {t: find(i) for i, t in enumerate(texts)}
    for key, t in rows:
        if key is not None:
            ids[at[t or ""]].append(key)
    return sorted(((k, min(ids[at[t or ""]], default=None)) for k, t in rows), key=str)


def found(df):
    return sorted(((r["doc_id"], r["class_id"]) for r in dm.classes(df).collect()), key=str)


@pytest.mark.parametrize("n", [1, 3, 60, 2000])
def test_signatures_estimate_weighted_similarity(n):
    rng = np.random.default_rng(n)
    element = rng.integers(0, 1 << 62, n, dtype=np.uint64)
    a = rng.uniform(0.05, 40, n)
    b = a * rng.uniform(0.3, 1.5, n) * (rng.random(n) < 0.9) + 1e-3
    k = 3000
    s = dm.signatures(np.repeat([0, 1], n), np.tile(element, 2), np.concatenate([a, b]), 2, k)
    assert (s != dm._NONE).all()
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - want) < 4.5 * (want * (1 - want) / k) ** 0.5 + 1e-9


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(1)
    element, weight = rng.integers(0, 1 << 62, 50, dtype=np.uint64), rng.integers(1, 9, 50).astype(float)
    alone = dm.signatures(np.zeros(50, int), element, weight, 1, 192)
    many = dm.signatures(np.repeat(np.arange(900), 50), np.tile(element, 900), np.tile(weight, 900), 900, 192)
    assert (many == alone[0]).all()


def test_shingles_are_weighted_by_count():
    (_, _, batch), = tx.batches(pa.array(["a b c d e a b c d e", "x y", "", None, "x  y"]))
    doc, h, w = dm.shingles(batch)
    assert sorted(w[doc == 0]) == [1, 1, 1, 1, 2]
    assert h[doc == 1] == h[doc == 4] and not (doc == 2).any() and not (doc == 3).any()
    assert set(dm.shingles(batch, weights="set")[2]) == {1.0}


def test_all_links_of_the_small_table(spark):
    docs = frames.table(spark, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs) == brute(rows)


def test_near_copies_of_one_text(spark):
    """A base whose copies are near it but often not near each other, chains, and texts
    that share a passage but are not alike."""
    rng = random.Random(3)
    words = llm_edges.prose(150, 1).split()
    rows = [(1000, " ".join(words))]
    for i in range(150):
        copy = list(words)
        for _ in range(rng.choice([1, 2, 3, 5, 8])):
            copy[rng.randrange(len(copy))] = f"new{rng.random()}"
        rows.append((i, " ".join(copy)))
    for i in range(60):
        rows.append((2000 + i, " ".join(words[:60]) + " " + llm_edges.prose(90, 100 + i)))
    chain = llm_edges.prose(100, 2).split()
    for i in range(12):
        chain = chain[2:] + [f"tail{i}", f"end{i}"]
        rows.append((3000 + i, " ".join(chain)))
    rows += [(4000 + i, " ".join(words)) for i in range(300)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_edges(spark):
    docs = llm_edges.crowded(spark)
    assert found(docs) == brute([(r[0], r[1]) for r in llm_edges.rows()])
    assert found(llm_edges.empty(spark)) == []
    kept = dm.without_copies(docs)
    assert kept.columns == docs.columns
    classes = {r["class_node"] for r in dm.classes(docs).collect()}
    assert kept.count() == len(classes)
    assert dm.without_copies(llm_edges.empty(spark)).count() == 0


def test_exact_similarity(spark):
    pairs = [("a b c d e f", "a b c d e f g"), ("a b", "a b"), ("a b c d e a b c d e", "a b c d e"), ("", "a"), ("x " * 50, "x " * 45)]
    df = spark.createDataFrame([(i, i, a, b) for i, (a, b) in enumerate(pairs)], "a long, b long, text_a string, text_b string")
    for r in dm.similarity(df).collect():
        assert r["similarity"] == pytest.approx(jaccard(*map(bag, pairs[r["a"]])))


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5)]
    head = {}

    def find(x):
        while head.setdefault(x, x) != x:
            x = head[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in frames.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[x] == find(x) for x in got)
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
    assert frames.components(spark.createDataFrame([], "a long, b long")).count() == 0
