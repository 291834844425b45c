import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import llm_edges
from conftest import SMALL
from tillflow.llm import periodic_runs as pr
from tillflow.llm import queries
from tillflow.llm import text as tx


def brute(words, shortest=12):
    """All runs by comparing every word with that of every lag."""
    best, n = {}, len(words)
    codes = np.unique(np.array(list(words), dtype=str), return_inverse=True)[1] if n else np.zeros(0, int)
    for lag in range(1, n // 2 + 1):
        same = np.concatenate([[0], codes[:-lag] == codes[lag:], [0]]).astype(int)
        turns = np.flatnonzero(np.diff(same))
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b - a >= lag:
                best.setdefault((a, b + lag), lag)
    return sorted((a, b - a, q) for (a, b), q in best.items() if b - a >= max(shortest, 2 * q))


def found(texts, shortest=12, direct=pr.DIRECT):
    """Runs of lists of words, by text."""
    codes = {w: h for w, h in zip(sorted({w for t in texts for w in t}), tx.draws(10_000, 3))}
    words = np.array([codes[w] for t in texts for w in t], np.uint64)
    rows = pr.runs(words, np.array([len(t) for t in texts], np.int64), shortest, direct)
    out = [[] for _ in texts]
    for t, *run in rows.tolist():
        out[t].append(tuple(run))
    return out


@given(st.lists(st.text(alphabet="ab", max_size=150), min_size=1, max_size=4), st.sampled_from([8, 32]), st.sampled_from([2, 12]))
@settings(max_examples=300, deadline=None)
def test_two_words(texts, direct, shortest):
    assert found(texts, shortest, direct) == [brute(t, shortest) for t in texts]


@given(st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=12), st.integers(1, 40)), min_size=1, max_size=7), st.sampled_from([8, 16, 32]))
@settings(max_examples=400, deadline=None)
def test_repeats_next_to_repeats(parts, direct):
    text = "".join(p * n for p, n in parts)
    assert found([text, text[::-1], "x" + text], 12, direct) == [brute(t) for t in (text, text[::-1], "x" + text)]


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 4)), min_size=2, max_size=9))
@settings(max_examples=300, deadline=None)
def test_repeats_of_repeats(steps):
    text = "ab"
    for kind, n in steps:
        text = [text * n, text + "c" * n, text + text[: len(text) // n], text + text + "a"][kind][:700]
    assert found([text], 12, 8) == [brute(text)]


def test_known_hard_texts():
    fib = ["a", "ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    morse = "a"
    while len(morse) < 1000:
        morse += morse.translate({97: 98, 98: 97})
    texts = [fib[-1], morse, "a" * 1000, "aab" * 150 + "a" + "aab" * 150, ("a" * 40 + "b") * 30, "ab" * 200 + "ba" * 200,
             ("aab" * 30 + "c") * 8, ""]
    for direct in (8, 32):
        assert found(texts, 12, direct) == [brute(t) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_long_periods_in_prose(seed):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(300)}" for _ in range(6000)]
    for period, times in ((17, 3), (90, 2), (700, 2), (1300, 3)):
        at = rng.randrange(len(words))
        part = words[at:at + period]
        words[at:at] = part * times
    assert found([words[:3000], words[3000:], words]) == [brute(words[:3000]), brute(words[3000:]), brute(words)]


def test_seeds_stay_few_on_one_word():
    line = np.full(200_000, 7, np.uint64)
    assert pr.runs(line, np.array([len(line)])).tolist() == [[0, 0, 200_000, 1]]


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall("[^ \t-\r]+", text or "")


def test_edges_and_clashing_columns(spark):
    docs = llm_edges.crowded(spark).withColumn("runs", F.lit("mine")).withColumn("collapsed", F.lit(1))
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.collapsed(docs).collect()), key=str)
    want = []
    for i, text, *_ in llm_edges.rows():
        words = split(text)
        runs = brute(words) if len(words) < 5000 else found([words])[0]
        want.append((i, len(words), runs, collapse(words, runs)))
    assert got == sorted(want, key=str)


def test_runs_across_batches_and_very_long_texts(spark, monkeypatch):
    long = " ".join(f"{w}" for w in [*range(20_000)] * 3)
    docs = spark.createDataFrame([(1, long), (2, "a b " * 50), (3, None), (4, "c " * 300_000)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.collapsed(docs).collect()}
    assert got == {1: ([(0, 60_000, 20_000)], " ".join(map(str, range(20_000)))), 2: ([(0, 100, 2)], "a b"),
                   3: ([], ""), 4: ([(0, 300_000, 1)], "c")}


def test_empty_table(spark):
    assert pr.collapsed(llm_edges.empty(spark)).count() == 0


def test_query_by_brute_force(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, tails = [], 0
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words, h = split(r["text"]), zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, tails = words[:a] + [words[a + (i - a) % p] for i in range(a, n)], tails + 1
        runs = brute(words)
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        want.append((r["doc_id"], len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                     sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapse(words, runs))))
    got = queries.op11_periodic_runs(spark, SMALL)
    assert dict(got.dtypes) | {"doc_id": "", "runs_sha256": "", "collapsed_sha256": ""} == dict.fromkeys(got.columns, "bigint") | {
        "doc_id": "", "runs_sha256": "", "collapsed_sha256": ""}
    assert sorted(map(tuple, got.collect())) == sorted(want) and tails > 10
