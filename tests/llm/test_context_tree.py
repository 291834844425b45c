import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import llm_edges
from conftest import SMALL
from tillflow.llm import context_tree as ct
from tillflow.llm import frames, queries
from tillflow.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Tree:
    """Context-tree weighting by its recursion, one bit at a time."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.below = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for text in texts:
            for context, byte in self.steps(text):
                for d in range(depth + 1):
                    for node, bit in self.bits(byte):
                        near = context[len(context) - d:]
                        self.counts[near, node][bit] += 1
                        if d:
                            self.below[near[1:], node].add(near)
        self.known = {}

    def steps(self, text):
        data = bytes(self.depth) + lower(text).encode() + b"\0"
        return [(data[i - self.depth:i], data[i]) for i in range(self.depth, len(data))]

    @staticmethod
    def bits(byte):
        return [((1 << k) | (byte >> (8 - k)), byte >> (7 - k) & 1) for k in range(8)]

    def kt(self, zeros, ones):
        return math.lgamma(zeros + .5) + math.lgamma(ones + .5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)

    def weighted(self, context, node):
        if (context, node) not in self.known:
            own = self.kt(*self.counts[context, node]) if (context, node) in self.counts else 0.0
            if len(context) < self.depth:
                under = sum(self.weighted(c, node) for c in self.below.get((context, node), ()))
                own = math.log(.5) + max(own, under) + math.log1p(math.exp(-abs(own - under)))
            self.known[context, node] = own
        return self.known[context, node]

    def predict(self, context, node, bit, d=0):
        near = context[len(context) - d:]
        zeros, ones = self.counts.get((near, node), (0, 0))
        here = ((ones if bit else zeros) + .5) / (zeros + ones + 1)
        if d == self.depth:
            return here
        stop = math.exp(math.log(.5) + self.kt(zeros, ones) - self.weighted(near, node))
        return stop * here + (1 - stop) * self.predict(context, node, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.predict(c, node, bit)) for c, byte in self.steps(text) for node, bit in self.bits(byte))


TEXTS = ["abab abab", "the Cat the cat", "", None, "aaaa", "été\nla", "b", "xyz" * 20, "the cat", "UNSEEN~~", "cat"]


@pytest.mark.parametrize("depth", [2, 3, 4, 6])
def test_tree_by_its_recursion(spark, depth):
    learn = lambda i: i < 8
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    tree = Tree([t for i, t in enumerate(TEXTS) if learn(i)], depth)
    for r in ct.scored(docs, F.col("doc_id") >= 8, depth=depth).collect():
        assert r["score"] == pytest.approx(tree.score(TEXTS[r["doc_id"]]), rel=1e-9)


def test_probabilities_of_a_context_sum_to_one(spark):
    byte = np.arange(256, dtype=np.uint64)
    codes = np.concatenate([(np.uint64(c) << np.uint64(8)) | byte for c in (0x616263, 0x0, 0x7A6263)])
    counts = np.zeros(len(codes), int)
    counts[[97, 98, 300, 301, 520]] = [5, 2, 1, 9, 3]
    df = spark.createDataFrame([(int(c), int(n)) for c, n in zip(codes, counts)], "code long, n long")
    got = {r["code"]: r["log10_p"] for r in ct.weighted_grams(df, 3).collect()}
    for i in range(3):
        assert sum(10 ** got[int(c)] for c in codes[256 * i:256 * i + 256]) == pytest.approx(1)


def test_kt_and_grams():
    n = np.array([0, 1, 3, 15, 16, 17, 40, 10_000, 3])
    m = np.array([0, 0, 2, 16, 15, 80, 0, 20_000, 10 ** 6])
    want = [math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(n.tolist(), m.tolist())]
    assert np.allclose(ct.log_kt(n, m), want, rtol=1e-12, atol=1e-8)
    (_, _, batch), = tx.batches(pa.array(["ab", None, "c"]))
    doc, code = ct.grams(batch, 2)
    assert doc.tolist() == [0, 0, 0, 1, 2, 2]
    assert [int(c) for c in code] == [0x61, 0x6162, 0x616200, 0, 0x63, 0x6300]


def base(rows, held):
    counts = defaultdict(int)
    for key, text in rows:
        if not held(key):
            for t in [*WORD.findall(lower(text)), None]:
                counts[t] += 1
    n, v = sum(counts.values()), len(counts)
    for key, text in rows:
        tokens = [*WORD.findall(lower(text)), None]
        yield len(tokens), sum(t in counts for t in tokens), n, sum(math.log10((counts.get(t, 0) + 1) / (n + v + 1)) for t in tokens)


def test_contract_on_the_small_table(spark):
    docs = frames.table(spark, SMALL)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    held = lambda key: zlib.crc32(str(key).encode()) % 7 == 2
    got = {r["doc_id"]: r for r in queries.op9_context_tree(spark, SMALL).collect()}
    assert len(got) == len(texts)
    for (key, text), (tokens, known, n, score) in zip(texts, base(texts, held)):
        r = got[key]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(key), tokens, known, n)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert r["bits_per_byte"] == pytest.approx(-r["score"] * math.log2(10) / max(len(text.encode()), 1))
    out = [r["bits_per_byte"] for r in got.values() if r["held_out"]]
    assert 1 < np.mean(out) < 4


def test_blocks_do_not_matter(spark, monkeypatch):
    docs = frames.table(spark, SMALL)
    held = F.col("doc_id") % 3 == 0
    one = {r["doc_id"]: tuple(r) for r in ct.scored(docs, held).collect()}
    many = {r["doc_id"]: tuple(r) for r in ct.scored(docs.repartition(9), held).collect()}
    assert one.keys() == many.keys()
    for k in one:
        assert one[k][:5] == many[k][:5] and np.allclose(one[k][5:], many[k][5:], rtol=1e-9)


def test_edges(spark):
    docs = llm_edges.crowded(spark)
    rows = ct.scored(docs, F.col("doc_id") % 4 == 0).collect()
    assert len(rows) == len(llm_edges.rows())
    assert all(r["score"] < 0 and math.isfinite(r["score"]) and r["base_score"] < 0 for r in rows)
    assert sum(r["held_out"] for r in rows) == sum(r[0] is not None and r[0] % 4 == 0 for r in llm_edges.rows())
    unlearnt = ct.scored(docs, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in unlearnt)
    assert all(r["score"] == pytest.approx(-8 * math.log10(2)) for r in unlearnt if r["n_tokens"] == 1 and r["bits_per_byte"] == 8)
    assert ct.scored(llm_edges.empty(spark), F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        ct.scored(docs, F.lit(False), depth=1)


def test_default_depth_beats_the_word_model(spark):
    rows = queries.op9_context_tree(spark, "/root/testdata/sf0.1").where("held_out")
    tree, words = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert tree > words


def test_runs_are_whole_subtrees(monkeypatch):
    monkeypatch.setattr(ct, "SUBTREES", 10)
    code = np.random.default_rng(1).integers(0, 1 << 13, 200).astype(np.uint64)
    runs = list(ct._subtrees(code, code.astype(float)))
    assert len(runs) > 5 and sorted(np.concatenate([c for c, _ in runs]).tolist()) == sorted(code.tolist())
    groups = [set((c >> np.uint64(8)).tolist()) for c, _ in runs]
    assert sum(map(len, groups)) == len(set().union(*groups))
    assert all((n == c).all() for c, n in runs)
    assert not list(ct._subtrees(code[:0], np.zeros(0)))


@pytest.mark.parametrize("bits", [24, 48, 56])
def test_packed_counts_are_the_same(bits):
    """Keys sorted together with their counts, as those of up to 63 bits are."""
    draw = np.random.default_rng(bits)
    for n in (0, 1, 5000):
        keys = draw.integers(0, 1 << bits, n, np.uint64) | np.uint64((1 << bits) - 1 << 8 & (1 << bits) - 1) * draw.integers(0, 2, n, np.uint64)
        counted = draw.integers(0, 2, n)
        packed, plain = ct._Tally._sum_packed(keys, counted), ct._Tally._sum(keys, counted)
        assert packed[0].dtype == np.uint64 and packed[1].dtype == np.int64
        assert [x.tolist() for x in packed] == [x.tolist() for x in plain]
