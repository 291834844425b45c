import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import llm_edges
from conftest import SMALL
from tillflow.llm import fertility, frames, queries
from tillflow.llm.fertility import Band

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside)


ODD = ["a b c d e f g h " * 3, "x\nx\n x\nx \n\n\nx", "#*$%&|<>", "é日 " * 9, "w " * 100, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", "a\x1cb\x85c"]


def test_counts_by_brute_force(spark):
    docs = frames.table(spark, SMALL).select("doc_id", "text").union(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = fertility.judged(docs, MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in fertility.COUNTS) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_measures_by_the_library(spark):
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["plain words of text", "🤖🤖 ﷽ okay", "ha ha ha ha", "日本語 テスト", "", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in fertility.measured(docs, MODEL).collect():
        words = WORD.findall(texts[r["doc_id"]])
        ids = [i for w in words for i in own.encode(w)]
        n = len(ids)
        assert r["n_tokens"] == n
        if n:
            assert r["chars_per_token"] == pytest.approx(sum(map(len, words)) / n)
            assert r["fallback_share"] == pytest.approx(sum(own.is_byte(i) for i in ids) / n)
            assert r["token_entropy"] == pytest.approx(-sum(c / n * math.log2(c / n) for c in Counter(ids).values()), abs=1e-9)


def test_bands_by_language(spark):
    text = " ".join(llm_edges.prose(200, 3).split())
    docs = spark.createDataFrame([(i, text, x) for i, x in enumerate(["en", "de", None, "xx"])], "doc_id long, text string, lang string")
    open_, shut = Band((0, 99), (0, 1), (0, 1)), Band((90, 99), (0, 1), (0, 1))
    kept = {r["doc_id"] for r in fertility.judged(docs, MODEL, bands={"en": shut, "de": open_}, other=shut).collect() if r["kept"]}
    assert kept == {1}
    kept = {r["doc_id"] for r in fertility.judged(docs, MODEL, bands={}, other=open_).collect() if r["kept"]}
    assert kept == {0, 1, 2, 3}


def test_clean_texts_stay_and_many_bad_ones_go(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in frames.table(spark, sf, "labels").collect()}
    rows = [(r["kept"], labels[r["doc_id"]], r["base_failed"]) for r in queries.op8_tokenizer_fertility(spark, sf).collect() if r["doc_id"] in labels]
    good = [k for k, q, failed in rows if q == 1 and not failed]
    bad = [k for k, q, _ in rows if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.6


def test_limits_reject_bad_texts_without_the_base_rules(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in frames.table(spark, sf, "labels").collect()}
    rows = [(r["kept"], labels[r["doc_id"]]) for r in queries.op8_tokenizer_fertility(spark, sf).collect()
            if r["doc_id"] in labels and not r["base_failed"]]
    good, bad = ([kept for kept, q in rows if q == quality] for quality in (1, 0))
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.25


def test_limits_by_brute_force(spark, tmp_path):
    fertility.measured(frames.table(spark, "/root/testdata/sf0.01"), MODEL).write.parquet(str(tmp_path / "measured"))
    rows = spark.read.parquet(str(tmp_path / "measured"))
    groups = {}
    for r in rows.where(~fertility.base_failed()).collect():
        share = r["token_entropy"] / math.log2(max(r["n_tokens"], 2))
        for language in (r["language"], "any"):
            groups.setdefault((language, len(f"{r['n_tokens']:b}")), []).append((r["chars_per_token"], r["fallback_share"], share))

    def fence(values, measure, sign):
        beyond, least = fertility.FENCES[measure]
        low, high = np.quantile(np.round(values, 3), [0.25, 0.75])
        return (low, high)[sign > 0] + sign * beyond * max(high - low, least)

    found = {(r["language"], r["length_class"]): r for r in fertility.limits(rows).collect()}
    assert found.keys() == {k for k in groups if k[0] != "any"}
    for (language, length), r in found.items():
        values = next((groups[k] for k in ((language, length), ("any", length)) if len(groups[k]) >= fertility.LEAST_TEXTS), None)
        got = [r["least_chars"], r["most_fallback"], r["least_entropy"]]
        if values is None:
            assert got == [None] * 3
        else:
            want = [fence(v, m, s) for v, m, s in zip(zip(*values), fertility.FENCES, (-1, 1, -1))]
            assert got == pytest.approx(want, abs=2e-3)


def test_edges(spark):
    rows = fertility.judged(llm_edges.crowded(spark), MODEL).collect()
    assert len(rows) == len(llm_edges.rows())
    assert all(r["n_words"] or (r["base_failed"] and not r["kept"] and r["token_entropy"] == 0) for r in rows)
    assert fertility.judged(llm_edges.empty(spark), MODEL).count() == 0
