import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import llm_edges
from conftest import SMALL
from tillflow.llm import frames, queries, token_files

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def expected(rows, path, end):
    tokenizer = Tokenizer.from_file(path)
    encoded = tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    start, out = 0, {}
    for (key, _), e in zip(rows, encoded):
        ids = [*e.ids, end]
        out.setdefault(key, []).append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


def test_whole_table_equals_the_library(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in frames.table(spark, SMALL).collect())
    want, _ = expected(docs, WORDS, 2)
    got = queries.op10_token_files(spark, SMALL).collect()
    assert len(got) == len(docs)
    assert all(want[r["doc_id"]] == [(r["start"], r["n_tokens"], r["ids_crc32"])] for r in got)


ODD = ["don't stop'S, it's 'tis ''s", "A-Z a_z x.y,z!? (a) \"b\"", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "é̀́ Ω日本 ½²",
       "a b c\x1cd", "", None, "İstanbul ẞ ǅ", "!!!...???", "1234567890 1a2b", "x" * 5000, "'ll've'd 'LL", "#\n#\r\n"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_odd_texts(spark, path):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    manifest = token_files.written(docs, path, 7, length=16)
    want, total = expected(list(enumerate(ODD)), path, 7)
    assert {r["key"]: [(r["start"], r["n_tokens"], r["ids_crc32"])] for r in token_files.read_back(manifest).collect()} == want
    assert manifest.groupBy().sum("n_tokens").first()[0] == total


def test_sequences_are_views_of_equal_length(spark):
    docs = spark.createDataFrame([(i, llm_edges.prose(3000, i)) for i in range(5)], "doc_id long, text string").coalesce(1)
    rows = token_files.written(docs, WORDS, 2, length=64).orderBy("part").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    stream = [i for r in docs.orderBy("doc_id").collect() for i in [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]]
    at = 0
    for r in rows:
        file = token_files.SequenceFile(r["path"])
        for i in range(len(file)):
            ids, mask = file[i]
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata and ids.dtype == np.uint16
            valid = mask.true_count
            assert valid == 64 or i == len(file) - 1
            assert ids[:valid].tolist() == stream[at:at + valid] and not ids[valid:].any()
            at += valid
        with pytest.raises(IndexError):
            file[len(file)]
    assert at == len(stream)
    schema = pa.ipc.open_file(pa.memory_map(rows[0]["path"].removeprefix("file:"))).schema
    assert schema.field("ids").type == pa.list_(pa.uint16(), 64)


def test_edges(spark):
    manifest = token_files.written(llm_edges.crowded(spark), WORDS, 2)
    rows = token_files.read_back(manifest).orderBy("start").collect()
    assert len(rows) == len(llm_edges.rows())
    keys = [r["key"] for r in rows]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])
    assert [r["start"] for r in rows] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])[:-1]]).tolist()
    nothing = token_files.written(llm_edges.empty(spark), WORDS, 2)
    assert nothing.count() == 0 and token_files.read_back(nothing).count() == 0


def test_string_keys(spark):
    docs = spark.createDataFrame([("b", "two"), ("a", "one")], "doc_id string, text string")
    rows = token_files.read_back(token_files.written(docs, WORDS, 2)).orderBy("start").collect()
    assert [r["key"] for r in rows] == ["a", "b"]
