import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillflow.llm import text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\r\x0b\x1c.日 ", max_size=30)), max_size=8)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_lines(texts, limit):
    words, lines = [], []
    for a, b, batch in tx.batches(pa.array(texts, pa.string()), limit):
        part = [t or "" for t in texts[a:b]]
        own = batch.words
        strings = own.strings(np.arange(len(own)))
        words += [(a + int(d), s) for d, s in zip(own.doc, strings)]
        rows = batch.lines
        lines += [(a + int(d), s) for d, s in zip(rows.doc, rows.strings(np.arange(len(rows))))]
        seen = {}
        for s, h in zip(strings, own.hash.tolist()):
            assert seen.setdefault(s, h) == h
        assert len(set(seen.values())) == len(seen)
        assert own.per_doc.tolist() == [len(WORD.findall(t)) for t in part]
    assert words == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    assert lines == [(i, x) for i, t in enumerate(texts) for x in (t or "").split("\n")]


def test_batches_cover_a_sliced_column():
    column = pa.array(["x", None, "yy", "", "zzz"] * 3, pa.string()).slice(4, 7)
    got = [bytes(b.data[s:e]).decode() for _, _, b in tx.batches(column, 3) for s, e in zip(b.offsets, b.offsets[1:])]
    assert got == [t or "" for t in column.to_pylist()]


@pytest.mark.parametrize("n", [1, 5, 8])
def test_windows_stay_inside_texts(n):
    texts = ["a b c d e f g h i", "a b c", "", "b c d e f g h i j k"]
    (_, _, batch), = tx.batches(pa.array(texts))
    hashes, at = batch.words.windows(n)
    want = [tuple(t.split()[i:i + n]) for t in texts for i in range(len(t.split()) - n + 1)]
    assert len(at) == len(want)
    assert len(set(hashes.tolist())) == len(set(want))


def test_distinct():
    keys = np.array([3, 1, 3, 3, 2])
    assert [x.tolist() for x in tx.distinct(keys)] == [[1, 2, 3], [1, 1, 3]]
    assert tx.distinct(keys[:0])[0].size == 0
    assert tx.first_of_each(keys).tolist() == [True, True, False, False, True]


def test_hash_does_not_move_with_its_place():
    (_, _, a), = tx.batches(pa.array(["needle in hay"]))
    (_, _, b), = tx.batches(pa.array([prose := "x" * 70_000 + " needle"]))
    assert a.words.hash[0] == b.words.hash[1] and zlib.crc32(prose.encode())
