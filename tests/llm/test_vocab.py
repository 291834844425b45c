import tracemalloc

import numpy as np
import pytest

from tillflow.llm import vocab
from tillflow.llm.text import Texts


def _texts(*texts: str) -> Texts:
    data = [t.encode() for t in texts]
    return Texts(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))


def _codes(spans: list[str]) -> list[list[int]]:
    return [[ord(c) for c in s] for s in spans]


@pytest.mark.parametrize("limit", [0, 7, 60, 1 << 20])
def test_same_ids_whatever_is_kept(limit):
    ids = vocab.SpanIds(_codes, limit, test=lambda spans, lists: [s[0] != "1" for s in spans])
    for first in [*range(0, 200, 9), *range(0, 200, 5)]:
        words = [str(first + i % 13) for i in range(40)]
        flat, count, passed = ids.tested(_texts(" ".join(words), "").words)
        assert flat.tolist() == sum(_codes(words), []) and count.tolist() == [len(w) for w in words]
        assert passed.tolist() == [w[0] != "1" for w in words]
    assert len(ids.known) <= limit + 13
    assert ids.tested(_texts("").words)[0].tolist() == []


def test_spans_that_come_again_stay():
    asked = []
    ids = vocab.SpanIds(lambda spans: asked.extend(spans) or _codes(spans), limit=50)
    for i in range(40):
        ids(_texts(f"always here {' '.join(f'w{i}x{j}' for j in range(20))}").words)
    assert asked.count("always") == 1 and len(ids.known) < 80


def test_spans_are_encoded_a_few_at_once():
    most = []
    ids = vocab.SpanIds(lambda spans: most.append(len(spans)) or _codes(spans))
    ids(_texts(" ".join(map(str, range(3 * vocab.ENCODE_SPANS + 1)))).words)
    assert max(most) == vocab.ENCODE_SPANS and sum(most) == 3 * vocab.ENCODE_SPANS + 1


def test_what_is_kept_is_not_copied_for_a_few_more():
    ids = vocab.SpanIds(_codes)
    n = 300_000
    ids(_texts(" ".join(f"word{i:08d}" for i in range(n))).words)
    ids(_texts("more").words)
    few = _texts("few more").words
    tracemalloc.start()
    ids(few)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24 * n
