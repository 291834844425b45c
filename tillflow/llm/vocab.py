"""Token ids of whole batches, each distinct span encoded once. Inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from tillflow.llm.text import Texts, Words


def spread(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """values[start : start + count] of every entry, one after the other."""
    total = int(count.sum())
    step = start - (np.cumsum(count) - count)
    return values[np.arange(total) + np.repeat(step, count)]


#: So many spans are encoded at once: what a tokenizer gives back of a span is far larger
#: than its ids.
ENCODE_SPANS = 1 << 13


class Grown:
    """An array that grows at its end, in place. Views of it are good until it grows."""

    def __init__(self, first: np.ndarray):
        self._held, self.size = first.copy(), len(first)

    @property
    def values(self) -> np.ndarray:
        return self._held[:self.size]

    def extend(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self._held):
            self._held.resize(max(size, len(self._held) * 5 // 4), refcheck=False)
        self._held[self.size:size] = values
        self.size = size


class SpanIds:
    """Ids by span, for a tokenizer that encodes spans independently.

    Keeps what it has encoded, by hash, until ``limit`` spans; then those go that did not
    come again, or all if more than half did, so memory is bounded and results are the same.
    Spans stand in the order they came in, and only their hashes are sorted: what is kept is
    not copied when spans are added.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 1 << 20,
                 test: Callable[[list[str], list[list[int]]], list[bool]] | None = None):
        self.encode, self.limit, self.test = encode, limit, test
        self._reset()

    def _reset(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int32)
        self.ends = Grown(np.zeros(1, np.int64))
        self.pool = Grown(np.zeros(0, np.uint32))
        self.passed = Grown(np.zeros(0, bool))
        self.again = Grown(np.zeros(0, bool))

    def _shrink(self) -> None:
        keep = self.again.values
        left = np.flatnonzero(keep)
        if len(left) > self.limit // 2:
            return self._reset()
        start = self.ends.values[left]
        count = self.ends.values[left + 1] - start
        self.pool = Grown(spread(self.pool.values, start, count))
        self.ends = Grown(np.concatenate([[0], np.cumsum(count)]))
        self.passed = Grown(self.passed.values[left])
        stays = keep[self.place]
        self.known = self.known[stays]
        self.place = (np.cumsum(keep, dtype=np.int32) - 1)[self.place[stays]]
        self.again = Grown(np.zeros(len(left), bool))

    def _learn(self, at: np.ndarray, hashes: np.ndarray, spans: list[str]) -> None:
        """``at``: where the hashes belong among those known."""
        place = np.arange(self.again.size, self.again.size + len(spans), dtype=np.int32)
        for first in range(0, len(spans), ENCODE_SPANS):
            some = spans[first:first + ENCODE_SPANS]
            lists = self.encode(some)
            count = np.fromiter(map(len, lists), np.int64, len(lists))
            self.ends.extend(self.pool.size + np.cumsum(count))
            self.pool.extend(np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum())))
            self.passed.extend(np.array(self.test(some, lists), bool) if self.test else np.ones(len(some), bool))
        self.again.extend(np.zeros(len(spans), bool))
        self.place = np.insert(self.place, at, place)
        self.known = np.insert(self.known, at, hashes)

    def _places(self, spans: Words) -> np.ndarray:
        if len(self.known) > self.limit:
            self._shrink()
        distinct, first, which = np.unique(spans.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        old = np.zeros(len(distinct), bool)
        if len(self.known):
            old = self.known[np.minimum(at, len(self.known) - 1)] == distinct
            self.again.values[self.place[at[old]]] = True
        if not old.all():
            self._learn(at[~old], distinct[~old], spans.strings(first[~old]))
            at = np.searchsorted(self.known, distinct)
        return self.place[at][which.reshape(-1)]

    def tested(self, spans: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in order, how many each span has, and whether it passed the test,
        which each distinct span is put to once."""
        if not len(spans):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)
        place = self._places(spans)
        start = self.ends.values[place]
        count = self.ends.values[place + 1] - start
        return spread(self.pool.values, start, count), count, self.passed.values[place]

    def __call__(self, spans: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each span has."""
        return self.tested(spans)[:2]


def per_text(spans: Words, count: np.ndarray) -> np.ndarray:
    """Sums of per-span counts by text."""
    return np.bincount(spans.doc, weights=count, minlength=len(spans.texts)).astype(np.int64)


def between_single_spaces(texts: Texts) -> Words:
    """Texts cut at each space that has no space beside it; the space itself is left
    out. Empty texts have no span. A space is left standing when the bytes beside it
    could belong to U+2581."""
    data = texts.data
    space = data == 32
    left, right = np.zeros(len(data), bool), np.zeros(len(data), bool)
    left[1:] = ~space[:-1] & (data[:-1] != 0x81)
    right[:-1] = ~space[1:] & (data[1:] != 0xE2)
    cut = space & left & right
    full = texts.sizes > 0
    cut[texts.offsets[:-1][full]] = False
    cut[texts.offsets[1:][full] - 1] = False
    at = np.flatnonzero(cut)
    start = np.sort(np.concatenate([texts.offsets[:-1][full], at + 1]), kind="stable")
    end = np.sort(np.concatenate([texts.offsets[1:][full], at]), kind="stable")
    return Words(texts, start, end)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = True
_PUNCT[48:58] = False
_PUNCT &= ~_LETTER


def words_and_marks(texts: Texts) -> Words:
    """Words, cut where an ASCII letter meets an ASCII mark; an apostrophe stays with
    the letters after it."""
    words, data = texts.words, texts.data
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        a, b = data[:-1], data[1:]
        cut[1:-1] = (_LETTER[a] & _PUNCT[b]) | (_PUNCT[a] & _LETTER[b] & (a != 39))
    cut[texts.offsets[:-1]] = False
    at = np.flatnonzero(cut)
    return Words(texts, np.sort(np.concatenate([words.start, at]), kind="stable"),
                 np.sort(np.concatenate([words.end, at]), kind="stable"))
