"""Whole batches of texts as byte arrays: words, lines and their hashes at once.

Works on the UTF-8 buffer of an Arrow string column, so a batch costs a few numpy
passes whatever the number of texts in it. Inside Spark tasks only.

Words are the maximal runs of bytes other than space and 0x09 to 0x0D. All
separators are ASCII, so words of the bytes are words of the code points. Words,
lines and windows are identified by 64-bit hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Odd, to tell equal hashes of different texts of a batch apart.
STEP = np.uint64(0x9E3779B97F4A7C15)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def draws(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = draws(256, 11)
_BASE = 0x9E3779B97F4A7C15
_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(n, 1 << 16)
        held = np.full(size, base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if size <= 2 * SLICE_BYTES:
            _powers[base] = held
    return held[:n]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of hashes of spans, and of its inverse."""
    return _power(_BASE, n), _power(pow(_BASE, -1, 1 << 64), n)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order, each once, and how often each occurs."""
    keys = np.sort(keys)
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    return keys[at], np.diff(at, append=len(keys))


def first_of_each(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs for the first time."""
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    return first


class Texts:
    """Texts laid end to end; null counts as empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self._derived: list[Texts] = []

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def lowered(self) -> Texts:
        """The texts with A to Z in lower case."""
        self._derived.append(Texts(_LOWER[self.data], self.offsets))
        return self._derived[-1]

    def release(self) -> None:
        """Let go of what was computed. Texts and their words refer to each other, and
        large arrays would stay until Python happens to look for such rings."""
        for texts in self._derived:
            texts.release()
        for name in ("words", "lines", "_sums", "_derived"):
            self.__dict__.pop(name, None)
        self._derived = []

    @cached_property
    def _sums(self) -> np.ndarray:
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * _power(_BASE, len(self.data)), out=sums[1:])
        return sums

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One hash for each span of bytes, the same wherever the span stands."""
        back = _power(pow(_BASE, -1, 1 << 64), len(self.data) + 1)
        return mix((self._sums[end] - self._sums[start]) * back[start] + (end - start).astype(np.uint64))

    def text_hashes(self) -> np.ndarray:
        return self.hashes(self.offsets[:-1], self.offsets[1:])

    @cached_property
    def words(self) -> Words:
        inside = ~_SPACE[self.data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = self.offsets[:-1][self.sizes > 0]
        begins[cuts] = inside[cuts]
        cuts = self.offsets[1:][self.sizes > 0] - 1
        ends[cuts] = inside[cuts]
        return Words(self, np.flatnonzero(begins), np.flatnonzero(ends) + 1)

    @cached_property
    def lines(self) -> Words:
        """Lines between newlines; a text of n newlines has n + 1 lines."""
        breaks = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        end = np.sort(np.concatenate([self.offsets[1:], breaks]), kind="stable")
        return Words(self, start, end, np.repeat(np.arange(len(self)), 1 + self._between(breaks)))

    def _between(self, at: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(at, self.offsets))


class Words:
    """Spans of a batch in order of their place, with the text each is in."""

    def __init__(self, texts: Texts, start: np.ndarray, end: np.ndarray, doc: np.ndarray | None = None):
        self.texts, self.start, self.end = texts, start, end
        self._doc = doc

    def __len__(self) -> int:
        return len(self.start)

    @cached_property
    def doc(self) -> np.ndarray:
        if self._doc is not None:
            return self._doc
        return np.repeat(np.arange(len(self.texts)), self.texts._between(self.start))

    @cached_property
    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.texts))

    @cached_property
    def hash(self) -> np.ndarray:
        return self.texts.hashes(self.start, self.end)

    def strings(self, which: np.ndarray) -> list[str]:
        data = self.texts.data.tobytes()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(self.start[which].tolist(), self.end[which].tolist())]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n words in a row, and the index of each window's first word."""
        if len(self) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        count = len(self) - n + 1
        h = np.zeros(count, np.uint64)
        for i in range(n):
            h = h * np.uint64(0xD1342543DE82EF95) + self.hash[i:i + count]
        at = np.flatnonzero(self.doc[:count] == self.doc[n - 1:])
        return mix(h[at]), at


#: What operators keep in a worker between tasks, as functions that drop it.
kept: list[Callable[[], None]] = []


def forget() -> None:
    """Drop what other operators have kept: a worker goes on with the next stage."""
    for drop in kept:
        drop()
    give_back()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Free memory to the system: a worker lives on, and what it keeps is missing elsewhere."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def batches(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """The column in runs of about ``limit`` bytes; a longer text is a run alone. A run
    is good until the next one is asked for."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        texts = Texts(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        yield first, last, texts
        texts.release()
        first = last
    give_back()
