"""Runs of words: stretches that repeat with a period, found by minimizers of many scales.

A run of period q and at least 2q words holds every stretch of its first part again, q
words on. At the scale of a period, between Q and 2Q, the smallest of the hashes of all
stretches of Q/4 words in a window of 3Q/4 places is such a stretch: it is chosen again
in the window q words on. Pairs of chosen places with equal hashes, Q to 2Q apart, are
seeds; each is extended in both directions by comparing hashes of spans. Periods too
short for a scale are found by comparing every word with the one that far on.

Stretches that themselves repeat with a period of at most a quarter of their length are
never chosen, so chosen equal ones lie apart and a scale has few seeds. What that could
miss is a run whose first part lies within one run of a far shorter period: then its
second part lies within another one of the same words that begins where the first ends
or before, and those are put together directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import text as tx

#: Words of the shortest run.
SHORTEST = 12
#: Periods below this are found by direct comparison; a power of two.
DIRECT = 32
#: Runs shorter than this matter to no scale.
_LEAST = 8
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Sequence:
    """Words as numbers, with hashes of all spans."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words, self.n = words, n
        self.power, self.back = tx.powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self.power[:n], out=self.sums[1:])

    def spans(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the spans of that many words; those beyond the end have the last value."""
        out = np.full(len(at), _NONE)
        inside = at + length <= self.n
        at = at[inside]
        out[inside] = tx.mix((self.sums[at + length] - self.sums[at]) * self.back[at])
        return out

    def _equal(self, a: np.ndarray, lag: np.ndarray, length: int) -> np.ndarray:
        own = (self.sums[a + length] - self.sums[a]) * self.power[lag]
        return own == self.sums[a + lag + length] - self.sums[a + lag]

    def extended(self, at: np.ndarray, lag: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the stretches around ``at`` that equal those ``lag`` on begin and, ``lag`` on, end."""
        right, left = at.copy(), at.copy()
        for bit in range(most.bit_length(), -1, -1):
            step = 1 << bit
            go = np.flatnonzero(right + lag + step <= self.n)
            go = go[self._equal(right[go], lag[go], step)]
            right[go] += step
            go = np.flatnonzero(left >= step)
            go = go[self._equal(left[go] - step, lag[go], step)]
            left[go] -= step
        return left, right + lag


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of the stretches of true values of at least that length."""
    at = np.flatnonzero(same)
    if not len(at):
        return at, at
    first = np.flatnonzero(np.diff(at, prepend=at[0] - 2) != 1)
    length = np.diff(first, append=len(at))
    long = length >= least
    return at[first[long]], length[long]


def _smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each stretch once, with its smallest period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _sliding(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over every window of that many values."""
    out, have = values, 1
    while 2 * have <= width:
        out = take(out[:-have], out[have:])
        have *= 2
    return take(out[:len(out) - (width - have)], out[width - have:]) if have < width else out


def _chosen(values: np.ndarray, width: int) -> np.ndarray:
    """Which values are the smallest of a window they are in."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    least = _sliding(values, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero((_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == values) & (values != _NONE))


def _pairs(at: np.ndarray, hashes: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal hashes ``low`` to twice that apart."""
    order = np.argsort(hashes, kind="stable")
    at, hashes = at[order], hashes[order]
    out, back = [], 1
    while back < len(at):
        near = np.flatnonzero((hashes[back:] == hashes[:-back]) & (at[back:] - at[:-back] < 2 * low))
        if not len(near):
            break
        lag = at[near + back] - at[near]
        far = lag >= low
        out.append((at[near][far], lag[far]))
        back += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _across(seq: _Sequence, start: np.ndarray, end: np.ndarray, period: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the runs with one part in a run of a far shorter period and the other in
    the next such run of the same words, which begins where that one ends or before."""
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    meet = np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1]) & (start[1:] > start[:-1])
                          & (end[1:] - start[1:] >= low) & (end[:-1] - start[:-1] >= low))
    at, lags = [], []
    for a in meet.tolist():
        i, e, f, g, d = int(start[a]), int(end[a]), int(start[a + 1]), int(end[a + 1]), int(period[a])
        turn = np.flatnonzero(seq.spans(np.arange(i, i + d), d) == seq.spans(np.array([f]), d))
        if not len(turn):
            continue
        lag = np.arange(low + (f - i - int(turn[0]) - low) % d, 2 * low, d)
        begin, stop = np.maximum(i, f - lag), np.minimum(e, g - lag)
        whole = stop - begin >= lag
        at.append(begin[whole])
        lags.append(lag[whole])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at), np.concatenate(lags)


def runs(words: np.ndarray, sizes: np.ndarray, shortest: int = SHORTEST, direct: int = DIRECT) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of at least ``shortest`` words, by
    text, start and period. ``words`` has the words of all texts as numbers, ``sizes`` how
    many each text has."""
    n_texts = len(sizes)
    # A number of its own ends every text, so no run goes on into the next one.
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    own = np.ones(len(words) + n_texts, bool)
    own[bounds[1:] - 1] = False
    line = tx.draws(len(own), 91)
    line[own] = words
    longest = int(sizes.max(initial=0))
    found = [(np.zeros(0, np.int64),) * 3]
    for lag in range(1, min(direct, longest // 2 + 1)):
        start, length = _stretches(line[:-lag] == line[lag:], max(lag, min(_LEAST, shortest) - lag))
        found.append((start, start + length + lag, np.full(len(start), lag)))
    start, end, period = _smallest(*map(np.concatenate, zip(*found)))
    seq = _Sequence(line) if longest >= 2 * direct else None
    low = direct
    while 2 * low <= longest:
        size, width = low // 4, 3 * low // 4
        places = np.flatnonzero(np.repeat(sizes >= 2 * low, sizes + 1))
        hashes = seq.spans(places, size)
        small = (period <= size // 4) & (end - start >= size)
        inner = np.zeros(len(line) + 1, np.int32)
        np.add.at(inner, start[small], 1)
        np.add.at(inner, end[small] - size + 1, -1)
        hashes[np.cumsum(inner)[places] > 0] = _NONE
        pick = _chosen(hashes, width)
        seeds = [_pairs(places[pick], hashes[pick], low), _across(seq, start[small], end[small], period[small], low)]
        at, lag = map(np.concatenate, zip(*seeds))
        left, right = seq.extended(at, lag, longest)
        run = right - left >= 2 * lag
        start, end, period = _smallest(*(np.concatenate(x) for x in ((start, left[run]), (end, right[run]), (period, lag[run]))))
        low *= 2
    keep = end - start >= np.maximum(shortest, 2 * period)
    start, end, period = start[keep], end[keep], period[keep]
    text = np.searchsorted(bounds, start, "right") - 1
    order = np.lexsort((period, start))
    return np.stack([text, start - bounds[text], end - start, period], axis=1)[order]


def repeated(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which words lie in a run, after its first period."""
    base = np.concatenate([[0], np.cumsum(sizes)])
    text, start, length, period = found.T
    change = np.zeros(base[-1] + 1, np.int32)
    np.add.at(change, base[text] + start + period, 1)
    np.add.at(change, base[text] + start + length, -1)
    return np.cumsum(change[:-1]) > 0


_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def collapsed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST,
              direct: int = DIRECT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` has start (number of a word), length and smallest period, in words, of every
    stretch of at least ``shortest`` words and two periods that goes on in neither
    direction, by start and period. ``collapsed`` is the words that lie in no run but for its
    first period, joined by single spaces. Words are runs of anything but space and 0x09
    to 0x0D, told apart by 64-bit hashes.

    Null text counts as empty: no words, no runs, an empty text. Runs that share their
    longest length or their start are all listed. Repeated rows give a row each, a null
    key is a key. A text is never cut: one beyond the size of a batch is worked on alone, in
    some hundred bytes a word, and its work grows as its words times the logarithm of
    their number, also if it repeats one word. Other columns, whatever their names, are not
    read. An empty table gives an empty result. No shuffle: rows stay in their tasks.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(f"n_words bigint, runs {_RUNS}, collapsed string").fields])
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for a, b, texts in tx.batches(table.column(1)):
                sizes = texts.words.per_doc
                found = runs(texts.words.hash, sizes, shortest, direct)
                ends = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(found[:, i]) for i in (1, 2, 3)], fields=list(kind.value_type)))
                kept = pa.array(_joined(texts, ~repeated(found, sizes), ends), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([table.column(0).slice(a, b - a), pa.array(sizes), lists, kept], names=schema.names)

    return rows.mapInArrow(run, schema)


def _joined(texts: tx.Texts, keep: np.ndarray, runs_before: np.ndarray) -> list[bytes]:
    data, offsets = texts.data.tobytes(), texts.offsets.tolist()
    first = np.concatenate([[0], np.cumsum(texts.words.per_doc)]).tolist()
    any_run = (np.diff(runs_before) > 0).tolist()
    out = []
    for i, cut in enumerate(any_run):
        # Splits at space and 0x09 to 0x0D, as words are defined.
        words = data[offsets[i]:offsets[i + 1]].split()
        if cut:
            words = [w for w, k in zip(words, keep[first[i]:first[i + 1]].tolist()) if k]
        out.append(b" ".join(words))
    return out
