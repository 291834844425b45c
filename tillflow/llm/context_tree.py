"""LM scoring by context-tree weighting over bytes.

Each byte is eight binary decisions; each decision has a tree of contexts, the last 0,
1 … D bytes. Every node predicts by Krichevsky-Trofimov from its own counts, and the
tree weights all its prunings: a node's weighted probability is half its own estimate
and half the product of its children's. Counts come from all training texts, the tree
is then frozen, and a text's probability is the product of the mixed predictions, that
of its end included.

A prediction depends on the last D bytes and the byte alone, so everything goes by
(D + 1)-grams: counted and weighted once for the whole corpus, by Spark, and looked up
block by block. A block of texts fetches only the grams and words that occur in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, pi

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames
from tillflow.llm import text as tx

#: Bytes of context. Every gram is a 64-bit code, so at most 7.
DEPTH = 5
#: Grams whose levels are held at a time, but for a larger subtree.
SUBTREES = 1 << 18
#: Text of one block; texts are not cut, so a longer one is a block alone.
BLOCK_BYTES = 24 << 20
#: Text of a block that is worked on at a time; a byte takes some hundred bytes of arrays.
SLICE_BYTES = 1 << 18
GRAM, WORD, END = 0, 1, 2

_lgamma = np.frompyfunc(lgamma, 1, 1)
_table = np.zeros(0)


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log Γ(n + 1/2) of counts; Stirling's series from 16 on."""
    global _table
    if not len(_table):
        _table = _lgamma(np.arange(16) + 0.5).astype(float)
    z = np.maximum(n, 16) + 0.5
    series = (z - 0.5) * np.log(z) - z + 0.5 * log(2 * pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
    return np.where(n < 16, _table[np.minimum(n, 15).astype(np.int64)], series)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    z = np.maximum(n, 16) + 1.0
    series = (z - 0.5) * np.log(z) - z + 0.5 * log(2 * pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
    small = np.array([lgamma(i + 1) for i in range(16)])
    return np.where(n < 16, small[np.minimum(n, 15).astype(np.int64)], series)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - log(pi) - _log_factorial(zeros + ones)


def grams(texts: tx.Texts, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of every byte and of the end of every text, in order. A code is the
    bytes before, the nearest one last, and the byte itself; before the text, and as its
    end, stands 0."""
    n, sizes = len(texts), texts.sizes
    start = texts.offsets[:-1] + (np.arange(n) + 1) * depth + np.arange(n)
    padded = np.zeros(len(texts.data) + n * (depth + 1), np.uint64)
    padded[np.arange(len(texts.data)) + np.repeat(start - texts.offsets[:-1], sizes)] = texts.data
    at = np.arange(len(texts.data) + n) + np.repeat((np.arange(n) + 1) * depth, sizes + 1)
    code = np.zeros(len(padded), np.uint64)
    for back in range(depth + 1):
        code[back:] |= padded[:len(padded) - back] << np.uint64(8 * back)
    return np.repeat(np.arange(n), sizes + 1), code[at]


class Level:
    """All nodes of one depth below some grams: (context, bits so far), their counts
    and, in ``path``, the node of each gram's eight decisions."""

    def __init__(self, code: np.ndarray, count: np.ndarray, depth: int):
        byte = (code & np.uint64(255)).astype(np.int64)
        context = (code >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)
        step = np.arange(8)
        prefix = (1 << step) | (byte[:, None] >> (8 - step))
        self.bit = (byte[:, None] >> (7 - step)) & 1
        key = (context[:, None] << np.uint64(8)) | prefix.astype(np.uint64)
        self.key, path = np.unique(key.reshape(-1), return_inverse=True)
        self.path = path.reshape(-1, 8)
        weight = np.repeat(count.astype(float), 8)
        flat, bits = self.path.reshape(-1), self.bit.reshape(-1)
        self.ones = np.bincount(flat, weights=weight * bits, minlength=len(self.key))
        self.zeros = np.bincount(flat, weights=weight * (1 - bits), minlength=len(self.key))
        self.own = log_kt(self.zeros, self.ones)
        self.weighted = self.own
        self.stop = np.ones(len(self.key))

    def mix(self, below: np.ndarray) -> None:
        """Weight the nodes with the sums of their children's log probabilities."""
        self.weighted = np.logaddexp(self.own, below) - log(2)
        self.stop = np.exp(self.own - log(2) - self.weighted)

    def mix_children(self, child: Level, depth: int) -> None:
        """The same from a whole level below; a child's parent drops its farthest byte."""
        parent = ((child.key >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8) | child.key & np.uint64(255)
        self.mix(np.bincount(np.searchsorted(self.key, parent), weights=child.weighted, minlength=len(self.key)))

    def predict(self) -> np.ndarray:
        """Krichevsky-Trofimov prediction of each gram's eight bits."""
        seen = np.where(self.bit == 1, self.ones[self.path], self.zeros[self.path])
        return (seen + 0.5) / (self.zeros + self.ones + 1)[self.path]


def _levels(code: np.ndarray, count: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels depth … top of grams that hold whole subtrees from depth ``top`` on."""
    levels = [Level(code, count, depth)]
    for d in range(depth - 1, top - 1, -1):
        level = Level(code, count, d)
        level.mix_children(levels[-1], d)
        levels.append(level)
    return levels


def log10_probability(code: np.ndarray, levels: list[Level], above: list[tuple[np.ndarray, np.ndarray]] = ()) -> np.ndarray:
    """log10 of each gram's mixed prediction; ``levels`` run from the deepest up and
    ``above`` has (stop, prediction), by gram and bit, of those above them."""
    mixed = levels[0].predict()
    for level in levels[1:]:
        stop = level.stop[level.path]
        mixed = stop * level.predict() + (1 - stop) * mixed
    for stop, own in above:
        mixed = stop * own + (1 - stop) * mixed
    return np.log10(mixed).sum(axis=1)


# The two upper levels of the whole tree are small: 256 contexts of 255 nodes at most.

def _top(pairs: np.ndarray, count: np.ndarray, below: dict[int, float]) -> list[Level]:
    """Levels 1 and 0 from counts of (last byte, byte) and sums over level 2."""
    one = Level(pairs, count, 1)
    one.mix(np.array([below.get(int(k), 0.0) for k in one.key]))
    zero = Level(pairs, count, 0)
    zero.mix_children(one, 0)
    return [one, zero]


def _above(code: np.ndarray, top: list[Level]) -> list[tuple[np.ndarray, np.ndarray]]:
    byte = (code & np.uint64(255)).astype(np.int64)
    step = np.arange(8)
    prefix = ((1 << step) | (byte[:, None] >> (8 - step))).astype(np.uint64)
    bit = (byte[:, None] >> (7 - step)) & 1
    out = []
    for level, context in zip(top, ((code >> np.uint64(8)) & np.uint64(255), np.zeros(len(code), np.uint64))):
        at = np.searchsorted(level.key, (context[:, None] << np.uint64(8)) | prefix)
        seen = np.where(bit == 1, level.ones[at], level.zeros[at])
        out.append((level.stop[at], (seen + 0.5) / (level.zeros + level.ones + 1)[at]))
    return out


def _gathered(tables: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(t.column(0).to_numpy(), t.column(1).to_numpy()) for t in tables]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0)
    code = np.concatenate([c for c, _ in parts]).view(np.uint64)
    return code, np.concatenate([n for _, n in parts])


def _subtrees(code: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grams in runs of whole subtrees from depth 2 on."""
    group = code >> np.uint64(8) & np.uint64(0xFFFF)
    order = np.argsort(group, kind="stable")
    code, count, group = code[order], count[order], group[order]
    starts = np.flatnonzero(np.diff(group, prepend=group[:1] + np.uint64(1)))
    cuts = starts[np.flatnonzero(np.diff(starts // SUBTREES, prepend=-1))]
    for a, b in zip(cuts, [*cuts[1:], len(code)]):
        yield code[a:b], count[a:b]


def weighted_grams(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(code, log10_p) from (code, n), each code once; codes of count 0 are looked up
    only. Grams of the same last two context bytes lie in one partition, which holds all
    their subtree; levels 1 and 0 are joined by sums of at most 65,280 nodes."""
    if not 2 <= depth <= 7:
        raise ValueError("depth is 2 to 7")
    group = F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF))
    parts = frames.saved(counts.select(F.col("code"), F.col("n")), "grams").repartition(group)

    def sums(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for code, n in _subtrees(*_gathered(tables)):
            level = _levels(code, n, depth, 2)[-1]
            node = (level.key >> np.uint64(8) & np.uint64(255)) << np.uint64(8) | level.key & np.uint64(255)
            distinct, which = np.unique(node, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)),
                                              pa.array(np.bincount(which, weights=level.weighted))], names=["node", "below"])

    below = parts.mapInArrow(sums, "node long, below double").groupBy("node").agg(F.sum("below").alias("below"))
    below = dict(below.toArrow().to_pandas().itertuples(index=False))
    pair = counts.groupBy(F.col("code").bitwiseAND(F.lit(0xFFFF)).alias("pair")).agg(F.sum("n").alias("n")).toArrow()
    order = np.argsort(pair.column("pair").to_numpy())
    top = _top(pair.column("pair").to_numpy()[order].view(np.uint64), pair.column("n").to_numpy()[order], below)

    def score(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for code, n in _subtrees(*_gathered(tables)):
            value = log10_probability(code, _levels(code, n, depth, 2), _above(code, top))
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(value)], names=["code", "log10_p"])

    return parts.mapInArrow(score, "code long, log10_p double")


def _in_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, text, held_out) with a block number, written: blocks are runs of a task's
    rows, and stay what they are once written."""
    schema = T.StructType([*docs.schema.fields, T.StructField("block", T.LongType())])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        block, held = TaskContext.get().partitionId() << 24, 0
        for table in tables:
            for a, b, texts in tx.batches(table.column(1)):
                if held and held + len(texts.data) > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += len(texts.data)
                part = table.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(b - a, block))], names=schema.names)

    return frames.saved(docs.mapInArrow(run, schema), "text-blocks")


class _Tally:
    """Distinct keys of a block with their training counts. Keys of fewer than 64 ``bits``
    leave room for the count of one occurrence, 0 or 1, and are sorted together with it."""

    def __init__(self, bits: int = 64):
        self.bits = bits
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counted: np.ndarray) -> None:
        self.parts.append(self._sum(keys, counted) if self.bits == 64 else self._sum_packed(keys, counted))
        self.held += len(self.parts[-1][0])
        if self.held > 1 << 21:
            self.parts = [self.result()]
            self.held = len(self.parts[0][0]) // 2

    @staticmethod
    def _sum_packed(keys: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        packed = np.sort(keys << np.uint64(1) | counted.astype(np.uint64))
        keys, counted = packed >> np.uint64(1), (packed & np.uint64(1)).astype(np.int64)
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(first)
        return keys[at], np.add.reduceat(counted, at) if len(at) else counted

    @staticmethod
    def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(first)
        return keys[at], np.add.reduceat(counts, at) if len(at) else counts

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        return self._sum(*(np.concatenate(x) for x in zip(*self.parts)))


_ENTRY = "block long, kind int, key long, n long"


def _entries(blocks: DataFrame, depth: int) -> DataFrame:
    """(block, kind, key, n): every gram and word of a block, with its count in the
    block's training texts, and the number of these."""
    def flush(block: int, tallies: list[_Tally], ends: int) -> Iterator[pa.RecordBatch]:
        for kind, (keys, n) in enumerate([*(t.result() for t in tallies), (np.zeros(1, np.uint64), np.array([ends]))]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), block)), pa.array(np.full(len(keys), kind, np.int32)),
                 pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["block", "kind", "key", "n"])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        now, tallies, ends = None, [], 0
        for table in tables:
            held, block = (table.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            cuts = np.flatnonzero(np.diff(block, prepend=block[:1])).tolist()
            for x, y in zip([0, *cuts], [*cuts, len(block)]):
                if block[x] != now:
                    if now is not None:
                        yield from flush(now, tallies, ends)
                    now, tallies, ends = int(block[x]), [_Tally(8 * (depth + 1)), _Tally()], 0
                for a, b, texts in tx.batches(table.column(0).slice(x, y - x), SLICE_BYTES):
                    texts = texts.lowered()
                    learn = (~held[x + a:x + b]).astype(np.int64)
                    ends += int(learn.sum())
                    doc, code = grams(texts, depth)
                    tallies[GRAM].add(code, learn[doc])
                    tallies[WORD].add(texts.words.hash, learn[texts.words.doc])
        if now is not None:
            yield from flush(now, tallies, ends)

    return blocks.select("text", "held_out", "block").mapInArrow(run, _ENTRY)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of wanted keys, looked up in order of the keys: these are more than a cache holds."""
    order = np.argsort(wanted)
    found = np.empty(len(wanted), values.dtype)
    found[order] = values[np.searchsorted(keys, wanted[order])]
    return found


def scored(docs: DataFrame, held_out: Column, *, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    Learns from the rows where ``held_out``, a condition on the key, is false, and
    scores all. Texts are lower-cased (A to Z). ``score`` is the tree's log10
    probability of the text's bytes and its end, ``bits_per_byte`` its code length over
    the bytes. ``base_score`` is that of an add-one model of words and one end.

    Null text counts as empty and is scored as one that ends at once. Equal rows count
    as often as they occur. Without training rows all counts are 0 and every bit has
    one half. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = _in_blocks(rows)
    same = Window.partitionBy("kind", "key")
    entries = _entries(blocks, depth).select(
        "block", "kind", "key", F.sum("n").over(same).alias("n"),
        (F.row_number().over(same.orderBy("block")) == 1).alias("first"))
    entries = frames.saved(entries, "text-entries")

    totals = {r["kind"]: r for r in entries.where("first").groupBy("kind").agg(
        F.sum("n").alias("tokens"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct")).collect()}
    n_of = lambda kind, what: int(totals[kind][what]) if kind in totals else 0
    ends = n_of(END, "tokens")
    n_all, v_all = n_of(WORD, "tokens") + ends, n_of(WORD, "distinct") + (ends > 0)

    known = entries.where((F.col("kind") == GRAM) & F.col("first")).select(F.col("key").alias("code"), "n")
    known = frames.saved(weighted_grams(known, depth), "gram-probabilities")
    values = entries.where(F.col("kind") == GRAM).join(known, F.col("key") == F.col("code")).select(
        "block", "kind", "key", F.col("log10_p").alias("value"))
    values = values.union(entries.where(F.col("kind") == WORD).select(
        "block", "kind", "key", F.col("n").cast("double").alias("value")))

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    kinds = [docs.schema[key].dataType, T.BooleanType(), *[T.LongType()] * 3, *[T.DoubleType()] * 3]

    def run(texts_of: pa.Table, found: pa.Table) -> pa.Table:
        kind, keys, value = (found.column(c).to_numpy() for c in ("kind", "key", "value"))
        looked = []
        for k in (GRAM, WORD):
            # A block has a key once.
            own = keys[kind == k].view(np.uint64)
            order = np.argsort(own)
            looked.append((own[order], value[kind == k][order]))
        del kind, keys, value
        base = np.log10(n_all + v_all + 1.0)
        end = np.log10(ends + 1.0)
        out = [[] for _ in range(5)]
        for _, _, texts in tx.batches(texts_of.column("text"), SLICE_BYTES):
            n, texts = len(texts), texts.lowered()
            doc, code = grams(texts, depth)
            score = np.bincount(doc, weights=_find(*looked[GRAM], code), minlength=n)
            words = texts.words
            c = _find(*looked[WORD], words.hash) if len(words) else np.zeros(0)
            tokens = words.per_doc + 1
            plain = np.bincount(words.doc, weights=np.log10(c + 1), minlength=n) + end - tokens * base
            out[0].append(tokens)
            out[1].append(np.bincount(words.doc[c > 0], minlength=n) + (ends > 0))
            out[2].append(plain)
            out[3].append(score)
            out[4].append(-score * np.log2(10) / np.maximum(texts.sizes, 1))
        tokens, known_tokens, plain, score, bits = (np.concatenate(x) for x in out)
        return pa.table([texts_of.column("doc_id"), texts_of.column("held_out"), pa.array(tokens.astype(np.int64)),
                         pa.array(known_tokens.astype(np.int64)), pa.array(np.full(len(tokens), n_all)), pa.array(plain),
                         pa.array(score), pa.array(bits)], names=names)

    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    return blocks.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(lambda a, b: run(a, b), schema)
