"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams, of words and of word shapes, are scaled by the log-count
ratio of the two classes and go into a linear hinge-loss model, fitted by dual
coordinate descent. Ratios are counted over all training rows; the model is fitted on a
bounded sample of them and its margin is turned into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames
from tillflow.llm import text as tx

#: Hash space of the features; bounds the model, its counts and their collection.
DIMENSIONS = 1 << 18
#: At most this many labelled rows, drawn by a hash of their key, fit the model.
SAMPLE = 5000
WORD_ORDER, SHAPE_ORDER = 2, 4
THRESHOLD = 0.7


def _count(texts: tx.Texts, mask: np.ndarray) -> np.ndarray:
    """How many bytes of a kind each word has."""
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[texts.words.end] - sums[texts.words.start]


def shapes(texts: tx.Texts) -> np.ndarray:
    """A hash of each word's look: case, digits, marks, last mark, length, and whether
    it repeats the word before it."""
    words, data = texts.words, texts.data
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    mark = (data > 32) & (data < 127) & ~upper & ~lower & ~digit
    n_upper, n_lower, n_mark = (_count(texts, m) for m in (upper, lower, mark))
    last = data[words.end - 1]
    size = words.end - words.start
    same = np.zeros(len(words), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    case = np.where(n_upper == 0, 0, np.where((n_upper > 1) & (n_lower == 0), 2, np.where(upper[words.start], 1, 3)))
    parts = (case, np.minimum(n_mark, 4), np.where(mark[words.end - 1], last, 0), _count(texts, digit) > 0,
             np.searchsorted([2, 4, 8, 16, 32], size), n_mark == size, same)
    h = np.full(len(words), 3, np.uint64)
    for p in parts:
        h = tx.mix(h * np.uint64(0xD1342543DE82EF95) + p.astype(np.uint64))
    return h


def features(texts: tx.Texts, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the distinct features of each text, in order of text."""
    words = texts.words
    doc, feature = [], []
    for stream, order, salt in ((texts.lowered().words.hash, WORD_ORDER, 1), (shapes(texts), SHAPE_ORDER, 101)):
        h = np.zeros(len(words), np.uint64)
        for n in range(1, order + 1):
            if len(words) < n:
                break
            count = len(words) - n + 1
            h = h[:count] * np.uint64(0xD1342543DE82EF95) + stream[n - 1:]
            at = np.flatnonzero(words.doc[:count] == words.doc[n - 1:])
            doc.append(words.doc[at])
            feature.append(tx.mix(h[at] + np.uint64(salt + n)) % np.uint64(dimensions))
    if not doc:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, _ = tx.distinct(np.concatenate(doc) * dimensions + np.concatenate(feature).astype(np.int64))
    return key // dimensions, key % dimensions


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    scale: tuple[float, float]

    def scores(self, texts: tx.Texts) -> np.ndarray:
        """Probability of label 1. A text without words has the bias alone."""
        doc, feature = features(texts, len(self.weights))
        n = np.bincount(doc, minlength=len(texts))
        margin = np.bincount(doc, weights=self.weights[feature], minlength=len(texts))
        return self._probability(margin / np.sqrt(np.maximum(n, 1)) + self.bias)

    def _probability(self, margin: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))


def log_count_ratio(positive: np.ndarray, negative: np.ndarray, rows: tuple[int, int], smooth: float = 1.0) -> np.ndarray:
    """log of the two classes' smoothed shares of their rows that hold a feature;
    0 for a feature that no row holds."""
    p = (positive + smooth) / (rows[0] + 2 * smooth)
    q = (negative + smooth) / (rows[1] + 2 * smooth)
    return np.where(positive + negative > 0, np.log(p / q), 0.0)


def fit_hinge(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, c: float = 1.0,
              epochs: int = 20, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|²/2 + c Σ max(0, 1 - y (w·x + b)), by dual coordinate
    descent in a seeded order. x is a row's ratios over the root of their number; the
    classes weigh equally."""
    y = np.where(labels == 1, 1.0, -1.0)
    share = np.array([(y < 0).mean(), (y > 0).mean()])
    top = c * np.where(y > 0, share[0], share[1]) * 2
    # Rows stay lists of features: scaled = w * ratio is what a margin sums, and what a
    # step adds to it goes with the square of the ratio.
    square, scaled = ratio * ratio, np.zeros(len(ratio))
    root = np.array([np.sqrt(max(len(r), 1)) for r in rows])
    norm = np.array([square[r].sum() / n ** 2 + 1.0 for r, n in zip(rows, root)])
    b, alpha = 0.0, np.zeros(len(y))
    order, rng = np.arange(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            gradient = y[i] * (scaled[rows[i]].sum() / root[i] + b) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), top[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                scaled[rows[i]] += step * y[i] / root[i] * square[rows[i]]
                b += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return scaled, b


def fit_scale(margin: np.ndarray, labels: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(a, b) of the logistic curve through margins of rows the model has not seen, by
    Newton's method on smoothed labels."""
    n1, n0 = (labels == 1).sum(), (labels != 1).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.column_stack([margin, np.ones_like(margin)]), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * beta)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> Model:
    """The model of all rows, its curve from margins of five folds that were left out.
    Rows of one class only, or none, give a model that says that class, or one half."""
    n1 = int((labels == 1).sum())
    if len(labels) < 10 or n1 < 5 or len(labels) - n1 < 5:
        p = (n1 + 1) / (len(labels) + 2)
        return Model(np.zeros(len(ratio)), 0.0, (1.0, float(np.log(p / (1 - p)))))
    margin = np.zeros(len(rows))
    for fold in range(5):
        out = np.arange(len(rows)) % 5 == fold
        w, b = fit_hinge([r for r, o in zip(rows, out) if not o], labels[~out], ratio)
        margin[out] = [w[r].sum() / np.sqrt(max(len(r), 1)) + b for r, o in zip(rows, out) if o]
    w, b = fit_hinge(rows, labels, ratio)
    return Model(w, b, fit_scale(margin, labels))


_COUNTED = T.StructType([
    T.StructField("feature", T.IntegerType()), T.StructField("positive", T.LongType()), T.StructField("negative", T.LongType()),
    T.StructField("draw", T.DoubleType()), T.StructField("label", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.IntegerType()))])


def _counted(rows: DataFrame, fraction: float) -> DataFrame:
    """From (draw, label, text): a row per feature of each task with its counts by
    class, one (feature -1) with the rows by class, and the features of the rows whose
    draw is below ``fraction``."""
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        counts, totals = np.zeros((2, DIMENSIONS), np.int64), np.zeros(2, np.int64)
        names = _COUNTED.names
        types = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.int32())]
        for table in tables:
            draw, label = (table.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for a, b, texts in tx.batches(table.column(2)):
                doc, feature = features(texts)
                for klass in (0, 1):
                    mine = label[a:b] == klass
                    totals[klass] += mine.sum()
                    counts[klass] += np.bincount(feature[mine[doc]], minlength=DIMENSIONS)
                lists = np.split(feature.astype(np.int32), np.searchsorted(doc, np.arange(1, b - a)))
                for i in np.flatnonzero(draw[a:b] < fraction):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in zip((None, None, None, draw[a + i], label[a + i], lists[i]), types)],
                        names=names)
        seen = np.flatnonzero(counts.any(axis=0))
        out = [np.concatenate([[-1], seen]), np.concatenate([totals[1:], counts[1][seen]]),
               np.concatenate([totals[:1], counts[0][seen]])]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x).cast(t) for x, t in zip(out, types)), *(pa.nulls(len(out[0]), t) for t in types[3:])], names=names)

    return rows.mapInArrow(run, _COUNTED)


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
          learn_from: Column | None = None, sample: int = SAMPLE) -> Model:
    """The model for ``label`` (0 or 1; other values and null are left out).

    ``learn_from`` is a condition on the key. A key labelled more than once counts with
    its lowest label, a document that occurs more than once as often as it occurs.
    Class counts of features cover all labelled documents and are summed by Spark; only
    their sums, bounded by the hash space, and ``sample`` rows at most reach the driver.
    """
    labels = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(
        F.min(label).cast("int").alias("label"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if learn_from is not None:
        labels, rows = (x.withColumnRenamed("key", key).where(learn_from).withColumnRenamed(key, "key")
                        for x in (labels, rows))
    fraction = sample / max(labels.count(), 1)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), "key", "text"), 11).cast("double") / float(1 << 53)
    # Labels are as many as documents: both sides are sorted, however small the table, so
    # that little data runs the plan that much data gets. AQE splits a skewed key.
    labelled = rows.hint("merge").join(labels, "key").select(draw.alias("draw"), "label", "text")
    found = frames.saved(_counted(labelled, fraction), "class-counts")
    counts = found.where("feature is not null").groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative")).toArrow()
    feature, positive, negative = (c.to_numpy() for c in counts.columns)
    by_class = np.zeros((2, DIMENSIONS))
    real = feature >= 0
    by_class[0][feature[real]], by_class[1][feature[real]] = negative[real], positive[real]
    totals = int(positive[~real].sum()), int(negative[~real].sum())
    chosen = found.where("features is not null").select("draw", "label", "features").orderBy("draw").limit(sample).toArrow()
    lists = chosen.column("features").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    return fit([flat[a:b] for a, b in zip(at, at[1:])], chosen.column("label").to_numpy(),
               log_count_ratio(by_class[1], by_class[0], totals))


def scored(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1, of every whole text; null
    counts as empty, and an empty text has the score of a text without features."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for table in tables:
            for a, b, texts in tx.batches(table.column(1)):
                yield pa.RecordBatch.from_arrays([table.column(0).slice(a, b - a), pa.array(model.scores(texts))],
                                                 names=schema.names)

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores at least ``threshold``."""
    at = docs.columns.index(text)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for table in tables:
            scores = [model.scores(texts) for _, _, texts in tx.batches(table.column(at))]
            if scores:
                yield table.filter(pa.array(np.concatenate(scores) >= threshold))

    return docs.mapInArrow(run, docs.schema)
