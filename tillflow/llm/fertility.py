"""Quality rules from tokeniser fertility.

A public vocabulary tells how ordinary a text is: characters per token fall for
gibberish, shouting and foreign script, the share of tokens spelt out byte by byte
rises for characters the vocabulary lacks, and the entropy of the tokens falls for
repetition. Each measure has a limit per language and length of text, computed over all
documents; a text beyond one of its limits is rejected. A few counts of the text itself
are taken in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames, pieces, vocab
from tillflow.llm import text as tx

WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_token", "fallback_share", "token_entropy")


@dataclass(frozen=True)
class Band:
    """Limits of a language, ends included. Entropy is in bits per token; a text of n
    tokens cannot exceed log2(n), so its lower limit is a share of that, too."""

    chars_per_token: tuple[float, float]
    fallback_share: tuple[float, float]
    entropy_of_log: tuple[float, float]


#: Where no limits can be computed, and the ends that the rule leaves open.
ANY = Band((1.0, 12.0), (0.0, 0.5), (0.4, 1.0))
#: A limit lies so many quartile ranges beyond the quartile on the suspicious side, and
#: the range counts as so much at least: copies of one text would leave it no width.
FENCES: Mapping[str, tuple[float, float]] = {
    "chars_per_token": (2.0, 0.04), "fallback_share": (2.0, 0.05), "entropy_of_log": (1.5, 0.02)}
#: Texts that quartiles are taken from, at least.
LEAST_TEXTS = 30
_LIMITS = ("least_chars", "most_fallback", "least_entropy")


def _per_doc(texts: tx.Texts, mask: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]


def text_counts(texts: tx.Texts) -> list[np.ndarray]:
    """The five counts of every text of a batch."""
    words, n = texts.words, len(texts)
    spaces = tx.is_space(texts.data)
    chars = _per_doc(texts, ~spaces & ((texts.data & 0xC0) != 0x80))
    symbols = _per_doc(texts, _SYMBOL[texts.data])

    lines = texts.lines
    has_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    line_key = tx.mix(lines.hash + lines.doc.astype(np.uint64) * tx.STEP)[has_word]
    repeated = lines.doc[has_word][~tx.first_of_each(line_key)]

    windows, at = words.windows(WINDOW)
    key = tx.mix(windows + words.doc[at].astype(np.uint64) * tx.STEP)
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    begins = at[count[which.reshape(-1)] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    edges[begins] += 1
    np.subtract.at(edges, begins + WINDOW, 1)
    inside = np.cumsum(edges)[:-1] > 0
    return [words.per_doc, chars, symbols, np.bincount(repeated, minlength=n),
            np.bincount(words.doc[inside], minlength=n)]


def token_measures(texts: tx.Texts, model: str, threads: int = 1) -> list[np.ndarray]:
    """Characters per token, byte-fallback share and token entropy of the words of
    every text; a text without words has 0 in all."""
    words, n = texts.words, len(texts)
    spans, is_byte = _loaded(model, threads)
    ids, count = spans(words)
    tokens = vocab.per_text(words, count)
    doc = np.repeat(words.doc, count)
    some = np.maximum(tokens, 1)
    chars = _per_doc(texts, ~tx.is_space(texts.data) & ((texts.data & 0xC0) != 0x80))
    fallback = np.bincount(doc, weights=is_byte[ids], minlength=n) / some
    key, each = tx.distinct(doc * len(is_byte) + ids)
    spent = np.bincount(key // len(is_byte), weights=each * np.log2(each), minlength=n)
    return [chars / some, fallback, np.where(tokens > 0, np.log2(some) - spent / some, 0.0), tokens]


_spans: dict[str, tuple] = {}


def _loaded(model: str, threads: int) -> tuple[vocab.SpanIds, np.ndarray]:
    """The encoder of single words, and which ids are byte tokens."""
    if model not in _spans:
        encode, _, _ = pieces.loaded(model, threads)
        kinds = np.array([kind for *_, kind in pieces.read_model(model).pieces])
        _spans[model] = vocab.SpanIds(encode), kinds == pieces.BYTE
    return _spans[model]


def measured(docs: DataFrame, model: str, *, key: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, ``language``, the five counts, the three
    measures and ``n_tokens``. Null text counts as empty; all is 0 for it. Map only."""
    fields = [T.StructField("doc_id", docs.schema[key].dataType), T.StructField("language", T.StringType()),
              *(T.StructField(c, T.LongType()) for c in COUNTS), *(T.StructField(m, T.DoubleType()) for m in MEASURES),
              T.StructField("n_tokens", T.LongType())]

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for a, b, texts in tx.batches(table.column(2)):
                columns = [*(x.astype(np.int64) for x in text_counts(texts)), *token_measures(texts, model)]
                yield pa.RecordBatch.from_arrays(
                    [table.column(0).slice(a, b - a), table.column(1).slice(a, b - a), *map(pa.array, columns)],
                    names=[f.name for f in fields])

    spoken = F.col(language) if language in docs.columns else F.lit(None)
    rows = docs.select(F.col(key).alias("doc_id"), spoken.cast("string").alias("language"), F.col(text).alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _entropy_of_log() -> Column:
    return F.col("token_entropy") / F.log2(F.greatest(F.col("n_tokens"), F.lit(2)))


def _length_class() -> Column:
    """Binary digits of the number of tokens."""
    return F.length(F.bin("n_tokens"))


def _inside(band: Band) -> Column:
    return (F.col("chars_per_token").between(*band.chars_per_token)
            & F.col("fallback_share").between(*band.fallback_share)
            & _entropy_of_log().between(*band.entropy_of_log))


def limits(rows: DataFrame) -> DataFrame:
    """``language``, ``length_class``, ``least_chars``, ``most_fallback`` and
    ``least_entropy`` from ``measured`` rows that pass the base rules.

    Quartiles are exact, of the measures in thousandths, over all texts of a language (null
    is one) with as many binary digits in the number of their tokens. A class of under 30
    texts has the limits of all languages at that length; if these are under 30, null.
    """
    own = ["chars_per_token", "fallback_share", "entropy_of_log"]
    texts = rows.where(~base_failed()).select("language", _length_class().alias("length_class"), *own[:2],
                                              _entropy_of_log().alias(own[2]))

    def fenced(keys: list[str], prefix: str) -> DataFrame:
        quartiles = texts.groupBy(*keys).agg(
            F.count("*").alias("n"), *(F.percentile(F.round(m, 3), [0.25, 0.75]).alias(m) for m in own))

        def fence(measure: str, side: int) -> Column:
            beyond, least = FENCES[measure]
            spread = beyond * F.greatest(F.col(measure)[1] - F.col(measure)[0], F.lit(least))
            return F.when(F.col("n") >= LEAST_TEXTS, F.col(measure)[1] + spread if side else F.col(measure)[0] - spread)

        return quartiles.select(*keys, *(fence(m, side).alias(prefix + name) for m, side, name in zip(own, (0, 1, 0), _LIMITS)))

    both = fenced(["language", "length_class"], "").join(fenced(["length_class"], "any_"), "length_class")
    return both.select("language", "length_class", *(F.coalesce(x, "any_" + x).alias(x) for x in _LIMITS))


def judged(docs: DataFrame, model: str, *, bands: Mapping[str, Band] | None = None, other: Band = ANY, **columns) -> DataFrame:
    """``measured`` with ``base_failed`` (under 20 words, or over 30 % of the words in
    repeated windows) and ``kept`` (not that, and every measure within its limits).

    The limits are those of ``limits`` over all rows, ``other`` where these are null and at
    the ends they leave open; or, if given, fixed ``bands`` by language, and ``other`` for
    a language without a band, or null.
    """
    rows = measured(docs, model, **columns)
    if bands is not None:
        verdict = F.lit(False)
        for name, band in bands.items():
            verdict = verdict | ((F.col("language") == name) & _inside(band))
        named = F.coalesce(F.col("language").isin(*bands), F.lit(False)) if bands else F.lit(False)
        verdict = F.when(named, verdict).otherwise(_inside(other))
        rows = rows.withColumn("base_failed", base_failed())
        return rows.withColumn("kept", ~F.col("base_failed") & verdict)

    rows = frames.saved(rows, "fertility")
    found = frames.saved(limits(rows), "fertility-limits").select(
        F.col("language").alias("__language"), F.col("length_class").alias("__class"), *_LIMITS)
    joined = rows.join(found, F.col("language").eqNullSafe(F.col("__language")) & (_length_class() == F.col("__class")), "left")

    def limit(name: str, otherwise: float) -> Column:
        return F.coalesce(F.col(name), F.lit(otherwise))

    verdict = (F.col("chars_per_token").between(limit("least_chars", other.chars_per_token[0]), other.chars_per_token[1])
               & F.col("fallback_share").between(other.fallback_share[0], limit("most_fallback", other.fallback_share[1]))
               & _entropy_of_log().between(limit("least_entropy", other.entropy_of_log[0]), other.entropy_of_log[1]))
    return joined.select(*rows.columns, base_failed().alias("base_failed"), (~base_failed() & verdict).alias("kept"))
