"""SentencePiece models run by the tokenizers library.

The model file is read as protobuf; its normaliser, white-space marker, scores or
merge ranks and byte fallback are rebuilt as a ``tokenizers.Tokenizer``. Ids are those
that SentencePiece itself gives, which the operator can verify text by text.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import text as tx
from tillflow.llm import vocab

MARK = "▁"
# Piece types and model types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and raw values of one protobuf message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"not a model file: wire type {kind}")
        yield number, value


def read_model(path: str) -> Model:
    with open(path, "rb") as f:
        data = f.read()
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = {1: b"", 2: b"\0" * 4, 3: NORMAL} | dict(_fields(value))
            model.pieces.append((piece[1].decode("utf-8"), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(_fields(value))
            model.model_type = spec.get(3, UNIGRAM)
            model.byte_fallback = bool(spec.get(35, 0))
            if spec.get(24):
                raise ValueError("white space as a suffix is not supported")
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix = bool(spec.get(3, 1))
            model.squeeze = bool(spec.get(4, 1))
            if not spec.get(5, 1):
                raise ValueError("unescaped white space is not supported")
    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def splits_at_spaces(model: Model) -> bool:
    """No piece runs from a word into the white space after it, so text may be cut
    before each run of white space without changing its pieces."""
    return not any(a != MARK and b == MARK for p, _, _ in model.pieces for a, b in zip(p, p[1:]))


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every way to make a normal piece of two, best score first. Of equal scores the
    one with the longer left part goes first: pieces then grow from the left."""
    ranked = []
    usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    for piece, score in usable.items():
        for cut in range(len(piece) - 1, 0, -1):
            if piece[:cut] in usable and piece[cut:] in usable:
                ranked.append((-score, -cut, len(ranked), (piece[:cut], piece[cut:])))
    return [pair for *_, pair in sorted(ranked)]


def build(model: Model):
    """The tokenizer; each text is encoded as SentencePiece encodes it."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.model_type == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    else:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model),
                          unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if splits_at_spaces(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    return build(read_model(path))


@lru_cache(maxsize=2)
def loaded(path: str, threads: int):
    """(encode, whether texts come back, spans) of a worker process. The library's
    thread pool is made at its first use, so the number of threads is set before."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    model, tokenizer = read_model(path), _tokenizer(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def returns(texts: list[str], ids: list[list[int]]) -> list[bool]:
        return [x == y for x, y in zip(tokenizer.decode_batch(ids, skip_special_tokens=False), texts)]

    exact = splits_at_spaces(model) and model.dummy_prefix and not model.charsmap and not model.squeeze
    return encode, returns, vocab.SpanIds(encode, test=returns) if exact else None


tx.kept += [loaded.cache_clear, _tokenizer.cache_clear]


def encode_texts(texts: tx.Texts, path: str, threads: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a batch, how many each text has, and whether they decode to the text.

    Where the model allows it, texts are cut at single spaces, which the dummy prefix
    of each part stands for; equal parts are then encoded, and decoded again, once, and
    a text of any length is many short parts. Each part but the first starts with the
    marker, which decodes to the space between the parts, so a text comes back if all
    its parts do.
    """
    encode, returns, spans = loaded(path, threads)
    if spans is not None:
        parts = vocab.between_single_spaces(texts)
        ids, count, back = spans.tested(parts)
        return ids, vocab.per_text(parts, count), vocab.per_text(parts, ~back) == 0
    whole = tx.Words(texts, texts.offsets[:-1], texts.offsets[1:]).strings(np.arange(len(texts)))
    lists = encode(whole)
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum())), count, np.array(returns(whole, lists), bool)


def _same(ids: np.ndarray, count: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    """Text by text, whether the ids are those of the lists."""
    own = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(own.sum()))
    if (own == count).all():
        wrong = np.repeat(np.arange(len(count)), count)[flat != ids]
        return np.bincount(wrong, minlength=len(count)) == 0
    return np.array([np.array_equal(x, y) for x, y in zip(np.split(ids, np.cumsum(count)[:-1]),
                                                          np.split(flat, np.cumsum(own)[:-1]))], bool)


def encoded(docs: DataFrame, model: str, *, key: str = "doc_id", text: str = "text", verify: bool = True,
            threads: int = 2) -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (array of int), ``n_tokens``, and with
    ``verify`` also ``parity`` (SentencePiece gives the same ids) and ``round_trip``
    (the ids decode to the text).

    Null text counts as empty: no ids. Equal rows give equal rows, an empty table an
    empty one. A text that holds U+2581 itself decodes to a space in its place, as in
    SentencePiece, so its round trip is false.
    """
    fields = [T.StructField("doc_id", docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
              T.StructField("n_tokens", T.LongType())]
    if verify:
        fields += [T.StructField("parity", T.BooleanType()), T.StructField("round_trip", T.BooleanType())]

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if verify:
            import sentencepiece

            own = sentencepiece.SentencePieceProcessor(model_file=model)
        for table in tables:
            for a, b, texts in tx.batches(table.column(1), 1 << 20):
                ids, count, back = encode_texts(texts, model, threads)
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                out = [table.column(0).slice(a, b - a),
                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                       pa.array(count)]
                if verify:
                    whole = tx.Words(texts, texts.offsets[:-1], texts.offsets[1:]).strings(np.arange(len(texts)))
                    out += [pa.array(_same(ids, count, own.encode(whole, num_threads=threads))), pa.array(back)]
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def decoded(tokens: DataFrame, model: str, *, key: str = "doc_id", ids: str = "ids", threads: int = 2) -> DataFrame:
    """``doc_id`` and ``text`` from arrays of ids; null ids give a null text."""
    schema = T.StructType([T.StructField("doc_id", tokens.schema[key].dataType), T.StructField("text", T.StringType())])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(model)
        for table in tables:
            for first in range(0, table.num_rows, 256):
                part = table.slice(first, 256)
                lists = part.column(1).to_pylist()
                texts = tokenizer.decode_batch([x or [] for x in lists], skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([t if x is not None else None for t, x in zip(texts, lists)], pa.string())],
                    names=schema.names)

    return tokens.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, schema)
