"""Token ids as Arrow files of equal-length sequences.

A file in Arrow's IPC file format holds fixed-size lists of ids and of a mask, a fixed
number of sequences to a batch, so sequence i lies in batch i // n at i % n and is read
through a memory map without a copy or a parse. Documents follow each other in
ascending key order, each closed by an end id, and run over sequence borders; the last
sequence of a file is filled up with masked zeros. Beside each file lies its index:
keys and lengths of its documents.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames, vocab
from tillflow.llm import text as tx

SEQUENCE, PER_BATCH = 2048, 128

# Fixed value: the split of tokenizers whose words do not touch each other.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _word_by_word(path: str) -> bool:
    """Whether this tokenizer encodes a text as the words and marks in it, one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    plain = all(not (t["lstrip"] or t["rstrip"] or " " in t["content"]) and t["content"].startswith("<|")
                for t in spec.get("added_tokens", []))
    names = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (first.get("type") == "Split" and first["pattern"].get("Regex") == WORD_SPLIT and first.get("invert")
            and first.get("behavior") == "Removed" and names == ["NFC", "Replace", "Lowercase"] and plain)


@lru_cache(maxsize=2)
def _loaded(path: str):
    from tokenizers import Tokenizer

    # Spark has a task for every core already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode, vocab.SpanIds(encode) if _word_by_word(path) else None


def encode_texts(texts: tx.Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and how many each text has."""
    encode, spans = _loaded(path)
    if spans is not None:
        # Added tokens would be torn at their marks; a batch that may hold one is cut
        # at white space only.
        torn = np.any((texts.data[:-1] == ord("<")) & (texts.data[1:] == ord("|")))
        # The tokenizer lower-cases; words that differ in case only are encoded once.
        parts = texts.words if torn else vocab.words_and_marks(texts.lowered())
        ids, count = spans(parts)
        return ids, vocab.per_text(parts, count)
    whole = tx.Words(texts, texts.offsets[:-1], texts.offsets[1:])
    lists = encode(whole.strings(np.arange(len(texts))))
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for ids in lists for i in ids), np.uint32, int(count.sum())), count


def closed(ids: np.ndarray, count: np.ndarray, end: int) -> np.ndarray:
    """The ids with the end id after each text."""
    out = np.full(len(ids) + len(count), end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count)] = ids
    return out


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder: a local mount, HDFS or an object store."""
    return pafs.FileSystem.from_uri(path)


class SequenceWriter:
    """Writes a run of ids as equal-length sequences, a batch at a time."""

    def __init__(self, path: str, dtype: np.dtype, length: int = SEQUENCE, per_batch: int = PER_BATCH):
        fs, place = _filesystem(path)
        self.dtype, self.length, self.step = np.dtype(dtype), length, length * per_batch
        self.schema = pa.schema({"ids": pa.list_(pa.from_numpy_dtype(self.dtype), length),
                                 "mask": pa.list_(pa.bool_(), length)})
        self.sink = fs.open_output_stream(place)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.rest: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.rest.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.step:
            run = np.concatenate(self.rest)
            whole = len(run) // self.step * self.step
            for at in range(0, whole, self.step):
                self._batch(run[at:at + self.step], self.step)
            self.rest, self.held = [run[whole:]], len(run) - whole

    def _batch(self, ids: np.ndarray, valid: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:valid] = True
        self.file.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            run = np.concatenate(self.rest)
            filled = np.zeros(-(-len(run) // self.length) * self.length, self.dtype)
            filled[:len(run)] = run
            self._batch(filled, len(run))
        self.file.close()
        self.sink.close()


class SequenceFile:
    """Random access to a written file; a local one is memory-mapped."""

    def __init__(self, path: str):
        fs, place = _filesystem(path)
        self.source = pa.memory_map(place) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(place)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.per_batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0

    def __len__(self) -> int:
        batches = self.file.num_record_batches
        return (batches - 1) * self.per_batch + self.file.get_batch(batches - 1).num_rows if batches else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask (a bit each) of sequence i, views of the file."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, at = self.file.get_batch(i // self.per_batch), i % self.per_batch
        ids, mask = (batch.column(c).slice(at, 1).flatten() for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def runs(self) -> Iterator[np.ndarray]:
        """All unmasked ids, batch by batch."""
        for b in range(self.file.num_record_batches):
            batch = self.file.get_batch(b)
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            mask = batch.column(1).flatten()
            yield ids if mask.true_count == len(mask) else ids[mask.to_numpy(zero_copy_only=False)]


MANIFEST = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("path", T.StringType()), T.StructField("index_path", T.StringType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType())])


def written(docs: DataFrame, tokenizer: str, end: int, *, key: str = "doc_id", text: str = "text",
            length: int = SEQUENCE, folder: str | None = None) -> DataFrame:
    """Writes the files and returns their manifest: ``part`` (order of the files),
    ``path``, ``index_path``, ``n_docs``, ``n_tokens``, ``start`` (ids before the file).

    Documents are range-sorted by key, ties by a hash of the text; a null key comes
    first, a null text counts as empty and gives the end id alone. Each task writes one
    file under a name of its own and the manifest names those of the tasks that
    counted, so a repeated task leaves no doubles. An empty table writes no file.
    """
    from tillflow.session import shared_dir

    folder = folder or shared_dir(docs.sparkSession, "token-files")
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([end, *spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
    dtype = "uint16" if top < 1 << 16 else "uint32"
    kind = pa.int64() if isinstance(docs.schema[key].dataType, T.LongType) else pa.string()

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, index = TaskContext.get().partitionId(), None, None
        n_docs = 0
        for table in tables:
            for a, b, texts in tx.batches(table.column(1)):
                if out is None:
                    name = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}"
                    fs, place = _filesystem(folder)
                    fs.create_dir(place, recursive=True)
                    out = SequenceWriter(f"{name}.arrow", dtype, length)
                    schema = pa.schema({"key": kind, "n_tokens": pa.int64()})
                    held = _filesystem(f"{name}.index.arrow")
                    sink = held[0].open_output_stream(held[1])
                    index = pa.ipc.new_file(sink, schema)
                ids, count = encode_texts(texts, tokenizer)
                out.add(closed(ids, count, end))
                n_docs += b - a
                index.write_batch(pa.RecordBatch.from_arrays(
                    [table.column(0).slice(a, b - a).cast(kind), pa.array(count + 1)], schema=schema))
        if out is not None:
            out.close()
            index.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": f"{name}.arrow", "index_path": f"{name}.index.arrow",
                                               "n_docs": n_docs, "n_tokens": out.total}],
                                             schema=pa.schema([("part", pa.int64()), ("path", pa.string()), ("index_path", pa.string()),
                                                               ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    keys = F.col(key) if kind == pa.int64() else F.col(key).cast("string")
    rows = docs.select(keys.alias("key"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("key", tie).sortWithinPartitions("key", tie)
    files = frames.saved(rows.mapInArrow(run, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_back(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the files: ``key``, ``start`` (ids of all
    documents before it), ``n_tokens`` with the end id, ``ids_crc32`` of the ids as
    little-endian unsigned 32-bit integers. A file is read by one task, a batch at a
    time."""
    files = manifest.count()
    sample = manifest.select("index_path").first()
    kind = pa.int64()
    if sample:
        fs, place = _filesystem(sample[0])
        with fs.open_input_file(place) as f:
            kind = pa.ipc.open_file(f).schema.field("key").type
    schema = T.StructType([T.StructField("key", T.LongType() if kind == pa.int64() else T.StringType()),
                           *(T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32"))])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for row in table.to_pylist():
                fs, place = _filesystem(row["index_path"])
                with fs.open_input_file(place) as f:
                    index = pa.ipc.open_file(f).read_all()
                counts = index.column("n_tokens").to_numpy()
                ends = np.cumsum(counts)
                sums, doc, at, crc = np.zeros(len(counts), np.int64), 0, 0, 0
                for ids in SequenceFile(row["path"]).runs():
                    data, first = memoryview(ids.astype("<u4").tobytes()), at
                    at += len(ids)
                    while doc < len(ends) and ends[doc] <= at:
                        begin = max(ends[doc] - counts[doc], first)
                        sums[doc] = zlib.crc32(data[4 * (begin - first):4 * (ends[doc] - first)], crc)
                        doc, crc = doc + 1, 0
                    if doc < len(ends) and ends[doc] - counts[doc] < at:
                        begin = max(ends[doc] - counts[doc], first)
                        crc = zlib.crc32(data[4 * (begin - first):], crc)
                yield pa.RecordBatch.from_arrays(
                    [index.column("key").combine_chunks(), pa.array(row["start"] + ends - counts), pa.array(counts),
                     pa.array(sums)], names=schema.names)

    spread = manifest.select("index_path", "path", "start").repartition(max(files, 1))
    return spread.mapInArrow(run, schema)
