"""Near duplicates by DartMinHash signatures, banded joining and exact checks.

A document is a weighted set of word shingles. Over each element lies a strip as wide
as its weight; a Poisson process of hashed darts, the same for every document, covers
the plane of weight and rank. A document sees the darts that fall into its strips up to
a rank, each dart belongs to one of k coordinates, and the earliest dart of each
coordinate is the signature. Two documents agree in a coordinate with the probability
of their weighted Jaccard similarity. The work for a document is its elements plus
k ln k + 2k darts, instead of k times its elements.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import frames
from tillflow.llm import text as tx

WORDS, SIMILARITY = 5, 0.8
#: Bands and their rows: at a similarity of 0.8 all bands miss once in 17,000 pairs.
BANDS, ROWS = 32, 6
#: Coordinates of the long sketch of texts whose buckets are not settled by one text.
LONG = 1536
#: A pair is passed over if its sketches agree this many standard deviations too seldom.
DEVIATIONS = 4.5
#: A dart's cell in units of weight times rank: up to here cells double, then they are 1.
_FIRST = 2.0 ** -6
#: Darts held at once.
_DARTS_AT_ONCE = 1 << 19
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_UNIT = 1.0 / (1 << 53)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * _UNIT


def _poisson_cdf(area: float) -> np.ndarray:
    terms = [math.exp(-area) * area ** n / math.factorial(n) for n in range(16)]
    return np.minimum(np.cumsum(terms), 1.0)


def shingles(texts: tx.Texts, n: int = WORDS, weights: str = "count") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of the distinct shingles, weighted by their count in the
    text or, with ``weights="set"``, by 1. A text of fewer words than n has one, of all
    its words; one without words has none."""
    words = texts.words
    hashes, at = words.windows(n)
    doc = words.doc[at]
    short = np.flatnonzero((words.per_doc > 0) & (words.per_doc < n))
    if len(short):
        ends = np.cumsum(words.per_doc)
        first = (ends - words.per_doc)[short]
        h = np.full(len(short), 77, np.uint64)
        for i in range(n - 1):
            has = words.per_doc[short] > i
            h[has] = tx.mix(h[has] * np.uint64(31) + words.hash[first[has] + i])
        hashes, doc = np.concatenate([hashes, h]), np.concatenate([doc, short])
    own = tx.mix(hashes + doc.astype(np.uint64) * tx.STEP)
    _, index, count = np.unique(own, return_index=True, return_counts=True)
    weight = count.astype(np.float64) if weights == "count" else np.ones(len(index))
    return doc[index], hashes[index], weight


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int,
               seed: int = 1) -> np.ndarray:
    """n_docs rows of k values; documents without elements keep the value of none.

    Weights are any positive numbers. The rank is doubled for those documents that have
    a coordinate without a dart, until none is left.
    """
    darts = k * math.log(k) + 2 * k
    out = np.full((n_docs, k), _NONE)
    order = np.argsort(doc, kind="stable")
    doc, element, weight = doc[order], element[order], weight[order]
    # A document throws as many darts whatever its length, so runs are bounded by documents.
    run = max(int(_DARTS_AT_ONCE / darts), 1)
    ends = np.searchsorted(doc, np.arange(0, n_docs + run, run))
    for first, a, b in zip(range(0, n_docs, run), ends, ends[1:]):
        _sign(out[first:first + run], doc[a:b] - first, element[a:b], weight[a:b], darts, k, seed)
    return out


def _sign(out: np.ndarray, doc: np.ndarray, element: np.ndarray, weight: np.ndarray, darts: float, k: int,
          seed: int) -> None:
    total = np.bincount(doc, weights=weight, minlength=len(out))
    rank = np.divide(darts, total, out=np.zeros(len(out)), where=total > 0)
    while len(doc):
        _throw(out, doc, element, weight, rank, k, seed)
        open_docs = (out == _NONE).any(axis=1)
        rank = rank * 2
        more = open_docs[doc]
        doc, element, weight = doc[more], element[more], weight[more]


def _throw(out: np.ndarray, doc: np.ndarray, element: np.ndarray, weight: np.ndarray, rank: np.ndarray, k: int,
           seed: int) -> None:
    """Throws all darts up to each document's rank. Strips of weight are 0 to 1, 1 to 2,
    2 to 4, 4 to 8 …; the cells of a strip are equally large in every strip."""
    strip = 0
    while len(doc):
        low, width = (0.0, 1.0) if strip == 0 else (2.0 ** (strip - 1), 2.0 ** (strip - 1))
        inside = weight > low
        doc, element, weight = doc[inside], element[inside], weight[inside]
        reach = rank[doc] * width
        base = tx.mix(element + np.uint64((seed * 64 + strip) * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF))
        lo, cell = 0.0, 0
        while lo < 1.0:
            hi = _FIRST if lo == 0 else 2 * lo
            near = np.flatnonzero(reach > lo)
            if not len(near):
                break
            h = tx.mix(base[near] + np.uint64(cell * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF))
            _land(out, doc, weight, rank, near, h, np.full(1, lo), hi - lo, low, width, k)
            lo, cell = hi, cell + 1
        near = np.flatnonzero(reach > 1.0)
        if len(near):
            cells = np.ceil(reach[near]).astype(np.int64) - 1
            which = np.repeat(near, cells)
            at = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
            h = tx.mix(base[which] + (at + cell).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
            _land(out, doc, weight, rank, which, h, 1.0 + at, 1.0, low, width, k)
        strip += 1


def _land(out, doc, weight, rank, which, h, lo, area, low, width, k) -> None:
    """The darts of one cell of each element named by ``which``."""
    cdf = _poisson_cdf(area)
    u = _uniform(h)
    hit = np.flatnonzero(u >= cdf[0])
    if not len(hit):
        return
    count = np.searchsorted(cdf, u[hit], "right")
    lo = np.broadcast_to(lo, len(h))[hit]
    own, seeds = np.repeat(which[hit], count), np.repeat(h[hit], count)
    lo = np.repeat(lo, count)
    number = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    dart = tx.mix(seeds + (number + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    r = (lo + area * _uniform(dart)) / width
    w = low + width * _uniform(tx.mix(dart + np.uint64(1)))
    which_k = tx.mix(dart + np.uint64(2))
    seen = (w < weight[own]) & (r <= rank[doc[own]])
    # Rank first, then the dart's own bits: the smallest value is the earliest dart.
    value = (r.view(np.uint64) & ~np.uint64(0xFFFFFF)) | (dart & np.uint64(0xFFFFFF))
    slot = doc[own] * k + (which_k % np.uint64(k)).astype(np.int64)
    np.minimum.at(out.reshape(-1), slot[seen], value[seen])


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(tx.draws(bands, 5), (len(signature), bands)).copy()
    cut = signature.reshape(len(signature), bands, rows)
    for i in range(rows):
        keys = tx.mix(keys * np.uint64(0xD1342543DE82EF95) + cut[:, :, i])
    return keys.view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, 32 coordinates to a long."""
    k = signature.shape[1]
    bits = tx.mix(signature) & np.uint64(3)
    padded = np.zeros((len(signature), -(-k // 32) * 32), np.uint64)
    padded[:, :k] = bits
    shifts = (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(padded.reshape(len(signature), -1, 32) << shifts, axis=2).view(np.int64)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]),
                                    pa.array(rows.reshape(-1)))


_SIGNED = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.DoubleType()),
                        T.StructField("bands", T.ArrayType(T.LongType())),
                        T.StructField("sketch", T.ArrayType(T.LongType()))])


def signed(texts: DataFrame, *, weights: str = "count", words: int = WORDS, bands: int = BANDS,
           rows: int = ROWS) -> DataFrame:
    """node, n (total weight), bands, sketch of (node, text) rows that have words."""
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for table in tables:
            nodes = table.column(0)
            for a, b, batch in tx.batches(table.column(1)):
                doc, element, weight = shingles(batch, words, weights)
                total = np.bincount(doc, weights=weight, minlength=len(batch))
                full = np.flatnonzero(total > 0)
                sign = signatures(doc, element, weight, len(batch), bands * rows)[full]
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(a, b - a).take(pa.array(full)), pa.array(total[full]),
                     _lists(band_keys(sign, bands, rows)), _lists(sketch(sign))], names=_SIGNED.names)

    return texts.mapInArrow(run, _SIGNED)


def sketched(texts: DataFrame, coordinates: int = LONG, *, weights: str = "count", words: int = WORDS) -> DataFrame:
    """node and a sketch of that many coordinates of (node, text) rows."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("long_sketch", T.ArrayType(T.LongType()))])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for table in tables:
            for a, b, batch in tx.batches(table.column(1)):
                doc, element, weight = shingles(batch, words, weights)
                sign = signatures(doc, element, weight, len(batch), coordinates, seed=2)
                yield pa.RecordBatch.from_arrays([table.column(0).slice(a, b - a), _lists(sketch(sign))], names=schema.names)

    return texts.select("node", "text").mapInArrow(run, schema)


def _most_apart(coordinates: int, at_least: float) -> int:
    """The coordinates in which two texts that similar may disagree: of two bits, one
    pair in four agrees by chance."""
    same = at_least + (1 - at_least) / 4
    return int(coordinates * (1 - same) + DEVIATIONS * math.sqrt(coordinates * same * (1 - same)))


def _runs_of_bytes(table: pa.RecordBatch, columns: tuple[int, ...], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts in these columns have about that many bytes; a longer row alone."""
    size = sum(np.asarray(pc.fill_null(pc.binary_length(table.column(c)), 0)).astype(np.int64) for c in columns)
    ends, first = np.cumsum(size), 0
    while first < len(ends):
        before = ends[first] - size[first]
        last = max(int(np.searchsorted(ends, before + limit, "right")), first + 1)
        yield first, last
        first = last


def similarity(pairs: DataFrame, *, weights: str = "count", words: int = WORDS) -> DataFrame:
    """(a, b, similarity): exact weighted Jaccard of rows (a, b, text_a, text_b)."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                           T.StructField("similarity", T.DoubleType())])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for table in tables:
            for first, last in _runs_of_bytes(table, (2, 3)):
                part = table.slice(first, last - first)
                sides = []
                for column in (2, 3):
                    doc, key, weight = [], [], []
                    for a, _, batch in tx.batches(part.column(column)):
                        d, h, w = shingles(batch, words, weights)
                        doc.append(d + a)
                        key.append(tx.mix(h + (d + a).astype(np.uint64) * tx.STEP))
                        weight.append(w)
                    sides.append([np.concatenate(x) for x in (doc, key, weight)])
                (doc_a, key_a, w_a), (doc_b, key_b, w_b) = sides
                _, at_a, at_b = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
                n = part.num_rows
                both = np.bincount(doc_a[at_a], weights=np.minimum(w_a[at_a], w_b[at_b]), minlength=n)
                either = np.bincount(doc_a, weights=w_a, minlength=n) + np.bincount(doc_b, weights=w_b, minlength=n) - both
                value = np.divide(both, either, out=np.zeros(n), where=either > 0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(value)], names=schema.names)

    return pairs.mapInArrow(run, schema)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", at_least: float = SIMILARITY,
            weights: str = "count", words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id`` (the key), ``class_id``, the smallest key that
    links reach, ``copies`` (rows of the same text), ``node`` (hash of the text) and
    ``class_node``. A link joins texts that share a band and are at least that similar.

    Equal texts are one node before anything is compared, so copies cost a row each.
    Within a band's bucket all texts are first compared with the bucket's most central
    one only; that connects most groups by as many links as they have texts. Pairs
    that this leaves in different components are then compared, each in the first bucket
    they share, unless their distances to the central text differ by more than a link may
    span (the distance is a metric), or their sketches disagree too much: those of the
    signature first, then long ones made for these texts alone (a miss needs 4.5
    standard deviations). The join tests that by itself, so no bucket is expanded into
    all its pairs, and no pair in a bucket goes unexamined.

    Null text counts as empty. Texts without words are similar to nothing, but equal
    ones are copies. Fewer words than a shingle make one shingle. A null key is never
    the smallest unless the class has no other. Texts are told apart by 64-bit hashes.
    An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("node"), body.alias("text"))
    ids = base.select("doc_id", "node").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    signs = frames.saved(signed(base.select("node", "text"), weights=weights, words=words, bands=bands, rows=rows),
                         "signatures")

    slots = signs.select("node", F.explode("bands").alias("bucket")).distinct()
    shared = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    slots = frames.saved_narrow(slots.join(shared, "bucket"), "buckets")
    central = slots.groupBy("node").agg(F.sum("size").alias("rank"))
    ranked = slots.join(central, "node")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("rank", "node")).alias("top"))
    star = slots.join(leaders, "bucket").select("bucket", "node", F.col("top.node").alias("leader"))
    star = frames.saved_narrow(star, "stars")

    # One row stands for all copies before texts meet: rows are dealt by text and key.
    heads = ids.join(central.select("node"), "node", "left_semi").select(F.col("node").alias("__node"), F.col("first_id").alias("__id"))
    texts = base.join(heads, (F.col("node") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    texts = texts.select("node", "text").dropDuplicates(["node"])
    texts = frames.saved(texts, "candidate-texts")
    spokes = star.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    told = frames.saved_narrow(similarity(_with_texts(spokes, texts), weights=weights, words=words), "spokes", dealt=True)
    links = told.where(F.col("similarity") >= at_least).select("a", "b")
    parts = frames.components(links)

    # What the central texts left apart.
    label = lambda df: df.join(parts.withColumnRenamed("component", "__c"), "node", "left").withColumn(
        "component", F.coalesce("__c", "node")).drop("__c")
    far = told.select(F.col("a").alias("node"), F.col("b").alias("leader"), (1 - F.col("similarity")).alias("far"))
    open_rows = label(star)
    mixed = open_rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_rows = open_rows.join(mixed.where("lo <> hi").select("bucket"), "bucket", "left_semi")
    open_rows = open_rows.where("node <> leader").join(far, ["node", "leader"])
    about = signs.join(open_rows.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    long = sketched(texts.join(open_rows.select("node").distinct(), "node", "left_semi"), weights=weights, words=words)
    open_rows = frames.saved(open_rows.join(about, "node").join(long, "node"), "open-rows")
    a, b = open_rows.alias("a"), open_rows.alias("b")
    apart = sum((_differ(F.col("a.sketch")[i], F.col("b.sketch")[i]) for i in range(-(-bands * rows // 32))), F.lit(0))
    long_apart = F.aggregate(F.zip_with("a.long_sketch", "b.long_sketch", _differ), F.lit(0), lambda n, d: n + d)
    first_shared = F.element_at(F.filter(F.arrays_zip(F.col("a.bands").alias("x"), F.col("b.bands").alias("y")),
                                         lambda p: p["x"] == p["y"]), 1)["x"]
    cross = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.node") < F.col("b.node"))
                   & (F.col("a.component") != F.col("b.component"))
                   & (F.abs(F.col("a.far") - F.col("b.far")) <= 1 - at_least + 1e-9)
                   & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * (at_least - 1e-9))
                   & (apart <= _most_apart(bands * rows, at_least)) & (first_shared == F.col("a.bucket"))
                   & (long_apart <= _most_apart(LONG, at_least)))
    cross = cross.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    late = frames.saved_narrow(similarity(_with_texts(cross, texts), weights=weights, words=words), "cross-links", dealt=True)
    late = late.where(F.col("similarity") >= at_least).select("a", "b")
    parts = frames.components(links.union(late))

    nodes = ids.join(parts.withColumnRenamed("component", "__c"), "node", "left")
    nodes = nodes.select("node", "copies", F.coalesce("__c", "node").alias("class_node"), "first_id")
    heads = nodes.groupBy("class_node").agg(F.min("first_id").alias("class_id"))
    nodes = nodes.join(heads, "class_node").select("node", "copies", "class_node", "class_id")
    return base.select("doc_id", "node").join(nodes, "node").select("doc_id", "class_id", "copies", "node", "class_node")


def _differ(x: Column, y: Column) -> Column:
    """How many of the 32 coordinates of two longs differ."""
    bits = x.bitwiseXOR(y)
    return F.bit_count(bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def without_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, one of each class: that with the smallest key. Rows equal in key
    and text stay once."""
    found = classes(docs, key=key, text=text, **options)
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_node").agg(
        F.min(F.struct("doc_id", "node")).alias("head")).select(F.col("head.doc_id").alias("__id"),
                                                                F.col("head.node").alias("__node"))
    rows = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    rows = rows.join(heads, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__node")))
    return rows.dropDuplicates(["__id", "__node"]).drop("__own", "__id", "__node")
