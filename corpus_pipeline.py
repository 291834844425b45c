"""From documents to training tokens, in five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read
again as the next one's documents. All but the last return the columns of documents;
where a text loses words, its ``n_chars`` follows. Parameters are the operators' own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import curriculum, dart_minhash, frames, nbsvm, pieces, queries, site_lines


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the rest go. Learns from the
    labelled documents that the query learns from."""
    labels = frames.table(spark, sf_dir, "labels")
    return nbsvm.accepted(docs, nbsvm.train(docs, labels, learn_from=~queries.held_out(4)))


def fewer_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source."""
    return _recounted(site_lines.without_boilerplate(docs), docs.columns)


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest id."""
    return dart_minhash.without_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return _recounted(curriculum.mix(docs), docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked against SentencePiece and decoded again."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", fewer_lines),
    ("near duplicates", no_copies),
    ("source mixing", mixed_sources),
    ("piece encoding", encoded),
]

#: The classifier, the signatures and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written to the shared folder."""
    docs = frames.table(spark, sf_dir)
    for name, stage in STAGES:
        docs = frames.saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
