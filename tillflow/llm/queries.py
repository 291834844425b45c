"""The operators as queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import context_tree, curriculum, dart_minhash, fertility, filter_audit, frames, grid_join, nbsvm, oracles, periodic_runs, pieces, sharding, site_lines, stream_dedup, token_files

#: Sixteen shards of equal weight: two regions of two racks of four.
REGIONS = (((1.0,) * 4,) * 2,) * 2


def op1_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = frames.table(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        frames.text_md5(F.col("doc_id"), text).alias("digest"),
        F.lit("key").alias("law"))
    docs = sharding.place(docs, F.col("doc_id"), sharding.tree(REGIONS))
    docs = sharding.place(docs, F.col("doc_id"), sharding.tree(sharding.grown(REGIONS)), "grown_")
    docs = sharding.slots(docs, "shard", "digest", ("doc_id", "size", "text_crc32"))
    return docs.select("doc_id", "size", "text_crc32", "law", "region", "rack", "shard", "slot", "grown_shard")


def op5_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, range-sorted by the moment the mix first takes it; untaken last."""
    mixed = curriculum.assign(frames.table(spark, sf_dir))
    position = F.try_element_at("passes", F.lit(1))["position"]
    mixed = mixed.select("doc_id", "source", "size", "source_size", "target", "taken", position.alias("position"))
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op2_dart_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dart_minhash.classes(frames.table(spark, sf_dir))
    return found.select("doc_id", "class_id", "copies", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op3_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir).select("doc_id", "source", "text")
    return site_lines.without_boilerplate(docs)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(frames.table(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(frames.table(spark, sf_dir, "embeddings"))


def held_out(parts: int) -> Column:
    """Whether a document is kept from learning: its id's checksum leaves 2."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts == 2


def op7_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir)
    model = nbsvm.train(docs, frames.table(spark, sf_dir, "labels"), learn_from=~held_out(4))
    scores = nbsvm.scored(docs, model)
    return scores.select("doc_id", held_out(4).alias("held_out"), "score",
                         (F.col("score") >= nbsvm.THRESHOLD).cast("int").alias("predicted"))


def op8_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judged(frames.table(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")).drop("language")


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(frames.table(spark, sf_dir), held_out(7))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.written(frames.table(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2)
    return token_files.read_back(manifest).withColumnRenamed("key", "doc_id")


def _periodic(docs: DataFrame) -> DataFrame:
    """The documents, those of every tenth checksum with a periodic tail."""
    words = r"[^\x20\x09-\x0D]+"
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    drawn = docs.select("doc_id", "text", (checksum % 10 == 0).alias("tenth"), F.floor(checksum / 10).alias("g"),
                        F.when(checksum % 10 == 0, F.regexp_extract_all("text", F.lit(words), F.lit(0))).alias("words"))
    drawn = drawn.withColumn("n", F.size("words")).withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    drawn = drawn.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    tail = "slice(flatten(array_repeat(slice(words, CAST(a AS INT) + 1, p), CAST((n - a) div p AS INT) + 1)), 1, CAST(n - a AS INT))"
    made = F.expr(f"array_join(concat(slice(words, 1, CAST(a AS INT)), {tail}), ' ')")
    return drawn.select("doc_id", F.when(F.col("tenth") & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapsed(_periodic(frames.table(spark, sf_dir)))
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), greatest.alias("g"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("g")["col2"], F.col("g")["length"], -F.col("g")["col3"]
    return found.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.counted(spark, f"{sf_dir}/documents.parquet", frames.table(spark, sf_dir, "labels"))
    return filter_audit.interactions(counts)


def op13_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup.deduplicated(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_hash_tree_sharding, op2_dart_minhash_dedup, op3_site_line_dedup, op4_sentencepiece, op5_curriculum_mixing,
    op6_epsilon_grid_join, op7_nbsvm_quality, op8_tokenizer_fertility, op9_context_tree, op10_token_files,
    op11_periodic_runs, op12_filter_audit, op13_stream_dedup)}
ORACLES = {"op1_hash_tree_sharding": oracles.OP1, "op3_site_line_dedup": oracles.OP3, "op5_curriculum_mixing": oracles.OP5,
           "op12_filter_audit": oracles.OP12, "op13_stream_dedup": oracles.OP13}
