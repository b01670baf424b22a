"""The operators over the shared tables, with production parameters, and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.llm import (
    ann, embed_dedup, importance, langid, line_dedup, mixing, ngram_join, packing, phrases, sharding, spm_codec, suffix_dedup, toxicity)
from vetrow.llm.oracles import ORACLES  # noqa: F401
from vetrow.llm.common import crc_remainder, documents, embeddings

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(embeddings(spark, sf_dir)).select("vec_id", "n_links", "component_id", "kept")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(documents(spark, sf_dir), 16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.save(packing.tokenize_pieces(documents(spark, sf_dir), BPE), "pieces")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(crc_remainder("doc_id", 3) != 1))
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_units(documents(spark, sf_dir), window=None).select(
        "doc_id", "text", F.col("_n_units").alias("n_units"), F.col("_n_removed").alias("n_removed"),
        F.col("_removed_chars").alias("removed_chars"), F.col("_removed_spans").alias("removed_spans"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm_codec.encode_digests(documents(spark, sf_dir), PIECES)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_remainder("doc_id", 4) != 2)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= toxicity.PREDICT_AT).cast("int").alias("predicted"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(embeddings(spark, sf_dir), F.col("vec_id") % 100 == 0)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.importance_resample(documents(spark, sf_dir), target, carry=("doc_id",))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir), carry=("doc_id",)).select(
        "doc_id", "size", "source_size", "target", "repeats", "part", "taken")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_sharding, op3_packing, op4_language, op5_suffix_dedup, op6_line_dedup, op7_sentencepiece, op8_toxicity,
                                op9_ngram_join, op10_nearest, op11_importance, op12_mixing, op13_phrases)}
QUERIES["pipeline"] = corpus_pipeline.run
