"""Named queries of the training-data operators over the shared tables: each applies one
operator, with production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_trie import recoded_digests
from .common import documents, new_path, written
from .conversations import repair_report
from .fingerprint import edited_fingerprints
from .language import identify, language_samples, remainder
from .mixing import mix
from .near_duplicates import near_duplicates
from .oracle import ORACLE  # noqa: F401  (part of this module's interface)
from .packing import pack_documents
from .substring_dedup import digests as kept_digests
from .suffix_tree import score_documents
from .token_files import digests, read_token_ids, with_starts, write_token_ids
from .tokenize import tokenizer_path
from .topk import top_k
from .toxicity import classify, sampled, trained
from .whitening import whiten

# Weights of a document by its quality label; documents without a label weigh 1.
GOOD_WEIGHT, POOR_WEIGHT = 2.0, 0.5


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IS NOT NULL")
    return labels.select("doc_id", F.when(F.col("quality") == 1, GOOD_WEIGHT).otherwise(POOR_WEIGHT).alias("weight"))


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), remainder(F.col("doc_id"), 7) == 2)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir), quality=quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = remainder(F.col("doc_id"), 4) == 2
    return identify(docs, language_samples(docs, held_out), held_out)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digests(documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    write_token_ids(documents(spark, sf_dir), path, tokenizer_path("byte_bpe_50k.json"))
    return with_starts(written(digests(read_token_ids(spark, path)), "token-digests"))


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str):
    """The machine trained on the labelled documents of ``docs`` that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return trained(sampled(docs, labels, remainder(F.col("doc_id"), 5) == 0))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classify(docs, toxicity_model(docs, spark, sf_dir), remainder(F.col("doc_id"), 5) == 0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"))
    return whiten(vectors, components=4)


def op12_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recoded_digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_fingerprints": op4_fingerprints,
    "op5_topk": op5_topk,
    "op6_packing": op6_packing,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_bpe_trie": op12_bpe_trie,
    "op13_conversations": op13_conversations,
}

