"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. toxicity: documents that the machine rejects go; it learns from the labelled rows that are
   not held out, as in op10.
2. near_duplicates: of each group of linked documents the one with the smallest doc_id stays, also
   where rows have no doc_id, or several texts have the same one.
3. substring_dedup: words of repeated passages go; a document keeps its other words.
4. mixing: sources are repeated and thinned to their targets; a document appears as often as it
   is taken whole, and once more cut to its first words where a part of it is taken.
5. packing: what is left is tokenised and packed; one row per piece.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Null texts, empty tables and repeated rows are handled as the operators'
modules say; a row without a doc_id is a document like others. Columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placerank.llm.catalog import quality_weights, toxicity_model
from placerank.llm.common import documents, written
from placerank.llm.language import remainder
from placerank.llm.mixing import apply_mix, mix
from placerank.llm.near_duplicates import keep_first
from placerank.llm.packing import pack_documents
from placerank.llm.substring_dedup import clean
from placerank.llm.tokenize import tokenizer_path
from placerank.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return keep_clean(docs, toxicity_model(docs, spark, sf_dir))


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id, rows without one last.
    Documents without words are in no group."""
    return keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages."""
    return clean(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return apply_mix(docs, mix(docs, quality=quality_weights(spark, sf_dir)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate_join),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# A trained machine and tokenizers are beyond SQL: checked against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written rows of the one before; the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
