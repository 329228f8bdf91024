"""From raw documents to packed training sequences, each stage written and reread as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcela.llm import exact, mixing, ngram_join, packing, quality
from parcela.llm.common import stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, with all their columns; null and empty texts do not pass."""
    return quality.keep(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest doc_id; of rows that repeat both one is left.

    A null text counts as empty, a null doc_id as less than any other; rows of one id with unlike texts are judged apart.
    """
    return exact.keep(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles, that of the smallest doc_id.

    Texts without words link with nothing and stay; a null doc_id stays only where all of its group are null; rows of
    one id with unlike texts are judged apart.
    """
    return ngram_join.keep(docs, k=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the chances that bring source, language and topic to their targets, null ones being a value too."""
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their texts, and the bins that they share; texts without words have no piece."""
    return packing.with_texts(packing.pack(docs), docs)


STAGES = [
    ("quality rules", good),
    ("exact dedup", distinct),
    ("n-gram Jaccard join", apart),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]

#: Best-fit packing depends on each choice before, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
