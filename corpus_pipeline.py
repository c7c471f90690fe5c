"""Documents to packed training sequences: quality, toxicity, near-duplicates, mixing, packing.

Each stage takes (spark, docs, folder) and works on all the documents that its predecessor kept; all but the last return
the columns of documents. What a stage returns is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom import store
from sparkloom.llm import mixing, ngram_join, packing, quality, toxicity


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the weakly supervised rules take for good."""
    return quality.good_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by five-word Jaccard similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Models, similarity joins and a library's tokens are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = store.written(stage(spark, docs, folder), f"stage-{n}")
    return docs
