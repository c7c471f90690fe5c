"""The queries of this package over the tables of a folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import embedding_dedup, license_scan, lm_score, mixing, ngram_join, packing, quality, token_counts, toxicity, url_filters


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("spans")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, folder, "pages"))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_documents(table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(table(spark, folder, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_token_counts,
        op3_toxicity,
        op4_packing,
        op5_url_filters,
        op6_lm_scoring,
        op7_quality_rules,
        op8_ngram_jaccard_join,
        op9_license_scan,
        op10_mixing,
    )
}
#: The others are iterative, or a library's tokens, and are tested against brute force.
ORACLE_SQL = {"op5_url_filters": url_filters.ORACLE, "op9_license_scan": license_scan.oracle(), "op10_mixing": mixing.ORACLE}
