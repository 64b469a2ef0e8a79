"""The registered queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contamination import find_contamination
from .language_model import score_texts
from .metric_tree import top_inner
from .ngram_join import near_duplicates
from .packing import pack_documents
from .quality import score_quality
from .resampling import resample
from .sharding import shard_documents
from .shared import table
from .substring_dedup import remove_repeats
from .suffix_dedup import remove_long_matches
from .tokens import count_tokens
from .toxicity import score_toxicity
from .whitening import whiten

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), window=35, keep_text=False)


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), VOCABULARY, limit=2048)


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), VOCABULARY, end_id=2, capacity=4096).drop("ids")


def quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10).drop("spans")


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner(table(spark, folder, "embeddings"), k=20, every=20, scale=64.0)


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"), order=3, sweeps=3).drop("perplexity")


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_long_matches(table(spark, folder, "documents"), length=200, keep_text=False)


def ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), n=5, threshold=0.8)


def whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"), components=8, scale=1024.0, offset=100_000)


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_documents(table(spark, folder, "documents"), shards=8)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resample(docs, benchmark, least=1, most=1, buckets=10_000, percent=10, min_words=20, seed=2024)


QUERIES = {
    "op1_substring_dedup": substring_dedup,
    "op2_token_counts": token_counts,
    "op3_packing": packing,
    "op4_quality": quality,
    "op5_decontamination": decontamination,
    "op6_toxicity": toxicity,
    "op7_top_k": top_k,
    "op8_lm_scores": lm_scores,
    "op9_suffix_dedup": suffix_dedup,
    "op10_ngram_join": ngram_join,
    "op11_whitening": whitening,
    "op12_sharding": sharding,
    "op13_resampling": resampling,
}
