"""A training corpus from documents: quality, near duplicates, long repeats, benchmark passages, packing.

Each stage takes the documents that its predecessor kept and returns documents with the same columns; the last one
returns the packed pieces. Rows may repeat ids, have nulls in any column and carry further columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwave.llm.contamination import find_contamination
from stepwave.llm.ngram_join import drop_near_duplicates
from stepwave.llm.packing import pack_documents
from stepwave.llm.quality import keep_good
from stepwave.llm.shared import stored, table
from stepwave.llm.suffix_dedup import remove_long_matches

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, 0.8), the one with the smallest id."""
    return drop_near_duplicates(docs, n=5, threshold=0.8)


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 200 bytes that occur elsewhere; documents that end up empty go."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others), F.col("text").isNull().alias("no text")).alias("doc"), "text")
    found = remove_long_matches(rows, length=200, key="doc").filter("kept <> '' OR n_removed = 0")
    kept = F.when(~F.col("doc.`no text`"), F.col("kept"))
    values = {c: F.col("doc").getField(c) for c in others} | {"text": kept}
    if "n_chars" in others:
        values["n_chars"] = F.when(F.col("n_removed") > 0, F.length(kept)).otherwise(values["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return found.select(*(values[c].alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "text")
    clean = find_contamination(rows, table(spark, sf_dir, "benchmark"), window=10, key="doc").filter(~F.col("contaminated"))
    return clean.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return pack_documents(docs, VOCABULARY, end_id=2, capacity=4096).drop("ids")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", long_repeats),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the classifier and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
