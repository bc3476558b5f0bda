"""The corpus pipeline: quality rules, line deduplication, near-duplicate
documents, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run``
writes what a stage returns to the shared scratch folder and rereads it as the
next stage's documents; all stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import line_dedup, ngram_join, packing, quality_rules
from zonecast.llm.queries import vocabulary
from zonecast.llm.util import table, written

# near-duplicate documents: five-word shingles, similarity 0.8 or more
SHINGLE_WORDS, SIMILARITY_PCT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat, word for word or nearly, an
    earlier line of the corpus.  Documents that lose lines and have no word
    left go; n_chars counts the new text."""
    out = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_same") + F.col("n_near") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    chars = F.when(F.col("n_same") + F.col("n_near") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that Jaccard
    links join."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY_PCT, 100)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in packed sequences."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", near_duplicates),
    ("packing", pack),
]

# Packing isn't a SQL computation; tests/llm/test_pipeline.py checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
