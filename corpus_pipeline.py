"""The corpus pipeline: documents in, filtered, deduplicated and encoded documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import byte_bpe, decontaminate, line_dedup, near_dedup, toxicity
from tickloom.llm.common import stored, table
from tickloom.llm.queries import vocabulary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; written here, so that few texts go to Python at once."""
    return stored(toxicity.drop_toxic(docs, table(spark, sf_dir, "labels")), "clean", byte_bpe.TEXT_ROWS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; ``n_chars`` follows the text."""
    return line_dedup.drop_recurring_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, their number, and the bytes that they decode to."""
    ranks = vocabulary()
    slim = docs.select("doc_id", "text")
    encoded = stored(byte_bpe.encode(slim, ranks).select("doc_id", "ids"), "ids", byte_bpe.TEXT_ROWS)
    decoded = byte_bpe.decoder(ranks, docs)(F.col("ids"))
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), decoded.alias("decoded"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]

# Boosted trees and iterated merges have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
