"""One query per text operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import byte_bpe, chat_repair, collocations, decontaminate, hilbert, line_dedup, near_dedup, neighbours, secret_grammar, source_divergence, substring_dedup, toxicity, url_reputation
from tickloom.llm.common import table

def vocabulary() -> byte_bpe.Ranks:
    """The ranks that the queries encode by."""
    import public_tokenizers

    return byte_bpe.Ranks.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(fn: Callable) -> Callable:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_decontamination", decontaminate.SQL)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_url_reputation", url_reputation.SQL)
def op8_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    out = url_reputation.url_verdicts(table(spark, folder, "pages"), table(spark, folder, "labels"))
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op9_hilbert_shards")
def op9_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    out = hilbert.hilbert_shards(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op10_near_dedup", near_dedup.SQL)
def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_recurring_lines(table(spark, folder, "documents")).select("doc_id", "text")


@query("op2_secret_grammar")
def op2_secret_grammar(spark: SparkSession, folder: str) -> DataFrame:
    return secret_grammar.secret_report(table(spark, folder, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.token_report(table(spark, folder, "documents"), vocabulary())


@query("op6_chat_repair")
def op6_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat_repair.repaired_turns(table(spark, folder, "conversations"))


@query("op13_substring_dedup", substring_dedup.SQL)
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.drop_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op11_collocations", collocations.SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query("op12_source_divergence", source_divergence.SQL)
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.divergence(table(spark, folder, "documents"))
