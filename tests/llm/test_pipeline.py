"""The pipeline's stages, each judged on its own input."""

from __future__ import annotations

import corpus_pipeline
import pandas as pd
from pyspark.sql import functions as F

from tickloom.llm import byte_bpe, decontaminate
from tickloom.llm.common import stored
from tickloom.llm.queries import vocabulary


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, folder), name)
        found[name] = (before, docs)
        assert docs.columns == columns or name == "byte_bpe"
    assert list(found) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    before, after = found["line_dedup"]
    assert before.count() == after.count()
    before, after = found["decontamination"]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    hits = decontaminate.brute_force({r["doc_id"]: r["text"] for r in before.collect()}, items)
    assert {r["doc_id"] for r in after.collect()} == {d for d, h in hits.items() if not h[1]}
    before, after = found["byte_bpe"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    piece = {i: p for p, i in vocabulary().ranks.items()}
    assert all(bytes(r["decoded"]) == texts[r["doc_id"]].encode() == b"".join(piece[i] for i in r["ids"]) and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_pipeline_survives_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_toxicity_sends_few_texts_to_python_at_once(spark, folder, monkeypatch):
    """A batch held up to 10,000 texts, in the executor's memory and in Python's."""
    rows = F.pandas_udf(lambda texts: pd.Series([len(texts)] * len(texts)), "long")
    monkeypatch.setattr(corpus_pipeline.toxicity, "drop_toxic", lambda docs, labels: docs.withColumn("rows", rows("text")))
    docs = spark.range(0, 3500, 1, 1).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = corpus_pipeline.toxicity_stage(spark, docs, folder)
    assert out.count() == 3500 and out.agg(F.max("rows")).first()[0] <= byte_bpe.TEXT_ROWS
