"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

A lexicon of words and word beginnings is learnt from labelled rows by log-odds. Features are densities of its
entries, how near they stand to second-person words, and rates of capitals, punctuation and obfuscation. Trees and
lexicon are fitted on a bounded sample of labelled rows, the calibration on other rows of it; scoring covers all texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stored
from tickloom.session import shared_dir

# Labelled rows that are learnt from: those with the smallest hashes of their ids.
FIT_ROWS = 12_000
LEXICON = 4_000
LEAST_TOXIC = 4
LEAST_WEIGHT = 1.5
STEMS = (4, 5, 6)
NEAR = 4
TREES, DEPTH = 24, 4
CACHE_WORDS = 500_000

# Words that address the reader.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur ya du dich dir dein deine deinen deiner ihr euch euer sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros os".split()
)

FEATURES = (
    "log_words", "strong_density", "any_density", "weight_density", "weight_sum", "top_weight", "second_top", "hits",
    "near_second_person", "second_person_rate", "capital_rate", "shout_rate", "punctuation_rate", "exclamation_rate",
    "digit_rate", "obfuscation_rate", "elongation_rate", "mean_word_length",
)
_SPACED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_UPPER = bytes(range(0x41, 0x5B))
_DIGIT = b"0123456789"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_OBFUSCATED = re.compile(r"[A-Za-z][*@$#|0-9]{1,4}[A-Za-z]")
_ELONGATED = re.compile(r"([A-Za-z])\1\1")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")


class Weights(dict):
    """Weight of a word: that of the word itself or its heaviest beginning; a bounded cache."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        w, get = word.decode("utf-8", "surrogatepass"), self.lexicon.get
        value = max([get(w, 0.0), *(get(f"{w[:k]}~", 0.0) for k in STEMS if len(w) >= k)])
        self[word] = value
        return value


def terms_of(text: str | None) -> list[str]:
    """Distinct words and word beginnings (marked by ~) of a text."""
    if not text:
        return []
    words = {w.decode("utf-8", "surrogatepass") for w in set(text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split())}
    return list(words | {f"{w[:k]}~" for w in words for k in STEMS if len(w) >= k})


def features_of(text: str | None, weights: Weights) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()
    n, size = len(words), max(1, len(raw))
    if not n:
        return [0.0] * len(FEATURES)
    weight = np.fromiter(map(weights.__getitem__, words), np.float64, n)
    hits = np.flatnonzero(weight >= LEAST_WEIGHT)
    near = 0
    for at in hits:
        around = words[max(0, at - NEAR):at + NEAR + 1]
        near += any(w.decode("utf-8", "surrogatepass") in SECOND_PERSON for w in around)
    second = sum(w in _SECOND_BYTES for w in words)
    top = np.sort(weight)[-2:]
    count = lambda chars: size - len(raw.translate(None, chars)) if raw else 0
    return [
        math.log1p(n), float((weight >= 3).sum()) / n, len(hits) / n, float(weight[hits].sum()) / n, float(weight[hits].sum()),
        float(top[-1]), float(top[0]) if n > 1 else 0.0, float(len(hits)), near / n, second / n,
        count(_UPPER) / size, len(_SHOUT.findall(text)) / n, count(_MARKS) / size, count(b"!") / size, count(_DIGIT) / size,
        len(_OBFUSCATED.findall(text)) / n, len(_ELONGATED.findall(text)) / n, sum(map(len, words)) / n,
    ]


_SECOND_BYTES = frozenset(w.encode() for w in SECOND_PERSON)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel
    calibration: IsotonicRegressionModel

    def score(self, docs: DataFrame, text_col: str = "text", out: str = "toxicity") -> DataFrame:
        """``docs`` with the calibrated probability ``out``; null and empty texts are scored like a text without words."""
        out = free_name(docs.columns, out)
        mine = {c: free_name(docs.columns, f"_tox_{c}") for c in ("features", "raw", "p", "pred", "iso", "in")}
        trees = self.trees.copy().setFeaturesCol(mine["features"]).setRawPredictionCol(mine["raw"]).setProbabilityCol(mine["p"]).setPredictionCol(mine["pred"])
        scored = trees.transform(docs.withColumn(mine["features"], array_to_vector(dense_features(F.col(f"`{text_col}`"), self.lexicon, docs))))
        scored = scored.withColumn(mine["in"], vector_to_array(mine["p"])[1])
        iso = self.calibration.copy().setFeaturesCol(mine["in"]).setPredictionCol(mine["iso"])
        calibrated = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(mine["iso"])))
        return iso.transform(scored).withColumn(out, calibrated).select(*[F.col(f"`{c}`") for c in docs.columns], out)


def dense_features(text: Column, lexicon: dict[str, float], df: DataFrame) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = Weights(shared.value)
        for texts in batches:
            yield pd.Series([features_of(t, weights) for t in texts])

    return features(text)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from at most ``fit_rows`` labelled rows whose id's remainder is not 0: the ids with the smallest hashes.

    Remainders 1 to 3 give lexicon and trees, remainder 4 the calibration. Several labels of an id count as toxic if
    one is; null ids and labels are left out. Raises ValueError if the rows do not hold both classes.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    known = labels.where("doc_id is not null and toxic is not null").where(remainder(F.col("doc_id")) != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    # Bounded by ``fit_rows``, so it may be broadcast.
    ids = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumn("part", remainder(F.col("doc_id")))
    rows = stored(rows, "labelled")
    learning = rows.where("part < 4")
    totals = {r["label"]: r["n"] for r in learning.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0.0) or not totals.get(1.0):
        raise ValueError("labelled rows of both classes are needed")
    terms = F.pandas_udf(lambda texts: texts.map(terms_of), "array<string>")
    counts = learning.select("label", F.explode(terms("text")).alias("term")).groupBy("term").agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    bad, good = totals[1.0], totals[0.0]
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (good + 1))
    heavy = counts.where(F.col("bad") >= LEAST_TOXIC).withColumn("weight", odds).where(F.col("weight") >= LEAST_WEIGHT)
    lexicon = {r["term"]: r["weight"] for r in heavy.orderBy(F.desc("weight"), "term").limit(LEXICON).collect()}
    made = rows.select("label", "part", array_to_vector(dense_features(F.col("text"), lexicon, rows)).alias("features"))
    made = stored(made, "features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, subsamplingRate=1.0, seed=7, labelCol="label", featuresCol="features")
    model = trees.fit(made.where("part < 4"))
    other = model.transform(made.where("part = 4")).select("label", vector_to_array("probability")[1].alias("p"))
    if other.isEmpty():
        other = model.transform(made).select("label", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(labelCol="label", featuresCol="p").fit(other)
    return ToxicityModel(lexicon, model, calibration)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Repeated rows have equal scores; null texts are scored as empty ones; an empty table gives an empty result.
    """
    model = fit(docs, labels)
    scored = model.score(docs.select(id_col, "text"))
    held_out = (remainder(F.col(id_col)) == 0).alias("held_out")
    return scored.select(id_col, held_out, F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below one half, with the columns they came with."""
    scored = fit(docs, labels).score(docs)
    score = next(c for c in scored.columns if c not in docs.columns)
    return scored.where(F.col(f"`{score}`") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
