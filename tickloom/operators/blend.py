"""Calibration of predictions and blends of several models."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.operators.cross import rank_percentile
from tickloom.operators.joins import map_lookup_fallback
from tickloom.operators.metrics import FLOOR
from tickloom.session import checkpointed


def date_bias(df: DataFrame, truth: str, prediction: str, date: str = S.DATE) -> DataFrame:
    """Mean residual per date."""
    return df.groupBy(date).agg(F.avg(F.col(truth) - F.col(prediction)).alias("bias"))


def smoothed_bias(bias: DataFrame, window: int = 20, date: str = S.DATE) -> DataFrame:
    """Trailing mean, as if the first value had been repeated before the start; one row per date."""
    order = Window.orderBy(date)
    frame = order.rowsBetween(-(window - 1), 0)
    lacking = F.lit(window) - F.count("*").over(frame)
    padded = (F.sum("bias").over(frame) + lacking * F.first("bias").over(order)) / F.lit(window)
    days = F.count("*").over(Window.partitionBy())
    return bias.select(date, "bias", F.when(days >= window, padded).otherwise(F.col("bias")).alias("smoothed"))


def temporal_bias(
    df: DataFrame, fit_on: DataFrame, truth: str, prediction: str, window: int = 20, date: str = S.DATE, out: str = "corrected"
) -> DataFrame:
    """Prediction plus the smoothed bias of its date; the overall mean residual for other dates."""
    gap = F.col(truth) - F.col(prediction)
    sums = checkpointed(fit_on.groupBy(date).agg(F.avg(gap).alias("bias"), F.count(gap).alias("_n")))
    smooth = smoothed_bias(sums, window, date)
    overall = sums.agg(F.try_divide(F.sum(F.col("bias") * F.col("_n")), F.sum("_n"))).scalar()
    found = map_lookup_fallback(df, smooth, [date], "smoothed", overall, "_bias")
    return found.withColumn(out, F.col(prediction) + F.col("_bias")).drop("_bias")


def isotonic(df: DataFrame, fit_on: DataFrame, truth: str, prediction: str, out: str = "calibrated") -> DataFrame:
    """Monotone fit of truth on prediction, flat beyond the fitted range.

    Equal predictions are averaged before the fit, which leaves the fit unchanged.
    """
    from pyspark.ml.regression import IsotonicRegression

    ties = (
        fit_on.where(F.col(truth).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(prediction).cast("double").alias("_x"))
        .agg(F.avg(F.col(truth).cast("double")).alias("_y"), F.count("*").cast("double").alias("_n"))
    )
    model = IsotonicRegression(
        featuresCol="_x", labelCol="_y", weightCol="_n", predictionCol=out, isotonic=True
    ).fit(ties)
    known = df.withColumn("_x", F.col(prediction).cast("double"))
    return model.transform(known).drop("_x")


def weighted_blend(df: DataFrame, models: Sequence[str], weights: Sequence[float] | None = None, out: str = "blend") -> DataFrame:
    """Weighted sum of prediction columns; equal weights by default."""
    used = list(weights) if weights is not None else [1 / len(models)] * len(models)
    if len(used) != len(models):
        raise ValueError(f"{len(models)} models but {len(used)} weights")
    total: Column = F.lit(0.0)
    for m, w in zip(models, used):
        total = total + F.col(m) * F.lit(float(w))
    return df.withColumn(out, total)


def blend_sums(
    df: DataFrame, models: Sequence[str], truth: str = S.TARGET, weight: str = S.WEIGHT, date: str = S.DATE
) -> DataFrame:
    """Per date: the sums from which the score of every blend of ``models`` follows."""
    y, w = F.col(truth).cast("double"), F.col(weight).cast("double")
    pairs = combinations_with_replacement(range(len(models)), 2)
    return df.groupBy(date).agg(
        F.sum(w * y * y).alias("yy"),
        *[F.sum(w * y * F.col(m)).alias(f"y{i}") for i, m in enumerate(models)],
        *[F.sum(w * F.col(models[i]) * F.col(models[j])).alias(f"p{i}_{j}") for i, j in pairs],
    )


def simplex_lattice(n_models: int, steps: int) -> list[tuple[float, ...]]:
    """All weight vectors with entries k/steps that sum to 1."""

    def parts(left: int, n: int):
        if n == 1:
            yield (left,)
        else:
            for k in range(left + 1):
                for rest in parts(left - k, n - 1):
                    yield (k, *rest)

    return [tuple(k / steps for k in p) for p in parts(steps, n_models)]


def score_blends(sums: DataFrame, candidates: Sequence[Sequence[float]]) -> DataFrame:
    """Summed score of each weight vector, from the per-date sums alone."""
    candidates = list(dict.fromkeys(tuple(c) for c in candidates))
    n = len(candidates[0])
    weights = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in candidates])
    tried = sums.withColumn("_w", F.explode(weights))
    w = [F.col("_w")[i] for i in range(n)]
    yp, pp = F.lit(0.0), F.lit(0.0)
    for i in range(n):
        yp = yp + w[i] * F.col(f"y{i}")
        for j in range(i, n):
            pp = pp + F.lit(1.0 if i == j else 2.0) * w[i] * w[j] * F.col(f"p{i}_{j}")
    den = F.sqrt(F.greatest(F.col("yy") * pp, F.lit(0.0)))
    score = F.coalesce(F.sum(F.when(den >= FLOOR, yp / den)), F.lit(0.0))
    return tried.groupBy(*[x.alias(f"w{i}") for i, x in enumerate(w)]).agg(score.alias("score"))


def blend_weight_search(
    df: DataFrame,
    models: Sequence[str],
    truth: str = S.TARGET,
    weight: str = S.WEIGHT,
    date: str = S.DATE,
    steps: int = 10,
    rounds: int = 4,
) -> list[float]:
    """Weights on the simplex with the highest score: a lattice, refined around its best point.

    The data are read once, for the per-date sums; each round scores a fixed number of candidates on them.
    """
    sums = checkpointed(blend_sums(df, models, truth, weight, date))
    order = [F.desc("score"), *[F.col(f"w{i}") for i in range(len(models))]]
    lattice = simplex_lattice(len(models), steps)
    best = score_blends(sums, lattice).orderBy(*order).first()
    centre = [best[f"w{i}"] for i in range(len(models))]
    pull = 0.5
    for _ in range(rounds):
        near = [centre] + [[c + pull * (x - c) for c, x in zip(centre, p)] for p in lattice]
        best = score_blends(sums, near).orderBy(*order).first()
        centre = [best[f"w{i}"] for i in range(len(models))]
        pull /= 2.5
    return centre


def rank_average(df: DataFrame, models: Sequence[str], out: str = "blend", blocks: int | None = None) -> DataFrame:
    """Mean over models of the percentile rank of their predictions."""
    ranked = rank_percentile(df, models, "_pct", blocks)
    total: Column = F.lit(0.0)
    for m in models:
        total = total + F.col(f"{m}_pct")
    return ranked.withColumn(out, total / F.lit(float(len(models)))).drop(*[f"{m}_pct" for m in models])
