"""Constant and per-key baselines: fit gives a small table, predict joins it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.operators.cross import exact_medians
from tickloom.operators.joins import map_lookup_fallback
from tickloom.operators.metrics import FLOOR
from tickloom.session import checkpointed


def weighted_mean(target: str = S.TARGET, weight: str = S.WEIGHT) -> Column:
    """Weighted mean, the plain one if the weights vanish."""
    y, w = F.col(target).cast("double"), F.when(F.col(target).isNotNull(), F.col(weight).cast("double"))
    return F.when(F.sum(w) < FLOOR, F.avg(y)).otherwise(F.try_divide(F.sum(w * y), F.sum(w)))


def weighted_mean_fit(train: DataFrame, target: str = S.TARGET, weight: str = S.WEIGHT) -> DataFrame:
    return train.agg(weighted_mean(target, weight).alias("weighted_mean"))


def median_fit(train: DataFrame, target: str = S.TARGET, blocks: int | None = None) -> DataFrame:
    """Exact median of the target, 0 if there is none."""
    return exact_medians(train, [target], blocks).agg(F.coalesce(F.max("median"), F.lit(0.0)).alias("median"))


def symbol_weighted_mean(
    train: DataFrame, target: str = S.TARGET, weight: str = S.WEIGHT, symbol: str = S.SYMBOL
) -> DataFrame:
    return _symbol_means(_symbol_sums(train, target, weight, symbol), symbol)


def _symbol_sums(train: DataFrame, target: str, weight: str, symbol: str) -> DataFrame:
    """Per entity the sums that its mean and the overall mean need."""
    y, w = F.col(target).cast("double"), F.when(F.col(target).isNotNull(), F.col(weight).cast("double"))
    return train.groupBy(symbol).agg(
        F.sum(w * y).alias("_wy"), F.sum(w).alias("_w"), F.sum(y).alias("_y"), F.count(target).alias("_n")
    )


def _symbol_means(sums: DataFrame, symbol: str) -> DataFrame:
    return sums.select(symbol, F.try_divide("_wy", "_w").alias("symbol_mean"))


def zero_baseline(df: DataFrame) -> DataFrame:
    return df.withColumn(S.PREDICTION, F.lit(0.0))


def weighted_mean_baseline(
    train: DataFrame, df: DataFrame, target: str = S.TARGET, weight: str = S.WEIGHT
) -> DataFrame:
    return df.withColumn(S.PREDICTION, weighted_mean_fit(train, target, weight).scalar())


def median_baseline(train: DataFrame, df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.withColumn(S.PREDICTION, median_fit(train, target).scalar())


def symbol_mean_baseline(
    train: DataFrame, df: DataFrame, target: str = S.TARGET, weight: str = S.WEIGHT, symbol: str = S.SYMBOL
) -> DataFrame:
    """Weighted mean of the entity, the global one for an entity not seen in training."""
    sums = checkpointed(_symbol_sums(train, target, weight, symbol))
    plain, weighted = F.try_divide(F.sum("_y"), F.sum("_n")), F.try_divide(F.sum("_wy"), F.sum("_w"))
    overall = sums.agg(F.when(F.sum("_w") < FLOOR, plain).otherwise(weighted)).scalar()
    return map_lookup_fallback(df, _symbol_means(sums, symbol), [symbol], "symbol_mean", overall, S.PREDICTION)
