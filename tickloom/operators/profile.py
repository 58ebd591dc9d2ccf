"""Descriptive tables of a panel: missing values, moments, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S


def missing_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of missing values per column, highest first; one pass."""
    shares = df.agg(*[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in columns])
    long = shares.unpivot([], list(columns), "column", "missing_rate")
    return long.orderBy(F.desc("missing_rate"), "column")


def missing_counts(rates: DataFrame, high: float = 0.30) -> DataFrame:
    """How many columns miss more than ``high`` and how many miss any value."""
    return rates.agg(
        F.count_if(F.col("missing_rate") > high).alias("n_high"), F.count_if(F.col("missing_rate") > 0).alias("n_any")
    )


def overview_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(
        F.count("*").alias("n_rows"),
        distinct(S.DATE).alias("n_dates"),
        distinct(S.TIME).alias("n_times"),
        distinct(S.SYMBOL).alias("n_symbols"),
        F.min(S.DATE).alias("first_date"),
        F.max(S.DATE).alias("last_date"),
    )


def daily_mean_target(df: DataFrame, target: str = S.TARGET, date: str = S.DATE) -> DataFrame:
    return df.groupBy(date).agg(F.avg(target).alias("mean_target")).orderBy(date)


def target_moments(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.agg(
        F.avg(target).alias("mean"),
        F.stddev_pop(target).alias("std"),
        F.min(target).alias("min"),
        F.max(target).alias("max"),
        F.skewness(target).alias("skew"),
    )


def zero_weight_share(df: DataFrame, weight: str = S.WEIGHT) -> DataFrame:
    known = df.where(F.col(weight).isNotNull())
    return known.agg(F.avg(F.when(F.col(weight) == 0, 1.0).otherwise(0.0)).alias("zero_weight_share"))


def distinct_per_date(df: DataFrame, date: str = S.DATE) -> DataFrame:
    """Distinct entities and time steps per date.

    Each count is taken from its own distinct pairs, so a date with very many rows is split by entity or
    step before it is counted.
    """
    symbols = df.select(date, S.SYMBOL).distinct().groupBy(date).agg(F.count("*").alias("n_symbols"))
    times = df.select(date, S.TIME).distinct().groupBy(date).agg(F.count("*").alias("n_times"))
    return symbols.join(times, date).orderBy(date)


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin from 0; the top edge belongs to the last bin."""
    place = F.floor((x - low) / (high - low) * F.lit(float(bins)))
    return F.when(high == low, F.lit(0)).otherwise(F.least(place, F.lit(bins - 1))).cast("int")


def _range(df: DataFrame, column: str) -> Column:
    return df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width bin counts between minimum and maximum; empty bins are listed with 0."""
    span = _range(df, column)
    low, high = span["lo"].cast("double"), span["hi"].cast("double")
    known = df.where(F.col(column).isNotNull())
    counted = known.groupBy(_bin(F.col(column).cast("double"), low, high, bins).alias("bin")).agg(
        F.count("*").alias("n")
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    left = low + F.col("bin") * (high - low) / F.lit(float(bins))
    return (
        every.join(counted, "bin", "left")
        .select("bin", left.alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("bin")
    )


def density_2d(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Counts of the non-empty cells of a square grid."""
    sx, sy = _range(df, x), _range(df, y)
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.groupBy(
        _bin(F.col(x).cast("double"), sx["lo"].cast("double"), sx["hi"].cast("double"), bins).alias("x_bin"),
        _bin(F.col(y).cast("double"), sy["lo"].cast("double"), sy["hi"].cast("double"), bins).alias("y_bin"),
    ).agg(F.count("*").alias("n"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair below the diagonal, rows with both values; one pass."""
    pairs = list(combinations(range(len(columns)), 2))
    one = df.agg(*[F.corr(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs])
    cells = [
        F.struct(
            F.lit(columns[j]).alias("column"), F.lit(columns[i]).alias("other"), F.col(f"c{i}_{j}").alias("corr")
        )
        for i, j in pairs
    ]
    return one.select(F.inline(F.array(*cells)))


def lag_leakage_corr(df: DataFrame, target: str, lagged: str, limit: float = 0.99) -> DataFrame:
    """Correlation of the target with its lag and whether it is suspiciously high."""
    corr = df.agg(F.corr(target, lagged).alias("corr"))
    return corr.withColumn("warning", F.coalesce(F.abs("corr") > limit, F.lit(False)))


def daily_regime_stats(df: DataFrame, columns: Sequence[str], date: str = S.DATE) -> DataFrame:
    """Mean and sample deviation per date of the columns that describe the regime."""
    return df.groupBy(date).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}_std") for c in columns]
    )


def regimes(stats: DataFrame, k: int = 3, seed: int = 42, date: str = S.DATE) -> DataFrame:
    """Regime of each date by a Gaussian mixture over its daily statistics."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import VectorAssembler

    inputs = [c for c in stats.columns if c != date]
    vectors = VectorAssembler(inputCols=inputs, outputCol="_stats").transform(stats.na.drop(subset=inputs))
    model = GaussianMixture(k=k, seed=seed, featuresCol="_stats", predictionCol="regime").fit(vectors)
    return model.transform(vectors).select(date, "regime")
