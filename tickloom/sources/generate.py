"""A deterministic panel in which every value is a hash of its keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S


def _uniform(name: str, seed: int, *keys: Column) -> Column:
    """In (0, 1), independent of partitioning."""
    h = F.xxhash64(*keys, F.lit(name), F.lit(seed))
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))


def _normal(name: str, seed: int, *keys: Column) -> Column:
    radius = F.sqrt(F.lit(-2.0) * F.log(_uniform(name + "/r", seed, *keys)))
    return radius * F.cos(F.lit(2 * math.pi) * _uniform(name + "/a", seed, *keys))


def generate_panel(
    spark: SparkSession,
    n_dates: int = 10,
    n_times: int = 50,
    n_symbols: int = 20,
    seed: int = 42,
    missing: float = 0.05,
    features: int = 79,
    partitions: int | None = None,
) -> DataFrame:
    """Dates x times x symbols; exponential weights, normal features with missing values, small responders.

    A lag column is the same hash at the step before, so no window is needed.
    """
    rows = spark.range(0, n_dates * n_times * n_symbols, 1, partitions)
    step = F.floor(F.col("id") / F.lit(n_symbols)).alias("_step")
    base = rows.select((F.col("id") % n_symbols).cast("int").alias(S.SYMBOL), step)
    t, s = F.col("_step"), F.col(S.SYMBOL)

    def feature(name: str) -> Column:
        gap = _uniform(name + "/gap", seed, t, s) < F.lit(missing)
        return F.when(~gap, _normal(name, seed, t, s)).cast("float").alias(name)

    def responder(name: str, at: Column) -> Column:
        return (_normal(name, seed, at, s) * F.lit(0.01)).cast("float")

    lagged = [F.when(t > 0, responder(r, t - 1)).alias(f"{r}_lag_1") for r in S.RESPONDERS]
    return base.select(
        F.floor(t / F.lit(n_times)).cast("int").alias(S.DATE),
        (t % n_times).cast("int").alias(S.TIME),
        s,
        (-F.log(_uniform(S.WEIGHT, seed, t, s))).cast("float").alias(S.WEIGHT),
        *[feature(c) for c in S.FEATURES[:features]],
        *[responder(r, t).alias(r) for r in S.RESPONDERS],
        *lagged,
    )
