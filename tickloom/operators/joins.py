"""Joins on panel keys, dates and fitted values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.plans import sizing


def join_lag(panel: DataFrame, lag: DataFrame, keys: Sequence[str] = tuple(S.KEYS)) -> DataFrame:
    """Add the lagged responders; both sides are large, so both shuffle on the full key."""
    return panel.join(lag, list(keys), "left")


def join_group_stats(df: DataFrame, stats: DataFrame, group: Sequence[str] = tuple(S.SNAPSHOT)) -> DataFrame:
    return df.join(sizing.lookup_side(stats), list(group), "left")


def join_oof(
    panel: DataFrame, oof: DataFrame, prediction: str = "oof_prediction", keys: Sequence[str] = tuple(S.KEYS)
) -> DataFrame:
    """Rows that have an out-of-fold prediction, with it."""
    return panel.join(oof.select(*keys, prediction), list(keys), "inner")


def last_n_steps(df: DataFrame, n: int, step: Sequence[str] = tuple(S.SNAPSHOT)) -> DataFrame:
    """The last ``n`` distinct steps."""
    return df.select(*step).distinct().orderBy(*[F.col(c).desc() for c in step]).limit(n)


def semi_join_last_steps(df: DataFrame, n: int, step: Sequence[str] = tuple(S.SNAPSHOT)) -> DataFrame:
    """Rows of the last ``n`` steps. At most ``n`` keys, so they are broadcast."""
    return df.join(F.broadcast(last_n_steps(df, n, step)), list(step), "left_semi")


def map_lookup_fallback(
    df: DataFrame, values: DataFrame, keys: Sequence[str], value: str, fallback: Column, out: str
) -> DataFrame:
    """The value fitted for the row's key, else ``fallback``."""
    found = df.join(sizing.lookup_side(values.select(*keys, F.col(value).alias("_found"))), list(keys), "left")
    return found.select(*df.columns, F.coalesce("_found", fallback).alias(out))


def align_models(
    members: dict[str, DataFrame],
    keys: Sequence[str] = tuple(S.KEYS),
    prediction: str = "oof_prediction",
) -> DataFrame:
    """One row per key with one prediction column per model; keys that a model lacks are left out.

    One shuffle for all members, and a hot key is combined before it.
    """
    stacked = None
    for name, df in members.items():
        part = df.select(*keys, F.lit(name).alias("_model"), F.col(prediction).cast("double").alias("_p"))
        stacked = part if stacked is None else stacked.unionByName(part)
    wide = stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_model") == m, F.col("_p"))).alias(m) for m in members],
        *[F.max(F.when(F.col("_model") == m, F.lit(1))).alias(f"_has_{m}") for m in members],
    )
    complete = wide.dropna(subset=[f"_has_{m}" for m in members])
    return complete.select(*keys, *members)
