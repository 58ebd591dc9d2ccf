"""Column and projection helpers: null rule, casts, clipping, weights."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schema as S

EPS = 1e-8


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The one missing-value rule: NaN becomes NULL when data comes in."""
    wanted = None if columns is None else set(columns)
    out = []
    for field in df.schema.fields:
        floating = isinstance(field.dataType, (T.FloatType, T.DoubleType))
        if floating and (wanted is None or field.name in wanted):
            out.append(F.when(~F.isnan(field.name), F.col(field.name)).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def drop_leaky_columns(df: DataFrame, columns: Sequence[str] = tuple(S.LEAKY)) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def between_filter(df: DataFrame, column: str, low: int | None, high: int | None) -> DataFrame:
    """Keep rows with ``low <= column <= high``; ``None`` leaves that side open."""
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low))
    if high is not None:
        df = df.where(F.col(column) <= F.lit(high))
    return df


def not_null_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def prepare_xywd(
    df: DataFrame,
    features: Sequence[str],
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
    date: str = S.DATE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Model input: labelled rows, float features, weight with NULL as 0, and the date."""
    return not_null_target(df, target).select(
        *keep,
        *[F.col(c).cast("float").alias(c) for c in features],
        F.col(target).cast("float").alias(target),
        F.coalesce(F.col(weight), F.lit(0.0)).cast("float").alias(weight),
        F.col(date),
    )


def ensure_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the columns a model needs and the table lacks, as typed nulls."""
    missing = {c: F.lit(None).cast("double") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def project_features(
    df: DataFrame, features: Sequence[str], target: str = S.TARGET, weight: str | None = S.WEIGHT
) -> DataFrame:
    """Select features in order, then target and weight; name the ones that do not exist."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"feature columns not in the table: {absent}")
    return df.select(*features, target, *([weight] if weight else []))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def clipped(p: Column, low: float | None = -5.0, high: float | None = 5.0) -> Column:
    """``p`` limited to ``[low, high]``; NULL stays NULL."""
    bounded = p
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    return F.when(p.isNotNull(), bounded)


def error_columns(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    gap = F.col(truth) - F.col(prediction)
    return df.withColumns({"squared_error": gap * gap, "absolute_error": F.abs(gap)})


def conditional_zscore(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std where the deviation is usable, else 0."""
    return F.when(std.isNotNull() & (std > 0), (x - mean) / std).otherwise(F.lit(0.0))


def with_time_decay(
    df: DataFrame,
    weight: str = S.WEIGHT,
    date: str = S.DATE,
    low: float = 0.5,
    high: float = 1.5,
    out: str = "decayed_weight",
) -> DataFrame:
    """Weight times a linear ramp over dates, ``low`` at the first and ``high`` at the last."""
    span = df.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("span")).scalar()
    width = (span["hi"] - span["lo"]).cast("double")
    ramp = F.lit(low) + (F.col(date) - span["lo"]) / width * F.lit(high - low)
    return df.withColumn(out, F.col(weight) * F.when(width == 0, F.lit(1.0)).otherwise(ramp))


def ewm_sample_weight(date: Column, current: Column | int, decay: float) -> Column:
    """``decay ** age`` in dates."""
    now = current if isinstance(current, Column) else F.lit(current)
    return F.pow(F.lit(float(decay)), now - date)


def dynamic_min_leaf(rows: int, reference_rows: int, base: int = 800, floor: int = 100) -> int:
    return max(floor, round(base * (rows / reference_rows) ** 0.5))


def scaled_alpha(alpha: float, rows: int, reference_rows: int) -> float:
    return alpha * rows / reference_rows


def spread_order(key: Column, seed: int = 42) -> Column:
    """A repeatable pseudo-random order in [0, 2^32): the first 32 bits of MD5 over seed and key.

    Seeds give unrelated orders, and any engine with MD5 gives the same ones.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
