"""Repeatable samples by group and by count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.functions.scalar import spread_order
from tickloom.plans import sizing
from tickloom.plans.sizing import Split

_RANGE = 1 << 32


def _order(key: str, seed: int) -> list[Column]:
    return [spread_order(F.col(key), seed), F.col(key)]


def group_size(df: DataFrame, group: Sequence[str], out: str = "group_size") -> DataFrame:
    """Add the row count of the own group."""
    if sizing.find_split(df, group) is None:
        return df.withColumn(out, F.count("*").over(Window.partitionBy(*group)))
    return _with_sizes(df, group, out)


def _with_sizes(df: DataFrame, group: Sequence[str], out: str) -> DataFrame:
    sizes = df.groupBy(*group).agg(F.count("*").alias(out))
    return df.join(sizing.lookup_side(sizes), list(group))


def _slices(df: DataFrame, group: list[str], key: str, seed: int, split: Split) -> tuple[DataFrame, DataFrame]:
    """Rows cut in even slices of the pseudo-random order, about one per block of rows of their group.

    Also, per (group, slice), its rows and the rows of the group before it.
    """
    sized = _with_sizes(df, group, "_size")
    number = F.ceil(F.col("_size") / F.lit(split.block_rows))
    place = spread_order(F.col(key), seed) / F.lit(float(_RANGE))
    cut = sized.withColumn("_slice", F.floor(place * number).cast("int"))
    w = Window.partitionBy(*group).orderBy("_slice")
    counts = cut.groupBy(*group, "_slice").agg(F.count("*").alias("_n"))
    return cut, counts.withColumn("_before", F.sum("_n").over(w) - F.col("_n"))


def group_sample_rank(
    df: DataFrame,
    group: Sequence[str],
    key: str,
    seed: int = 42,
    out: str = "sample_rank",
    slices: int | None = None,
) -> DataFrame:
    """Add the place of each row in a pseudo-random order of its group; ``key`` is a unique integer."""
    split = sizing.find_split(df, group, slices)
    if split is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*_order(key, seed))))
    cut, before = _slices(df, list(group), key, seed, split)
    keys = [*group, "_slice"]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(key, seed)))
    joined = cut.withColumn("_number", number).join(sizing.lookup_side(before.drop("_n")), keys)
    return joined.select(*df.columns, (F.col("_before") + F.col("_number")).alias(out))


def sample_by_group(
    df: DataFrame,
    fraction: float | None = 0.2,
    group: Sequence[str] = tuple(S.SNAPSHOT),
    key: str = S.ROW_ID,
    seed: int = 42,
    slices: int | None = None,
) -> DataFrame:
    """Keep max(1, floor(size * fraction)) pseudo-random rows of each group; None or >= 1 keeps all."""
    if fraction is None or fraction >= 1.0:
        return df
    if fraction < 0:
        raise ValueError(f"fraction must not be negative, got {fraction}")
    group = list(group)
    wanted = F.greatest(F.lit(1), F.floor(F.col("_size") * F.lit(fraction)))
    split = sizing.find_split(df, group, slices)
    if split is None:
        w = Window.partitionBy(*group)
        number = F.row_number().over(w.orderBy(*_order(key, seed)))
        marked = df.withColumns({"_number": number, "_size": F.count("*").over(w)})
        return marked.where(F.col("_number") <= wanted).select(*df.columns)
    cut, before = _slices(df, group, key, seed, split)
    keys = [*group, "_slice"]
    # Slices wholly inside the quota pass; only the slice at its edge needs an order.
    near = (
        cut.join(sizing.lookup_side(before), keys)
        .withColumn("_room", wanted - F.col("_before"))
        .where(F.col("_room") > 0)
    )
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(key, seed)))
    whole = near.where(F.col("_room") >= F.col("_n"))
    edge = near.where(F.col("_room") < F.col("_n")).withColumn("_number", number)
    return whole.select(*df.columns).union(edge.where(F.col("_number") <= F.col("_room")).select(*df.columns))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows, the same ones on every run."""
    return df.orderBy(*_order(key, seed)).limit(n)
