"""Lag, rolling and exponentially weighted columns per entity."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.operators.blocks import BLOCK, entity_windows, with_blocks
from tickloom.operators.trailing import STATS, lag_items, rolling_items
from tickloom.plans import sizing

ENTITY = (S.SYMBOL,)
ORDER = (S.DATE, S.TIME)


def check_lags(lags: Sequence[int]) -> None:
    if not lags or any(k <= 0 for k in lags):
        raise ValueError(f"lags must be positive, got {list(lags)}")


def check_rolling(windows: Sequence[int], stats: Sequence[str]) -> None:
    if not windows or any(w <= 0 for w in windows):
        raise ValueError(f"windows must be positive, got {list(windows)}")
    unknown = sorted(set(stats) - set(STATS))
    if unknown:
        raise ValueError(f"unknown statistics {unknown}, choose from {list(STATS)}")


def lag_features(
    df: DataFrame,
    columns: Sequence[str],
    lags: Sequence[int],
    entity: Sequence[str] = ENTITY,
    order: Sequence[str] = ORDER,
    blocks: int | None = None,
    batches: bool | None = None,
) -> DataFrame:
    """The value ``k`` rows earlier of the same entity, across dates and gaps."""
    check_lags(lags)
    return entity_windows(df, lag_items(columns, lags), entity=entity, order=order, blocks=blocks, batches=batches)


def rolling_features(
    df: DataFrame,
    columns: Sequence[str],
    windows: Sequence[int],
    stats: Sequence[str] = ("mean", "std"),
    entity: Sequence[str] = ENTITY,
    order: Sequence[str] = ORDER,
    min_periods: int = 1,
    blocks: int | None = None,
    batches: bool | None = None,
) -> DataFrame:
    """Statistics of the last rows of the same entity, the current row included."""
    check_rolling(windows, stats)
    items = rolling_items(columns, windows, stats, min_periods)
    return entity_windows(df, items, entity=entity, order=order, blocks=blocks, batches=batches)


def _run_length(decay: float) -> int:
    """Values per run, such that ``decay ** run`` is about 1e-300."""
    return max(1, int(300 / -math.log10(decay)))


def ewm_mean(
    df: DataFrame,
    columns: Sequence[str],
    spans: Sequence[float] = (5.0, 10.0, 20.0),
    entity: Sequence[str] = ENTITY,
    order: Sequence[str] = ORDER,
    blocks: int | None = None,
) -> DataFrame:
    """y0 = x0, then y = a*x + (1-a)*previous with a = 2/(span+1); a missing x keeps the previous y.

    The recursion is written as running sums. A block's values are cut in runs; within a run the sum is
    scaled by powers of the decay, centred so that neither end overflows. Of earlier runs only the last
    one still counts, since a value two runs back has a weight below 1e-300. What enters a block from
    before decays with the number of values seen, so one start value per block is enough.
    """
    if not spans or any(s < 1 for s in spans):
        raise ValueError(f"spans must be at least 1, got {list(spans)}")
    split = sizing.find_split(df, entity, blocks)
    single = split is None
    rows = df.withColumn(BLOCK, F.lit(0)) if single else with_blocks(df, entity, order, split)
    group = [*entity, BLOCK]
    w = Window.partitionBy(*group).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_seen_{c}": F.count(c).over(upto) for c in columns})

    outputs = {f"{c}_ewm{int(s)}": (c, 2.0 / (s + 1.0)) for c in columns for s in spans}
    for name, (c, alpha) in outputs.items():
        decay = max(1.0 - alpha, 1e-300)
        run = _run_length(decay)
        number = F.floor((F.greatest(F.col(f"_seen_{c}"), F.lit(1)) - 1) / F.lit(run))
        rows = rows.withColumn("_run", number)
        at = F.col(f"_seen_{c}") - F.col("_run") * run
        in_run = Window.partitionBy(*group, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        grown = F.sum(F.col(c) * F.lit(alpha) * F.pow(F.lit(decay), F.lit(run / 2) - at)).over(in_run)
        local = F.coalesce(grown * F.pow(F.lit(decay), at - F.lit(run / 2)), F.lit(0.0))
        rows = rows.withColumns({"_at": at, "_local": local})
        run_end = F.when(F.col(c).isNotNull() & (F.col("_at") == run), F.col("_local"))
        carried = F.coalesce(F.last(run_end, ignorenulls=True).over(before), F.lit(0.0))
        rows = rows.withColumn(f"_own_{name}", F.col("_local") + F.pow(F.lit(decay), F.col("_at")) * carried)
    rows = rows.drop("_run", "_at", "_local")

    starts = {f"_first_{name}": F.first(c, ignorenulls=True).over(upto) for name, (c, _) in outputs.items()}
    rows = rows.withColumns(starts)
    if not single:
        rows = rows.join(_block_starts(rows, outputs, entity, order), group, "left")
        starts = {f"_first_{n}": F.coalesce(f"_start_{n}", f"_first_{n}") for n in outputs}
        rows = rows.withColumns(starts)
    results = {
        name: F.col(f"_own_{name}")
        + F.pow(F.lit(max(1.0 - alpha, 1e-300)), F.col(f"_seen_{c}")) * F.col(f"_first_{name}")
        for name, (c, alpha) in outputs.items()
    }
    return rows.select(*df.columns, *[v.alias(k) for k, v in results.items()])


_FOLD = "struct<y:double,out:array<double>>"


def _fold_step(name: str, alpha: float):
    """One block of the fold: note what enters it, pass on what leaves it."""
    decay = F.lit(max(1.0 - alpha, 1e-300))

    def step(acc: Column, block: Column) -> Column:
        b = block[name]
        enters = F.coalesce(acc["y"], b["first"].cast("double"))
        leaves = F.when(b["seen"] == 0, acc["y"]).otherwise(b["own"] + F.pow(decay, b["seen"]) * enters)
        return F.struct(leaves.alias("y"), F.concat(acc["out"], F.array(acc["y"])).alias("out")).cast(_FOLD)

    return step


def _block_starts(
    rows: DataFrame, outputs: dict[str, tuple[str, float]], entity: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The value that enters each block of an entity: a fold over at most one entry per block."""
    ends = {}
    for name, (c, _) in outputs.items():
        seen = F.col(f"_seen_{c}")
        ends[name] = F.struct(
            F.max_by(f"_own_{name}", seen).alias("own"),
            F.max(seen).alias("seen"),
            F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias("first"),
        ).alias(name)
    per_block = rows.groupBy(*entity, BLOCK).agg(*ends.values())
    listed = per_block.groupBy(*entity).agg(
        F.sort_array(F.collect_list(F.struct(BLOCK, *outputs))).alias("_blocks")
    )
    folds = {}
    for name, (_, alpha) in outputs.items():
        start = F.struct(F.lit(None).cast("double").alias("y"), F.array().cast("array<double>").alias("out"))
        folds[f"_start_{name}"] = F.aggregate("_blocks", start.cast(_FOLD), _fold_step(name, alpha), lambda acc: acc["out"])
    numbers = F.transform("_blocks", lambda b: b[BLOCK]).alias(BLOCK)
    zipped = listed.select(*entity, numbers, *[f.alias(k) for k, f in folds.items()])
    return zipped.select(*entity, F.inline(F.arrays_zip(BLOCK, *folds)))
