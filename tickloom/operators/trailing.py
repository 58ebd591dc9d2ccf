"""Columns that look back over an entity's rows: one description, two ways to compute it.

Window expressions suit few columns or small inputs. A sliding window frame updates every aggregate for
every row of the frame, which costs most of the time with many columns and long windows; then the sorted
rows pass as Arrow batches through one vectorised function that keeps only the rows a frame can reach.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get the batch function itself, so they do not need this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPS = 1e-8
STATS = ("mean", "std", "min", "max", "zscore")


@dataclass(frozen=True)
class Trailing:
    """One output: ``kind`` is "lag" or a statistic, ``size`` the lag or the rows of the window."""

    name: str
    column: str
    kind: str
    size: int
    min_periods: int = 1

    @property
    def reach(self) -> int:
        return self.size if self.kind == "lag" else self.size - 1


def lag_items(columns: Sequence[str], lags: Sequence[int]) -> list[Trailing]:
    return [Trailing(f"{c}_lag{k}", c, "lag", k) for c in columns for k in lags]


def rolling_items(
    columns: Sequence[str], windows: Sequence[int], stats: Sequence[str], min_periods: int = 1
) -> list[Trailing]:
    """Statistics of the last ``win`` rows, the current one included."""
    return [Trailing(f"{c}_roll{w}_{s}", c, s, w, min_periods) for c in columns for w in windows for s in stats]


def reach(items: Sequence[Trailing]) -> int:
    return max(1, *[i.reach for i in items])


def updates_per_row(items: Sequence[Trailing]) -> int:
    """Aggregate updates that sliding frames would make for each row."""
    return sum(i.size for i in items if i.kind != "lag")


def window_columns(items: Sequence[Trailing], w: WindowSpec) -> dict[str, Column]:
    return {i.name: _window_column(i, w) for i in items}


def _window_column(item: Trailing, w: WindowSpec) -> Column:
    if item.kind == "lag":
        return F.lag(item.column, item.size).over(w)
    # Statistics are doubles and NaN is missing, as in Arrow batches.
    c = F.col(item.column).cast("double")
    c = F.when(~F.isnan(c), c)
    frame = w.rowsBetween(-(item.size - 1), 0)
    if item.kind == "zscore":
        value = (c - F.avg(c).over(frame)) / (F.stddev_samp(c).over(frame) + F.lit(EPS))
    else:
        value = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}[item.kind](c).over(frame)
    return F.when(F.count(c).over(frame) >= item.min_periods, value) if item.min_periods > 1 else value


def add_in_windows(df: DataFrame, items: Sequence[Trailing], group: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _lags_known(df.withColumns(window_columns(items, Window.partitionBy(*group).orderBy(*order))), items)


def _lags_known(df: DataFrame, items: Sequence[Trailing]) -> DataFrame:
    """NaN becomes NULL in lagged columns too, in either route."""
    floats = [i.name for i in items if i.kind == "lag" and isinstance(df.schema[i.name].dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def add_in_batches(df: DataFrame, items: Sequence[Trailing], group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same columns from sorted Arrow batches; one shuffle and one sort, like a window."""
    made = [T.StructField(i.name, df.schema[i.column].dataType if i.kind == "lag" else T.DoubleType()) for i in items]
    schema = T.StructType([*df.schema.fields, *made])
    ready = df.repartition(*group).sortWithinPartitions(*group, *order)
    return _lags_known(ready.mapInArrow(_batch_function(list(items), list(group), schema.fieldNames()), schema), items)


def _batch_function(items: list[Trailing], group: list[str], names: list[str]) -> Callable:
    lags = [i for i in items if i.kind == "lag"]
    stats = [i for i in items if i.kind != "lag"]
    columns = list(dict.fromkeys(i.column for i in stats))
    used = list(dict.fromkeys([*group, *columns, *[i.column for i in lags]]))
    back = max([i.reach for i in items])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past: dict[str, pa.Array] | None = None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            rows = {c: batch.column(c) for c in used}
            if past is not None:
                rows = {c: pa.concat_arrays([past[c], rows[c]]) for c in used}
            first = len(rows[used[0]]) - n
            age = _age([rows[c] for c in group])[first:]
            made: dict[str, pa.Array] = {}
            for i in lags:
                at = np.arange(first, first + n) - i.size
                made[i.name] = rows[i.column].take(pa.array(at, mask=age < i.size))
            if stats:
                x = np.vstack([rows[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns])
                for size in sorted({i.size for i in stats}):
                    here = [i for i in stats if i.size == size]
                    values, count = _statistics(x, age, first, size, back, {i.kind for i in here})
                    for i in here:
                        j = columns.index(i.column)
                        value = np.where(count[j] >= i.min_periods, values[i.kind][j], np.nan)
                        made[i.name] = pa.array(value, from_pandas=True)
            past = {c: rows[c].slice(max(0, first + n - back)) for c in used}
            yield pa.RecordBatch.from_arrays([*batch.columns, *[made[i.name] for i in items]], names=names)

    return run


def _age(keys: list[pa.Array]) -> np.ndarray:
    """Rows since the first known row of the same group."""
    n = len(keys[0])
    starts = np.zeros(n, bool)
    starts[0] = True
    for key in keys:
        code = key.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts[1:] |= code[1:] != code[:-1]
    at = np.arange(n)
    return at - np.maximum.accumulate(np.where(starts, at, 0))


def _statistics(
    x: np.ndarray, age: np.ndarray, first: int, size: int, back: int, kinds: set[str]
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics of the last ``size`` rows for the rows from ``first`` on; ``x`` holds one column per line.

    Adds the rows of the frame one offset at a time; deviations are taken from the finished mean.
    """
    n = x.shape[1] - first
    padded = np.hstack([np.full((len(x), back), np.nan), x])
    known = ~np.isnan(padded)
    value = np.where(known, padded, 0.0)
    known = known.astype(float)
    # Offsets that leave the entity for some row get a mask; the others need none.
    inside = {k: age >= k for k in range(int(age.min()) + 1, size)}

    def at(table: np.ndarray, k: int) -> np.ndarray:
        rows = table[:, back + first - k : back + first - k + n]
        return rows * inside[k] if k in inside else rows

    count = np.zeros((len(x), n))
    total = np.zeros_like(count)
    for k in range(size):
        count += at(known, k)
        total += at(value, k)
    out: dict[str, np.ndarray] = {}
    with np.errstate(divide="ignore", invalid="ignore"):
        out["mean"] = total / count
        if kinds & {"std", "zscore"}:
            centre = np.where(count > 0, out["mean"], 0.0)
            square = np.zeros_like(count)
            for k in range(size):
                gap = (value[:, back + first - k : back + first - k + n] - centre) * at(known, k)
                square += gap * gap
            out["std"] = np.where(count > 1, np.sqrt(square / (count - 1)), np.nan)
            out["zscore"] = (x[:, first:] - out["mean"]) / (out["std"] + EPS)
    for kind, pick in (("min", np.fmin), ("max", np.fmax)):
        if kind in kinds:
            out[kind] = np.full_like(count, np.nan)
            for k in range(size):
                rows = padded[:, back + first - k : back + first - k + n]
                out[kind] = pick(out[kind], np.where(inside[k], rows, np.nan) if k in inside else rows)
    return out, count
