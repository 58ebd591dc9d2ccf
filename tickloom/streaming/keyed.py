"""The same features with each entity's buffer in Spark's state store.

Rows that are not later than their entity's buffer are late: they are written without features, flagged, and read
apart (``late``), so none vanishes. For low latency on a few rows per entity and batch. An entity's rows of one batch pass one task, so the
batch size bounds what a task holds; with very uneven entities use ``FeatureStream``, which splits them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom import schema as S
from tickloom.operators.windows import ORDER, check_lags, check_rolling
from tickloom.session import scratch_path

# Workers get the processor itself, so they do not need this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Cells of the windows that are looked at together.
_CELLS = 1 << 20


def rolling_stats(values: np.ndarray, window: int, stats: Sequence[str]) -> dict[str, np.ndarray]:
    """Statistics of the last ``window`` values up to each; missing and infinite ones do not count."""
    x = np.where(np.isfinite(values), values, np.nan)
    padded = np.concatenate([np.full(window - 1, np.nan), x])
    windows = np.lib.stride_tricks.sliding_window_view(padded, window)
    out = {stat: np.empty(len(x)) for stat in ("mean", "std", "min", "max")}
    step = max(1, _CELLS // window)
    for at in range(0, len(x), step):
        part, to = windows[at : at + step], slice(at, at + step)
        known = ~np.isnan(part)
        n = known.sum(1)
        n1 = np.maximum(n, 1)
        low = np.where(known, part, np.inf).min(1)
        high = np.where(known, part, -np.inf).max(1)
        mean = np.where(low == high, low, np.where(known, part, 0.0).sum(1) / n1)
        apart = np.where(known, part - mean[:, None], 0.0)
        std = np.sqrt((apart * apart).sum(1) / np.maximum(n - 1, 1))
        for stat, found, least in (("mean", mean, 1), ("std", std, 2), ("min", low, 1), ("max", high, 1)):
            out[stat][to] = np.where(n >= least, found, np.nan)
    if "zscore" in stats:
        out["zscore"] = (values - out["mean"]) / (out["std"] + 1e-8)
    return {stat: out[stat] for stat in stats}


def trailing_columns(
    rows: dict[str, np.ndarray],
    rolling: Sequence[str],
    windows: Sequence[int],
    stats: Sequence[str],
    lagged: Sequence[str],
    lags: Sequence[int],
) -> dict[str, np.ndarray]:
    """Rolling and lag columns of one entity's rows, oldest first."""
    made: dict[str, np.ndarray] = {}
    for c in rolling:
        for w in windows:
            for stat, value in rolling_stats(rows[c], w, stats).items():
                made[f"{c}_roll{w}_{stat}"] = value
    for c in lagged:
        for k in lags:
            made[f"{c}_lag{k}"] = np.concatenate([np.full(min(k, len(rows[c])), np.nan), rows[c][:-k]])
    return made


def in_order(rows: pd.DataFrame, order: Sequence[str]) -> pd.DataFrame:
    """Rows sorted by ``order``, missing values last, ties as they came."""
    columns = [rows[c].to_numpy() for c in reversed(order)]
    if any(c.dtype.kind not in "iufM" for c in columns):
        return rows.sort_values(list(order), kind="stable")
    place = np.lexsort(columns)
    return rows if (place[1:] > place[:-1]).all() else rows.iloc[place]


def plain_values(column: pd.Series) -> list:
    """Python values with None for what is missing."""
    values = column.to_numpy()
    if values.dtype.kind in "iub":
        return values.tolist()
    if values.dtype.kind == "f":
        return [None if v != v else v for v in values.tolist()]
    values = column.astype(object)
    return values.where(values.notna(), None).tolist()


def later_than(rows: pd.DataFrame, order: Sequence[str], last: tuple) -> np.ndarray:
    """Which rows come after ``last`` in the order of ``order`` (lexicographic), column by column."""
    later = np.zeros(len(rows), dtype=bool)
    equal = np.ones(len(rows), dtype=bool)
    for c, v in zip(order, last):
        values = rows[c].to_numpy()
        later |= equal & (values > v)
        equal &= values == v
    return later


class BufferProcessor(StatefulProcessor):
    """Buffered rows plus new rows give the features; the newest rows become the buffer."""

    def __init__(self, state_schema: T.StructType, names: list[str], order: list[str], size: int, spec: dict) -> None:
        self.state_schema = state_schema
        self.fields = state_schema.fieldNames()
        self.names = names
        self.order = order
        self.size = size
        self.spec = spec

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getListState("buffer", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        new = in_order(frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True), self.order)
        past = [tuple(r) for r in self.buffer.get()]
        if past:
            last = dict(zip(self.fields, past[-1]))
            later = later_than(new, self.order, tuple(np.nan if last[c] is None else last[c] for c in self.order))
            if not later.all():
                late = new[~later]
                # Rows not later than the buffer would rewrite the past: they pass without features, flagged.
                yield pd.concat([late.reset_index(drop=True), pd.DataFrame(np.nan, index=range(len(late)), columns=self.names)], axis=1).assign(late=True)
                new = new[later]
        if new.empty:
            return
        both = {}
        for c in {*self.spec["rolling"], *self.spec["lagged"]}:
            at = self.fields.index(c)
            before = np.array([np.nan if r[at] is None else r[at] for r in past], dtype="float64")
            both[c] = np.concatenate([before, new[c].to_numpy(dtype="float64", na_value=np.nan)])
        made = trailing_columns(both, **self.spec)
        tail = new.iloc[-self.size :]
        kept = [*past, *zip(*[plain_values(tail[c]) for c in self.fields])]
        self.buffer.put(kept[-self.size :])
        columns = {c: new[c].array for c in new.columns} | {n: made[n][len(past) :] for n in self.names}
        yield pd.DataFrame({**columns, "late": np.zeros(len(new), dtype=bool)})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        rows = initialState.sort_values(self.order, kind="stable")[self.fields].tail(self.size).astype(object)
        rows = rows.where(rows.notna(), None)
        self.buffer.put([tuple(r) for r in rows.itertuples(index=False, name=None)])

    def close(self) -> None:
        pass


@dataclass
class KeyedFeatureStream:
    spark: SparkSession
    columns: T.StructType
    rolling: Sequence[str] = ()
    windows: Sequence[int] = (5,)
    stats: Sequence[str] = ("mean",)
    lagged: Sequence[str] = ()
    lags: Sequence[int] = (1,)
    order: Sequence[str] = ORDER
    symbol: str = S.SYMBOL
    buffer_size: int = 30
    home: str = field(default="")

    def __post_init__(self) -> None:
        check_rolling(self.windows, self.stats)
        check_lags(self.lags)
        need = max([*(w - 1 for w in self.windows if self.rolling), *(k for k in self.lags if self.lagged), 1])
        if self.buffer_size < need:
            raise ValueError(f"a buffer of {self.buffer_size} rows cannot feed features that reach back {need}")
        self.home = self.home or scratch_path(self.spark, "keyed")

    def names(self) -> list[str]:
        rolled = [f"{c}_roll{w}_{s}" for c in self.rolling for w in self.windows for s in self.stats]
        return rolled + [f"{c}_lag{k}" for c in self.lagged for k in self.lags]

    def transform(self, stream: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """The stream with features; ``history`` fills the buffers of a new query."""
        kept = list(dict.fromkeys([*self.order, *self.rolling, *self.lagged]))
        state_schema = T.StructType([self.columns[c] for c in kept])
        out_schema = T.StructType(
            [*self.columns.fields, *[T.StructField(n, T.DoubleType()) for n in self.names()], T.StructField("late", T.BooleanType())]
        )
        spec = {
            "rolling": list(self.rolling), "windows": list(self.windows), "stats": list(self.stats),
            "lagged": list(self.lagged), "lags": list(self.lags),
        }
        processor = BufferProcessor(state_schema, self.names(), list(self.order), self.buffer_size, spec)
        initial = history.select(self.symbol, *kept).groupBy(self.symbol) if history is not None else None
        return stream.select(*self.columns.names).groupBy(self.symbol).transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=out_schema, outputMode="Append", timeMode="None",
            initialState=initial,
        )

    def run(self, stream: DataFrame, history: DataFrame | None = None) -> StreamingQuery:
        before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, _ROCKSDB)
        try:
            query = (
                self.transform(stream, history)
                .writeStream.format("parquet")
                .outputMode("append")
                .option("checkpointLocation", f"{self.home}/checkpoint")
                .option("path", f"{self.home}/output")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        finally:
            if before is None:
                self.spark.conf.unset(_PROVIDER)
            else:
                self.spark.conf.set(_PROVIDER, before)
        return query

    def _written(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.home}/output")

    def output(self) -> DataFrame:
        """Rows with features."""
        return self._written().where(~F.col("late")).drop("late")

    def late(self) -> DataFrame:
        """Rows that were not later than their entity's buffer, without features; kept, not applied."""
        return self._written().where(F.col("late")).select(*self.columns.names)

    def late_rows(self) -> int:
        return self._written().where(F.col("late")).count()
