"""Feature steps and their chain.

A step names its outputs and adds them to a table. The chain joins neighbouring per-entity steps into one
pass, so lags, rolling statistics and their look-back rows share one shuffle and one sort.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tickloom import schema as S
from tickloom.operators import cross, trailing, windows
from tickloom.operators.blocks import entity_windows
from tickloom.operators.trailing import Trailing


class Step:
    """Contract of a feature step: ``fit``, then ``transform`` adds ``feature_names_out``."""

    fitted = False

    def names(self) -> list[str]:
        raise NotImplementedError

    def add(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def learn(self, df: DataFrame) -> None:
        """Override in steps that learn something from the data."""

    def fit(self, df: DataFrame) -> "Step":
        self.learn(df)
        self.fitted = True
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise RuntimeError(f"{type(self).__name__}: call fit before transform")
        return self.add(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    @property
    def feature_names_out(self) -> list[str]:
        return self.names()


@dataclass
class EntityStep(Step):
    """A step whose columns look back over the entity's rows in order."""

    columns: list[str]
    entity: list[str] = field(default_factory=lambda: list(windows.ENTITY), kw_only=True)
    order: list[str] = field(default_factory=lambda: list(windows.ORDER), kw_only=True)
    blocks: int | None = field(default=None, kw_only=True)
    batches: bool | None = field(default=None, kw_only=True)

    def items(self) -> list[Trailing]:
        raise NotImplementedError

    @property
    def reach(self) -> int:
        return trailing.reach(self.items())

    def names(self) -> list[str]:
        return [i.name for i in self.items()]

    def placement(self) -> tuple:
        return (self.entity, self.order, self.blocks, self.batches)

    def add(self, df: DataFrame) -> DataFrame:
        return add_entity_steps(df, [self])


def add_entity_steps(df: DataFrame, steps: Sequence[EntityStep]) -> DataFrame:
    """All steps in one pass; they must agree on entity and order."""
    first = steps[0]
    items = [i for step in steps for i in step.items()]
    return entity_windows(
        df, items, entity=first.entity, order=first.order, blocks=first.blocks, batches=first.batches
    )


@dataclass
class LagStep(EntityStep):
    lags: list[int]

    def __post_init__(self) -> None:
        windows.check_lags(self.lags)

    def items(self) -> list[Trailing]:
        return trailing.lag_items(self.columns, self.lags)


@dataclass
class RollingStep(EntityStep):
    windows: list[int]
    stats: list[str] = field(default_factory=lambda: ["mean", "std"])
    min_periods: int = 1

    def __post_init__(self) -> None:
        windows.check_rolling(self.windows, self.stats)

    def items(self) -> list[Trailing]:
        return trailing.rolling_items(self.columns, self.windows, self.stats, self.min_periods)


@dataclass
class EwmStep(Step):
    columns: list[str]
    spans: list[float] = field(default_factory=lambda: [5.0, 10.0, 20.0])
    entity: list[str] = field(default_factory=lambda: list(windows.ENTITY))
    order: list[str] = field(default_factory=lambda: list(windows.ORDER))
    blocks: int | None = None

    def names(self) -> list[str]:
        return [f"{c}_ewm{int(s)}" for c in self.columns for s in self.spans]

    def add(self, df: DataFrame) -> DataFrame:
        return windows.ewm_mean(df, self.columns, self.spans, self.entity, self.order, self.blocks)


class SnapshotStep(Step):
    """A step over the rows of one snapshot."""

    group: list[str]

    def add(self, df: DataFrame, sized_by: DataFrame | None = None) -> DataFrame:
        raise NotImplementedError


@dataclass
class RankStep(SnapshotStep):
    columns: list[str]
    method: str = "average"
    normalize: bool = True
    group: list[str] = field(default_factory=lambda: list(S.SNAPSHOT))
    tiebreak: list[str] = field(default_factory=list)
    blocks: int | None = None

    def names(self) -> list[str]:
        return [f"{c}_xrank{'_norm' if self.normalize else ''}" for c in self.columns]

    def add(self, df: DataFrame, sized_by: DataFrame | None = None) -> DataFrame:
        return cross.xs_rank(
            df, self.columns, self.group, self.method, self.normalize, self.tiebreak,
            blocks=self.blocks, sized_by=sized_by,
        )


@dataclass
class ZScoreStep(SnapshotStep):
    columns: list[str]
    group: list[str] = field(default_factory=lambda: list(S.SNAPSHOT))
    safe: bool = False
    blocks: int | None = None

    def names(self) -> list[str]:
        return [f"{c}_{'cs_zscore' if self.safe else 'xzscore'}" for c in self.columns]

    def add(self, df: DataFrame, sized_by: DataFrame | None = None) -> DataFrame:
        scored = cross.cs_zscore_safe if self.safe else cross.xs_zscore
        return scored(df, self.columns, self.group, self.blocks, sized_by)


@dataclass
class FunctionStep(Step):
    """A user's own function from table to table."""

    function: Callable[[DataFrame], DataFrame]
    outputs: list[str]

    def names(self) -> list[str]:
        return list(self.outputs)

    def add(self, df: DataFrame) -> DataFrame:
        out = df.transform(self.function)
        absent = [c for c in [*df.columns, *self.outputs] if c not in out.columns]
        if absent:
            raise ValueError(f"the function must keep its input and add its outputs; missing {absent}")
        return out


KINDS: dict[str, type[Step]] = {
    "lag": LagStep,
    "rolling": RollingStep,
    "ewm": EwmStep,
    "rank": RankStep,
    "zscore": ZScoreStep,
}


class FeatureChain:
    """Steps applied in order, and the resulting feature list."""

    def __init__(self, steps: Sequence[Step], feature_cols: Sequence[str] | None = None) -> None:
        self.steps = list(steps)
        self._explicit = list(feature_cols) if feature_cols is not None else None
        self._feature_cols: list[str] | None = None

    def fit(self, df: DataFrame) -> "FeatureChain":
        """Fit every step on the output of those before it; plans only, nothing is computed."""
        available = set(df.columns)
        current = df
        for step in self.steps:
            step.fit(current)
            if isinstance(step, FunctionStep) or type(step).learn is not Step.learn:
                current = self._apply(df, upto=step)
                available |= set(current.columns)
            available |= set(step.names())
        names = self._explicit or list(dict.fromkeys(n for s in self.steps for n in s.names()))
        absent = [n for n in names if n not in available]
        if absent:
            raise ValueError(f"feature columns not produced: {absent}")
        if not names:
            raise ValueError("the chain produces no features")
        self._feature_cols = names
        return self

    def _apply(self, df: DataFrame, upto: Step | None = None) -> DataFrame:
        pending: list[EntityStep] = []
        # Steps add columns, never rows, so groups are counted on the plain input.
        source = df

        def flush(table: DataFrame) -> DataFrame:
            out = add_entity_steps(table, pending) if pending else table
            pending.clear()
            return out

        for step in self.steps:
            if isinstance(step, EntityStep):
                made = {n for p in pending for n in p.names()}
                alike = not pending or pending[0].placement() == step.placement()
                if not alike or made & set(step.columns):
                    df = flush(df)
                pending.append(step)
            elif isinstance(step, SnapshotStep) and step.fitted and set(step.group) <= set(source.columns):
                df = step.add(flush(df), sized_by=source)
            else:
                df = step.transform(flush(df))
                if isinstance(step, FunctionStep):
                    source = df
            if step is upto:
                break
        return flush(df)

    def transform(self, df: DataFrame) -> DataFrame:
        if self._feature_cols is None:
            raise RuntimeError("FeatureChain: call fit before transform")
        return self._apply(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    @property
    def feature_names_out(self) -> list[str]:
        if self._feature_cols is None:
            raise RuntimeError("FeatureChain: call fit before asking for its features")
        return list(self._feature_cols)

    def to_spec(self) -> dict[str, Any]:
        kinds = {cls: name for name, cls in KINDS.items()}
        unknown = [type(s).__name__ for s in self.steps if type(s) not in kinds]
        if unknown:
            raise ValueError(f"steps without a stored form: {unknown}")
        steps = [{"kind": kinds[type(s)], **asdict(s)} for s in self.steps]
        return {"steps": steps, "feature_cols": self._explicit, "fitted": self._feature_cols}

    @classmethod
    def from_spec(cls, spec: dict[str, Any]) -> "FeatureChain":
        steps = []
        for stored in spec["steps"]:
            options = {k: v for k, v in stored.items() if k != "kind"}
            step = KINDS[stored["kind"]](**options)
            step.fitted = spec["fitted"] is not None
            steps.append(step)
        chain = cls(steps, spec["feature_cols"])
        chain._feature_cols = spec["fitted"]
        return chain

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the fitted chain as JSON text on the cluster's file system."""
        text = spark.createDataFrame([(json.dumps(self.to_spec()),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureChain":
        return cls.from_spec(json.loads(spark.read.text(path).first()["value"]))


# The default feature set.
DEFAULT_CONFIG: dict[str, Any] = {
    "lag": {"columns": ["responder_0_lag_1", "responder_6_lag_1"], "windows": [2, 4]},
    "rolling": {
        "columns": [f"feature_{i:02d}" for i in range(10)] + ["responder_0_lag_1", "responder_6_lag_1"],
        "windows": [5, 10, 20],
        "stats": ["mean", "std"],
    },
    "cross_sectional": {
        "columns": ["feature_00", "feature_01", "feature_02", "responder_6_lag_1"],
        "rank_method": "average",
        "normalize": True,
    },
}


def build_features(config: dict[str, Any] | None = None, order: Sequence[str] = windows.ORDER) -> FeatureChain:
    """Lag, rolling and cross-sectional steps from a config; each can be switched off."""
    config = DEFAULT_CONFIG if config is None else config
    steps: list[Step] = []
    lag, rolling, cross_cfg = (config.get(k) or {} for k in ("lag", "rolling", "cross_sectional"))
    if lag and lag.get("enabled", True):
        steps.append(LagStep(list(lag["columns"]), list(lag["windows"]), order=list(order)))
    if rolling and rolling.get("enabled", True):
        stats = list(rolling.get("stats", ["mean", "std"]))
        steps.append(RollingStep(list(rolling["columns"]), list(rolling["windows"]), stats, order=list(order)))
    if cross_cfg and cross_cfg.get("enabled", True):
        method = cross_cfg.get("rank_method", "average")
        steps.append(RankStep(list(cross_cfg["columns"]), method, cross_cfg.get("normalize", True)))
    return FeatureChain(steps)
