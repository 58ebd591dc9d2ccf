"""Regressors, folds and searches as Spark ML jobs.

The driver loops over folds and parameters; every fit, prediction and score is a distributed job.
"""

from __future__ import annotations

import itertools
import math
import random
import statistics
import threading
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.functions.scalar import dynamic_min_leaf, scaled_alpha, with_time_decay
from tickloom.operators import cross, metrics, splits
from tickloom.operators.sampling import sample_by_group
from tickloom.plans import sizing
from tickloom.session import checkpointed, written

VECTOR = "_features"

# Starting parameters of the three boosting set-ups.
PRESETS: dict[str, dict[str, Any]] = {
    "leafwise": {
        "n_estimators": 1000, "learning_rate": 0.05, "num_leaves": 128, "max_depth": -1,
        "min_child_samples": 50, "feature_fraction": 0.8, "bagging_fraction": 0.8, "random_state": 42,
    },
    "depthwise": {
        "n_estimators": 1000, "learning_rate": 0.05, "max_depth": 6, "min_child_weight": 50,
        "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42,
    },
    "symmetric": {"iterations": 1000, "learning_rate": 0.05, "depth": 6, "random_seed": 42},
}
# The parameters chosen by the staged search.
FINAL_PARAMS: dict[str, Any] = {
    "learning_rate": 0.05, "num_leaves": 31, "max_depth": 5, "min_data_in_leaf": 500,
    "feature_fraction": 0.6, "bagging_fraction": 1.0, "random_state": 42, "n_estimators": 232,
}
# The three stages of the grid search.
GRIDS: list[dict[str, list[Any]]] = [
    {"num_leaves": [31, 47, 63, 90], "max_depth": [5, 6, 7], "min_data_in_leaf": [500, 800, 2000]},
    {"feature_fraction": [0.6, 0.8, 1.0], "bagging_fraction": [0.6, 0.8, 1.0], "lambda_l2": [0.0, 2.0, 5.0, 10.0]},
    {"learning_rate": [0.01, 0.015, 0.02, 0.025, 0.03, 0.05]},
]
# Search ranges as (kind, low, high) per set-up.
SPACES: dict[str, dict[str, tuple[str, float, float]]] = {
    "leafwise": {
        "learning_rate": ("log", 0.01, 0.2), "num_leaves": ("logint", 31, 512),
        "min_child_samples": ("int", 20, 200), "feature_fraction": ("float", 0.5, 1.0),
        "bagging_fraction": ("float", 0.5, 1.0), "reg_alpha": ("log", 1e-4, 10.0), "reg_lambda": ("log", 1e-4, 10.0),
    },
    "depthwise": {
        "learning_rate": ("log", 0.01, 0.2), "max_depth": ("int", 3, 10), "min_child_weight": ("int", 1, 100),
        "subsample": ("float", 0.5, 1.0), "colsample_bytree": ("float", 0.5, 1.0),
        "reg_alpha": ("log", 1e-4, 10.0), "reg_lambda": ("log", 1e-4, 10.0),
    },
    "symmetric": {
        "learning_rate": ("log", 0.01, 0.2), "depth": ("int", 4, 10), "l2_leaf_reg": ("log", 1.0, 20.0),
    },
}
# Trials per set-up, and the most boosting rounds of a trial.
SEARCH_TRIALS = 100
SEARCH_ROUNDS = 500
# Ridge penalties tried.
RIDGE_ALPHAS = [1e5, 5e5, 1e6, 5e6, 1e7]

_SAME = {
    "maxIter": ("n_estimators", "iterations"),
    "stepSize": ("learning_rate",),
    "minInstancesPerNode": ("min_child_samples", "min_data_in_leaf", "min_child_weight"),
    "subsamplingRate": ("bagging_fraction", "subsample"),
    "featureSubsetStrategy": ("feature_fraction", "colsample_bytree"),
    "seed": ("random_state", "random_seed"),
}


def tree_params(params: dict[str, Any]) -> dict[str, Any]:
    """Spark ML names for boosting parameters; leaf count becomes a depth, penalties have no counterpart."""
    out: dict[str, Any] = {}
    for ours, theirs in _SAME.items():
        for name in theirs:
            if name in params:
                out[ours] = params[name]
    depth = params.get("max_depth", params.get("depth", -1))
    if depth is None or depth < 1:
        depth = math.ceil(math.log2(params.get("num_leaves", 31)))
    out["maxDepth"] = min(int(depth), 30)
    if "featureSubsetStrategy" in out:
        share = float(out["featureSubsetStrategy"])
        out["featureSubsetStrategy"] = "all" if share >= 1.0 else str(share)
    return out


def assemble(df: DataFrame, features: Sequence[str], medians: dict[str, float] | None = None) -> DataFrame:
    """Add the feature vector. Missing values take the median and are flagged in an own column."""
    medians = medians or {}
    filled = {f"_f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c, 0.0))) for c in features}
    flags = {f"_m_{c}": F.col(c).isNull().cast("double") for c in features if c in medians}
    table = df.withColumns(filled | flags)
    inputs = [*filled, *flags]
    return VectorAssembler(inputCols=inputs, outputCol=VECTOR).transform(table).drop(*inputs)


def vector_names(features: Sequence[str], medians: dict[str, float] | None = None) -> list[str]:
    return [*features, *[f"{c}_missing" for c in features if c in (medians or {})]]


def fit_medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact medians of the columns that have missing values; one number per column reaches the driver."""
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first()
    lacking = [c for c in features if gaps[c]]
    if not lacking:
        return {}
    found = {r["column"]: r["median"] for r in cross.exact_medians(df, lacking).collect()}
    return {c: found.get(c, 0.0) for c in lacking}


def known_medians(train: DataFrame, features: Sequence[str], target: str = S.TARGET) -> dict[str, float]:
    """``fit_medians`` of the rows with a target."""
    return fit_medians(train.where(F.col(target).isNotNull()), features)


@dataclass
class Fitted:
    """A fitted regressor with what it needs to read a table."""

    model: Any
    features: list[str]
    medians: dict[str, float]

    def predict(self, df: DataFrame, out: str = S.PREDICTION) -> DataFrame:
        scored = self.model.transform(assemble(df, self.features, self.medians))
        return scored.select(*df.columns, F.col("_prediction").alias(out))

    @property
    def rounds(self) -> int | None:
        return self.model.getNumTrees if hasattr(self.model, "getNumTrees") else None

    def importance(self) -> list[tuple[str, float]]:
        names = vector_names(self.features, self.medians)
        if hasattr(self.model, "featureImportances"):
            return list(zip(names, self.model.featureImportances.toArray().tolist()))
        weights = [abs(x) for x in self.model.coefficients.toArray().tolist()]
        total = sum(weights) or 1.0
        return [(n, w / total) for n, w in zip(names, weights)]


def regressor(kind: str, params: dict[str, Any], target: str, weight: str, early_stop: bool, tolerance: float | None = None):
    common = {"featuresCol": VECTOR, "labelCol": target, "weightCol": weight, "predictionCol": "_prediction"}
    if kind == "linear":
        return LinearRegression(**common, regParam=params.get("regParam", 0.0))
    mapped = tree_params(params)
    if kind == "forest":
        trees = mapped.pop("maxIter", 20)
        mapped.pop("stepSize", None)
        return RandomForestRegressor(**common, numTrees=trees, **mapped)
    extra = {"validationIndicatorCol": "_is_val"} if early_stop else {}
    if early_stop and tolerance is not None:
        extra["validationTol"] = tolerance
    return GBTRegressor(**common, **mapped, **extra)


def fit(
    train: DataFrame,
    features: Sequence[str],
    params: dict[str, Any],
    *,
    val: DataFrame | None = None,
    kind: str = "gbt",
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
    medians: dict[str, float] | None = None,
    tolerance: float | None = None,
) -> Fitted:
    """Fit on weighted rows; with ``val`` boosting stops when the validation loss no longer falls.

    ``tolerance`` is the least fall that counts, a share of the loss or of 0.01, whichever is larger (Spark's own value
    if None; a target whose variance is far below 0.01 needs 0, else boosting always ends after the first rounds).
    ``medians`` of the rows with a target may be given (``known_medians``), for several fits on the same rows.
    """
    features = list(features)
    used = [*features, target, weight]
    known = train.where(F.col(target).isNotNull()).select(*used)
    medians = fit_medians(known, features) if medians is None else medians
    early = val is not None and kind == "gbt"
    if early:
        held = val.where(F.col(target).isNotNull()).select(*used, F.lit(True).alias("_is_val"))
        known = known.withColumn("_is_val", F.lit(False)).unionByName(held)
    known = known.withColumns(
        {target: F.col(target).cast("double"), weight: F.coalesce(F.col(weight).cast("double"), F.lit(0.0))}
    )
    # Spark ML keeps the rows of a task as one block of objects and reads it whole in every pass.
    with sizing.small_scans(known.sparkSession):
        model = regressor(kind, params, target, weight, early, tolerance).fit(assemble(known, features, medians))
    return Fitted(model, features, medians)


@dataclass
class CrossValidation:
    models: list[Fitted]
    oof: DataFrame
    fold_metrics: DataFrame
    importance: DataFrame


def fold_numbers(folds: DataFrame) -> list[int]:
    return [r["fold_idx"] for r in folds.select("fold_idx").distinct().orderBy("fold_idx").collect()]


def importance_table(df: DataFrame, fitted: Sequence[Fitted]) -> DataFrame:
    """Mean importance over models; a feature that a model lacks counts 0."""
    rows = [(n, float(v)) for m in fitted for n, v in m.importance()]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.groupBy("feature").agg((F.sum("importance") / F.lit(len(fitted))).alias("importance"))


def cv_train(
    df: DataFrame,
    folds: DataFrame,
    features: Sequence[str],
    params: dict[str, Any],
    *,
    kind: str = "gbt",
    early_stop: bool = True,
    keys: Sequence[str] = tuple(S.KEYS),
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
) -> CrossValidation:
    """Fit each fold on its training dates and predict its validation dates."""
    models, parts, rows = [], [], []
    keep = list(dict.fromkeys([*keys, S.DATE, target, weight]))
    folds = checkpointed(folds)
    for k in fold_numbers(folds):
        train, val = splits.fold_rows(df, folds, k, "train"), splits.fold_rows(df, folds, k, "val")
        model = fit(train, features, params, val=val if early_stop else None, kind=kind, target=target, weight=weight)
        scored = model.predict(val, "oof_prediction").select(
            F.lit(k).alias("fold_idx"), *keep, F.col("oof_prediction").cast("float").alias("oof_prediction")
        )
        models.append(model)
        parts.append(scored)
        sums = metrics.date_sums(scored, target, "oof_prediction", weight)
        rows.append(metrics.all_metrics(sums).select(F.lit(k).alias("fold_idx"), "*"))
    oof = reduce(DataFrame.unionByName, parts)
    return CrossValidation(models, oof, reduce(DataFrame.unionByName, rows), importance_table(df, models))


def fold_average(models: Sequence[Fitted], df: DataFrame, out: str = S.PREDICTION) -> DataFrame:
    """Mean of the fold models' predictions."""
    scored, names = df, [f"_fold{i}" for i in range(len(models))]
    for model, name in zip(models, names):
        scored = model.predict(scored, name)
    mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(float(len(names)))
    return scored.withColumn(out, mean).drop(*names)


def zero_mean_r2(df: DataFrame, prediction: str, target: str, weight: str) -> float:
    return metrics.zero_mean_r2(metrics.date_sums(df, target, prediction, weight, by=())).first()[0]


@dataclass
class Holdout:
    model: Fitted
    record: dict[str, Any]


def gbt_holdout(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    params: dict[str, Any],
    *,
    early_stop: bool = False,
    rounds: int = 10_000,
    time_decay: tuple[float, float] | None = (0.5, 1.5),
    train_fraction: float | None = None,
    val_fraction: float | None = None,
    sample_group: Sequence[str] = (S.DATE,),
    key: str = S.ROW_ID,
    zscore: Sequence[str] = (),
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
    seed: int = 42,
    medians: dict[str, float] | None = None,
) -> Holdout:
    """Fit on earlier rows with time-decayed weights, score zero-mean R2 on both sides.

    Cross-sectional z-scores are taken before sampling, from whole snapshots. A side that is scored or sampled is
    written once with the columns of the fit, so the passes over it repeat no shuffle. ``medians`` as in ``fit``.
    """
    if zscore:
        train, val = cross.cs_zscore_safe(train, zscore), cross.cs_zscore_safe(val, zscore)
        features = [*features, *[f"{c}_cs_zscore" for c in zscore]]
    train = sample_by_group(train.where(F.col(target).isNotNull()), train_fraction, sample_group, key, seed)
    val = sample_by_group(val.where(F.col(target).isNotNull()), val_fraction, sample_group, key, seed)
    used = list(dict.fromkeys([*features, S.DATE, target, weight]))
    if zscore or (train_fraction or 1.0) < 1.0:
        train = written(train.select(*used), "train")
    if zscore or (val_fraction or 1.0) < 1.0:
        val = written(val.select(*used), "val")
    fit_weight = weight
    if time_decay is not None:
        train = with_time_decay(train, weight, S.DATE, *time_decay, out="_fit_weight")
        val = val.withColumn("_fit_weight", F.col(weight))
        fit_weight = "_fit_weight"
    used = {**params, "n_estimators": rounds} if early_stop else params
    model = fit(train, features, used, val=val if early_stop else None, target=target, weight=fit_weight, medians=medians)
    sides = [model.predict(side).select(F.lit(n).alias("side"), target, S.PREDICTION, weight) for n, side in (("train", train), ("val", val))]
    sums = metrics.date_sums(sides[0].unionByName(sides[1]), target, S.PREDICTION, weight, by=("side",))
    rows = {
        r["side"]: r
        for r in sums.select("side", "rows", (1 - F.try_divide(F.col("wee"), F.col("wyy"))).alias("r2")).collect()
    }
    record = {
        "train_rows": rows["train"]["rows"], "val_rows": rows["val"]["rows"],
        "train_r2": rows["train"]["r2"], "val_r2": rows["val"]["r2"], "best_iteration": model.rounds,
    }
    return Holdout(model, record)


def records_table(df: DataFrame, records: Sequence[dict[str, Any]]) -> DataFrame:
    """Trial records as a table; one row per fit."""
    names = list(dict.fromkeys(k for r in records for k in r))
    kinds = {n: next((type(r[n]) for r in records if r.get(n) is not None), float) for n in names}
    sql = {int: "bigint", float: "double", str: "string", bool: "boolean"}
    schema = ", ".join(f"`{n}` {sql[kinds[n]]}" for n in names)
    return df.sparkSession.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def best_params(records: DataFrame, score: str = "val_r2") -> DataFrame:
    """The record with the highest score."""
    return records.orderBy(F.desc_nulls_last(score)).limit(1)


def grid_points(grid: dict[str, list[Any]]) -> list[dict[str, Any]]:
    """All combinations, without those whose leaves the depth cannot hold."""
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return [p for p in points if not ("num_leaves" in p and "max_depth" in p and p["num_leaves"] >= 2 ** p["max_depth"])]


def grid_search(
    trial: Callable[[dict[str, Any]], dict[str, Any]], base: dict[str, Any], grids: Sequence[dict[str, list[Any]]]
) -> tuple[dict[str, Any], list[dict[str, Any]]]:
    """Stages one after another; each starts from the best of the stage before."""
    best, records = dict(base), []
    for stage, grid in enumerate(grids, 1):
        tried = [{"stage": stage, **point, **trial({**best, **point})} for point in grid_points(grid)]
        records += tried
        top = max(tried, key=lambda r: -math.inf if r["val_r2"] is None else r["val_r2"])
        best |= {k: top[k] for k in grid}
    return best, records


def draw_params(space: dict[str, tuple[str, float, float]], rng: random.Random) -> dict[str, Any]:
    out: dict[str, Any] = {}
    for name, (kind, low, high) in space.items():
        if kind in ("log", "logint"):
            value = math.exp(rng.uniform(math.log(low), math.log(high)))
        elif kind == "int":
            value = rng.randint(int(low), int(high))
        else:
            value = rng.uniform(low, high)
        out[name] = int(round(value)) if kind in ("int", "logint") else value
    return out


@dataclass
class RandomSearch:
    """Seeded random search; a trial below the median of earlier ones at the same fold is stopped."""

    space: dict[str, tuple[str, float, float]]
    n_trials: int = SEARCH_TRIALS
    seed: int = 42
    warmup_trials: int = 5
    warmup_folds: int = 1
    fixed: dict[str, Any] = field(default_factory=dict)
    records: list[dict[str, Any]] = field(default_factory=list)

    def run(
        self, folds: Iterable[int], score: Callable[[dict[str, Any], int], float], like: DataFrame | None = None
    ) -> dict[str, Any]:
        """With ``like``, the table of the fits, those that no stop can save run at the same time if they are small."""
        rng, folds = random.Random(self.seed), list(folds)
        draws = [{**self.fixed, **draw_params(self.space, rng)} for _ in range(self.n_trials)]
        known: dict[tuple[int, int], float] = {}
        if like is not None:
            # A trial is stopped after the fold of step ``warmup_folds`` at the earliest.
            pairs = [(number, step) for number in range(self.n_trials) for step in range(len(folds[: self.warmup_folds + 1]))]
            known = dict(zip(pairs, sizing.fits_side_by_side(like, lambda p: score(draws[p[0]], folds[p[1]]), pairs)))
        finished: list[list[float]] = []
        for number, params in enumerate(draws):
            means: list[float] = []
            total = 0.0
            stopped = False
            for step, fold in enumerate(folds):
                total += known[number, step] if (number, step) in known else score(params, fold)
                means.append(total / (step + 1))
                rivals = [m[step] for m in finished if len(m) > step]
                if len(finished) >= self.warmup_trials and step >= self.warmup_folds and rivals:
                    if means[-1] < statistics.median(rivals):
                        stopped = step + 1 < len(folds)
                        if stopped:
                            break
            if not stopped:
                finished.append(means)
            self.records.append({"trial": number, **params, "score": means[-1], "folds": len(means), "stopped": stopped})
        done = [r for r in self.records if not r["stopped"]]
        return max(done, key=lambda r: r["score"])


def fold_score(
    df: DataFrame, folds: DataFrame, features: Sequence[str], target: str = S.TARGET, weight: str = S.WEIGHT
) -> Callable[[dict[str, Any], int], float]:
    """Mean daily score of one fold for given parameters; boosting goes on while the validation loss falls at all.

    Both sides of a fold are the same for every trial, so they and the medians are taken once.
    """
    folds = checkpointed(folds)
    used = list(dict.fromkeys([*features, S.DATE, target, weight]))
    sides: dict[int, tuple[DataFrame, DataFrame, dict[str, float]]] = {}
    taking = threading.Lock()

    def side(fold: int) -> tuple[DataFrame, DataFrame, dict[str, float]]:
        with taking:
            if fold not in sides:
                train, val = [
                    sizing.packed(written(splits.fold_rows(df, folds, fold, role).select(*used), role)) for role in ("train", "val")
                ]
                sides[fold] = train, val, known_medians(train, features, target)
        return sides[fold]

    def score(params: dict[str, Any], fold: int) -> float:
        train, val, medians = side(fold)
        model = fit(train, features, params, val=val, target=target, weight=weight, medians=medians, tolerance=0.0)
        sums = metrics.date_sums(model.predict(val), target, S.PREDICTION, weight)
        return metrics.mean_competition_score(sums).first()[0]

    return score


def labelled_partitions(df: DataFrame, target: str = S.TARGET, partition: str = "partition_id") -> list[int]:
    """The partitions that have rows with a target, in order."""
    known = df.where(F.col(target).isNotNull() & F.col(partition).isNotNull()).select(partition).distinct()
    return [r[0] for r in known.orderBy(partition).collect()]


def backtest_sides(
    df: DataFrame, first_val: int | None, last_val: int | None, target: str, partition: str
) -> list[tuple[int, DataFrame, DataFrame]]:
    """(partition, all earlier rows, its rows) of the partitions with labelled rows; the first of them only trains.

    ``None`` leaves that end open.
    """
    known = labelled_partitions(df, target, partition)
    low, high = -math.inf if first_val is None else first_val, math.inf if last_val is None else last_val
    chosen = [v for v in known[1:] if low <= v <= high]
    return [side for v in chosen for side in splits.expanding_partitions(df, v, v, known[0], partition)]


def partition_backtest(
    df: DataFrame,
    first_val: int | None,
    last_val: int | None,
    features: Sequence[str],
    params: dict[str, Any],
    *,
    reference_rows: int | None = None,
    floor_min_leaf: int = 100,
    partition: str = "partition_id",
    **options,
) -> list[dict[str, Any]]:
    """One record per validation partition; leaf size follows the row count if ``reference_rows`` is set.

    Without ``first_val`` and ``last_val`` every partition is validated that has an earlier one (``backtest_sides``).
    """
    target = options.get("target", S.TARGET)

    def record(side: tuple[int, DataFrame, DataFrame]) -> dict[str, Any]:
        v, train, val = side
        train, used = sizing.packed(train), dict(params)
        if reference_rows:
            fraction = options.get("train_fraction")
            labelled = train.where(F.col(target).isNotNull())
            group, key = options.get("sample_group", (S.DATE,)), options.get("key", S.ROW_ID)
            rows = sample_by_group(labelled, fraction, group, key, options.get("seed", 42)).count()
            used["min_data_in_leaf"] = dynamic_min_leaf(
                rows, reference_rows, int(params.get("min_data_in_leaf", 800)), floor_min_leaf
            )
        done = gbt_holdout(train, val, features, used, **options)
        return {"val_partition": v, "min_data_in_leaf": used.get("min_data_in_leaf"), **done.record}

    return sizing.fits_side_by_side(df, record, backtest_sides(df, first_val, last_val, target, partition))


@dataclass
class Ridge:
    """Median fill, standardisation and weighted ridge; predicts with a plain column expression."""

    features: list[str]
    medians: list[float]
    means: list[float]
    deviations: list[float]
    coefficients: list[float]
    intercept: float

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for x, b in zip(scaled_columns(self.features, self.medians, self.means, self.deviations), self.coefficients):
            total = total + x * F.lit(b)
        return total

    def predict(self, df: DataFrame, out: str = S.PREDICTION) -> DataFrame:
        return df.withColumn(out, self.column())


def scaled_columns(
    features: Sequence[str], medians: Sequence[float], means: Sequence[float], deviations: Sequence[float]
) -> list[Column]:
    return [
        (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(mu)) / F.lit(sd if sd > 0 else 1.0)
        for c, m, mu, sd in zip(features, medians, means, deviations)
    ]


def ridge_grid(
    train: DataFrame, features: Sequence[str], alphas: Sequence[float], target: str = S.TARGET, weight: str = S.WEIGHT
) -> list[Ridge]:
    """One ridge per penalty, all from one pass of sums after the medians.

    Columns are filled with their median and standardised (mean and population deviation over the rows with a
    target); the ridge solves (G + alpha I) c = g, where G and g are the weighted, centred cross products of the
    standardised columns with each other and with the target. One aggregation gives counts, sums, squares and weighted
    cross products of the median-shifted columns; every penalty is then a p x p system on the driver, whose size
    depends on the number of columns only. Rows without a target are left out; a missing weight counts 0.
    """
    known = train.where(F.col(target).isNotNull()).select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(target).cast("double").alias(target),
        F.coalesce(F.col(weight).cast("double"), F.lit(0.0)).alias(weight),
    )
    found = {r["column"]: r["median"] for r in cross.exact_medians(known, features).collect()}
    medians = [found.get(c, 0.0) for c in features]
    # Shifted by the median, so that sums of squares lose no digits to a large mean.
    shifted = [F.coalesce(F.col(c), F.lit(m)) - F.lit(m) for c, m in zip(features, medians)]
    y, w = F.col(target), F.col(weight)
    p = len(features)
    sums = [F.count(F.lit(1)).alias("n"), F.sum(w).alias("w"), F.sum(w * y).alias("wy")]
    for i, x in enumerate(shifted):
        sums += [F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"ss{i}"), F.sum(w * x).alias(f"wx{i}"), F.sum(w * x * y).alias(f"wxy{i}")]
        sums += [F.sum(w * x * shifted[k]).alias(f"wxx{i}_{k}") for k in range(i, p)]
    row = known.agg(*sums).first()
    if not row["n"] or not row["w"]:
        raise ValueError("a ridge needs rows with a target and a positive weight sum")
    n, total = row["n"], row["w"]
    centre = np.array([row[f"s{i}"] / n for i in range(p)])
    spread = np.sqrt(np.maximum(np.array([row[f"ss{i}"] / n for i in range(p)]) - centre**2, 0.0))
    scale = np.where(spread > 0, spread, 1.0)
    wx = np.array([row[f"wx{i}"] for i in range(p)])
    wxx = np.zeros((p, p))
    for i in range(p):
        for k in range(i, p):
            wxx[i, k] = wxx[k, i] = row[f"wxx{i}_{k}"]
    gram = (wxx - np.outer(wx, wx) / total) / np.outer(scale, scale)
    towards = (np.array([row[f"wxy{i}"] for i in range(p)]) - wx * row["wy"] / total) / scale
    mean_scaled = (wx / total - centre) / scale
    means = [m + c for m, c in zip(medians, centre)]
    out = []
    for alpha in alphas:
        coefficients = np.linalg.solve(gram + alpha * np.eye(p), towards)
        intercept = row["wy"] / total - float(coefficients @ mean_scaled)
        out.append(Ridge(list(features), medians, means, spread.tolist(), coefficients.tolist(), intercept))
    return out


def ridge_alpha_grid(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    alphas: Sequence[float] = tuple(RIDGE_ALPHAS),
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
) -> tuple[Ridge, list[dict[str, float]]]:
    """Fit every penalty on ``train`` and score all of them in one pass over ``val``."""
    fitted = ridge_grid(train, features, alphas, target, weight)
    known = val.where(F.col(target).isNotNull() & F.col(weight).isNotNull())
    y, w = F.col(target).cast("double"), F.col(weight).cast("double")
    scores = known.agg(
        *[(1 - F.try_divide(F.sum(w * F.pow(y - m.column(), 2)), F.sum(w * y * y))).alias(f"s{i}") for i, m in enumerate(fitted)]
    ).first()
    records = [{"alpha": float(a), "val_r2": scores[f"s{i}"]} for i, a in enumerate(alphas)]
    order = [-math.inf if r["val_r2"] is None else r["val_r2"] for r in records]
    return fitted[order.index(max(order))], records


def ridge_backtest(
    df: DataFrame,
    first_val: int | None,
    last_val: int | None,
    features: Sequence[str],
    alpha: float,
    reference_rows: int,
    *,
    clip: tuple[float, float] | None = (-5.0, 5.0),
    fraction: float | None = None,
    sample_group: Sequence[str] = tuple(S.SNAPSHOT),
    key: str = S.ROW_ID,
    seed: int = 42,
    partition: str = "partition_id",
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
) -> list[dict[str, Any]]:
    """Per validation partition a ridge whose penalty follows the number of training rows; partitions as in ``partition_backtest``."""
    from tickloom.functions.scalar import clipped

    records = []
    for v, train, val in backtest_sides(df, first_val, last_val, target, partition):
        labelled = sample_by_group(train.where(F.col(target).isNotNull()), fraction, sample_group, key, seed)
        rows = labelled.count()
        used = scaled_alpha(alpha, rows, reference_rows)
        model = ridge_grid(labelled, features, [used], target, weight)[0]
        record: dict[str, Any] = {"val_partition": v, "alpha": used, "train_rows": rows}
        for side, table in (("train", labelled), ("val", val)):
            p = model.column() if clip is None else clipped(model.column(), *clip)
            record[f"{side}_r2"] = zero_mean_r2(table.withColumn(S.PREDICTION, p), S.PREDICTION, target, weight)
        records.append(record)
    return records


def onehot_symbol(df: DataFrame, symbol: str = S.SYMBOL, out: str = "symbol_vector") -> PipelineModel:
    """Fitted index and one-hot coding of the entity; the dropped level is the one for unknown entities."""
    from pyspark.ml import Pipeline

    index = StringIndexer(inputCol=symbol, outputCol="_symbol_index", handleInvalid="keep")
    code = OneHotEncoder(inputCols=["_symbol_index"], outputCols=[out], dropLast=True)
    return Pipeline(stages=[index, code]).fit(df)


def stacking(
    aligned: DataFrame,
    members: Sequence[str],
    params: dict[str, Any] | None = None,
    kind: str = "linear",
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
) -> Fitted:
    """A meta-model on the members' out-of-fold predictions."""
    return fit(aligned, list(members), params or {}, kind=kind, target=target, weight=weight)
