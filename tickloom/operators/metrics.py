"""Date-wise weighted metrics from one table of sums per date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S

FLOOR = 1e-10
SUMS = ("rows", "w", "wy", "wyy", "wd", "wdd", "wpp", "wyp", "wee", "wae")


def date_sums(
    df: DataFrame,
    truth: str = S.TARGET,
    prediction: str = S.PREDICTION,
    weight: str = S.WEIGHT,
    by: tuple[str, ...] = (S.DATE,),
) -> DataFrame:
    """All sums that the metrics need, per date, over rows that have truth, prediction and weight.

    ``wd`` and ``wdd`` are sums of the distance from the truth's mean, so that spreads of targets far from 0 do not
    cancel out; the mean is a scalar subquery over the three columns. A stream has no such mean, so its distances are
    from 0.
    """
    known = df.where(F.col(truth).isNotNull() & F.col(prediction).isNotNull() & F.col(weight).isNotNull())
    columns = {"_y": truth, "_p": prediction, "_w": weight}
    known = known.select(*by, *[F.col(c).cast("double").alias(n) for n, c in columns.items()])
    centre = F.lit(0.0) if df.isStreaming else known.agg(F.avg("_y")).scalar()
    known = known.withColumn("_d", F.col("_y") - centre)
    y, p, w, d = (F.col(c) for c in ("_y", "_p", "_w", "_d"))
    return known.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum(w).alias("w"),
        F.sum(w * y).alias("wy"),
        F.sum(w * y * y).alias("wyy"),
        F.sum(w * d).alias("wd"),
        F.sum(w * d * d).alias("wdd"),
        F.sum(w * p * p).alias("wpp"),
        F.sum(w * y * p).alias("wyp"),
        F.sum(w * (y - p) * (y - p)).alias("wee"),
        F.sum(w * F.abs(y - p)).alias("wae"),
    )


def _score(yp: Column, yy: Column, pp: Column) -> Column:
    """Uncentred weighted correlation; NULL where its denominator is too small."""
    den = F.sqrt(yy * pp)
    return F.when(den >= FLOOR, yp / den)


def score_per_date(sums: DataFrame) -> DataFrame:
    return sums.withColumn("score", _score(F.col("wyp"), F.col("wyy"), F.col("wpp")))


def competition_score(sums: DataFrame) -> DataFrame:
    """Sum of the scores of all dates, 0 if there is none."""
    return score_per_date(sums).agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("competition_score"))


def mean_competition_score(sums: DataFrame) -> DataFrame:
    """Sum of scores over the number of all dates; dates without a score count."""
    total = F.coalesce(F.sum("score"), F.lit(0.0)) / F.greatest(F.count("*"), F.lit(1))
    return score_per_date(sums).agg(total.alias("mean_competition_score"))


def _weighted_r2() -> Column:
    spread = F.sum("wdd") - F.try_divide(F.sum("wd") * F.sum("wd"), F.sum("w"))
    return F.when(spread < FLOOR, F.lit(0.0)).otherwise(1 - F.try_divide(F.sum("wee"), spread))


def metric_columns() -> dict[str, Column]:
    """Aggregates over ``date_sums`` rows that already carry ``score``."""
    total = F.coalesce(F.sum("score"), F.lit(0.0))
    return {
        "competition_score": total,
        "mean_competition_score": total / F.greatest(F.count("*"), F.lit(1)),
        "weighted_r2": _weighted_r2(),
        "weighted_rmse": F.sqrt(F.try_divide(F.sum("wee"), F.sum("w"))),
        "weighted_mae": F.try_divide(F.sum("wae"), F.sum("w")),
    }


def _aggregate(sums: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return sums.agg(*[c.alias(n) for n, c in columns.items()])


def weighted_r2(sums: DataFrame) -> DataFrame:
    return _aggregate(sums, {"weighted_r2": _weighted_r2()})


def zero_mean_r2(sums: DataFrame) -> DataFrame:
    """1 - sum(w e^2) / sum(w y^2)."""
    return _aggregate(sums, {"zero_mean_r2": 1 - F.try_divide(F.sum("wee"), F.sum("wyy"))})


def weighted_rmse(sums: DataFrame) -> DataFrame:
    return _aggregate(sums, {"weighted_rmse": metric_columns()["weighted_rmse"]})


def weighted_mae(sums: DataFrame) -> DataFrame:
    return _aggregate(sums, {"weighted_mae": metric_columns()["weighted_mae"]})


def global_weighted_corr(sums: DataFrame) -> DataFrame:
    """The score of all rows as one group, denominator floored."""
    den = F.greatest(F.sqrt(F.sum("wyy") * F.sum("wpp")), F.lit(FLOOR))
    return _aggregate(sums, {"global_weighted_corr": F.sum("wyp") / den})


def all_metrics(sums: DataFrame) -> DataFrame:
    return _aggregate(score_per_date(sums), metric_columns())


def backtest_per_date(sums: DataFrame, date: str = S.DATE) -> DataFrame:
    """All metrics per date, and overall in the row whose date is NULL; one pass over the data."""
    columns = [c.alias(n) for n, c in metric_columns().items()]
    return score_per_date(sums).rollup(date).agg(F.sum("rows").alias("n_rows"), *columns).orderBy(date)


def run_backtest(
    df: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    truth: str = S.TARGET,
    weight: str = S.WEIGHT,
    prediction: str = S.PREDICTION,
) -> tuple[DataFrame, DataFrame]:
    """Apply a black-box ``predict`` (it adds ``prediction``); return predictions and metrics per date."""
    scored = predict(df)
    if prediction not in scored.columns:
        raise ValueError(f"predict must add the column {prediction!r}")
    predictions = scored.select(
        S.DATE, S.SYMBOL, F.col(truth).alias("y_true"), F.col(prediction).alias("y_pred"), F.col(weight)
    )
    return predictions, backtest_per_date(date_sums(scored, truth, prediction, weight))


def error_by_symbol(df: DataFrame, truth: str, prediction: str, symbol: str = S.SYMBOL) -> DataFrame:
    """Unweighted errors per entity, worst first."""
    gap = F.col(truth) - F.col(prediction)
    return (
        df.groupBy(symbol)
        .agg(
            F.count("*").alias("n_rows"),
            F.sqrt(F.avg(gap * gap)).alias("rmse"),
            F.avg(F.abs(gap)).alias("mae"),
            F.avg(prediction).alias("mean_pred"),
            F.avg(truth).alias("mean_true"),
        )
        .orderBy(F.desc("rmse"), symbol)
    )


def trailing_window(dates: int, longest: int, share: int) -> int:
    """Length of the trailing mean in the reports: a share of the dates, at most ``longest``."""
    return min(longest, dates // share)


def rolling_daily_score(
    scores: DataFrame, longest: int = 20, share: int = 5, date: str = S.DATE, score: str = "score"
) -> DataFrame:
    """Trailing mean of the daily score, full windows only; one input row per date.

    A calendar of dates is small, so one ordered window over it is enough. The window length follows
    from the number of dates.
    """
    w = Window.orderBy(date)
    # A date without a score counts as 0, as in the summed score.
    known = F.coalesce(F.col(score), F.lit(0.0))
    rows = scores.select(
        date,
        F.col(score),
        F.row_number().over(w).alias("_i"),
        F.collect_list(known).over(w.rowsBetween(-(longest - 1), 0)).alias("_last"),
        F.count("*").over(Window.partitionBy()).alias("_days"),
    )
    width = F.least(F.lit(longest), F.floor(F.col("_days") / share)).cast("int")
    rows = rows.withColumn("_width", width).where((F.col("_width") > 1) & (F.col("_i") >= F.col("_width")))
    recent = F.slice("_last", -F.col("_width"), F.col("_width"))
    mean = F.aggregate(recent, F.lit(0.0), lambda a, x: a + x) / F.col("_width")
    return rows.select(date, score, mean.alias("rolling_score"))


def negative_score_share(sums: DataFrame) -> DataFrame:
    """Share of dates with a negative score and the mean daily score."""
    daily = F.coalesce(F.col("score"), F.lit(0.0))
    return score_per_date(sums).agg(
        F.avg(F.when(daily < 0, 1.0).otherwise(0.0)).alias("negative_share"), F.avg(daily).alias("mean_daily_score")
    )


def compare_models(results: dict[str, DataFrame], metric: str = "competition_score") -> DataFrame:
    """One row per experiment, best first."""
    table = None
    for name, row in results.items():
        named = row.select(F.lit(name).alias("experiment"), *row.columns)
        table = named if table is None else table.unionByName(named, allowMissingColumns=True)
    return table.orderBy(F.desc(metric), "experiment")


def cv_summary(fold_metrics: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean and population deviation of each metric over folds."""
    long = fold_metrics.unpivot([], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def top_features(importance: DataFrame, n: int, value: str = "importance", name: str = "feature") -> DataFrame:
    return importance.orderBy(F.desc(value), name).limit(n)


def importance_share(importance: DataFrame, n: int = 10, value: str = "importance") -> DataFrame:
    """Share of the total importance held by the ``n`` largest."""
    top = top_features(importance, n, value).agg(F.sum(value)).scalar()
    return importance.agg(F.sum(value).alias("_all")).select(F.try_divide(top, F.col("_all")).alias("share"))
