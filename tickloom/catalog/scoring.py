"""Aggregates and metrics (AG, SL7, SL8, UD1)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import EV, LI, events_panel, lineitem_panel, query, r6, rounded, s6
from tickloom.catalog.windows import DAILY_SQL, daily_scores
from tickloom.operators import baselines, blend, metrics, profile
from tickloom.operators import cross


def _sums(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.date_sums(lineitem_panel(spark, folder))


def _all_rounded(df: DataFrame, *skip: str) -> DataFrame:
    return rounded(df, *[c for c in df.columns if c not in skip])


Y, P, WT = "responder_6", "prediction", "weight"
_SW, _SE = "sum(weight)", "sum(weight * pow(responder_6 - prediction, 2))"
_WRMSE, _WMAE = f"sqrt({_SE} / {_SW})", f"sum(weight * abs(responder_6 - prediction)) / {_SW}"
_SPREAD = f"(sum(weight * pow(responder_6, 2)) - pow(sum(weight * responder_6), 2) / {_SW})"
_WR2 = f"CASE WHEN {_SPREAD} < 1e-10 THEN 0 ELSE 1 - {_SE} / {_SPREAD} END"
_EXACT_R2 = """WITH {LI}, m AS (SELECT sum(weight * responder_6) / sum(weight) AS mu FROM li)
  SELECT {out} FROM li, m"""


@query("score_per_date", f"WITH {DAILY_SQL} SELECT date_id, {s6('score', 'score')} FROM daily")
def score_per_date(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(daily_scores(spark, folder).select(S.DATE, "score"), "score")


@query("competition_score", f"WITH {DAILY_SQL} SELECT {s6('coalesce(sum(score), 0)', 'competition_score')} FROM daily")
def competition_score(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.competition_score(_sums(spark, folder)))


@query("mean_competition_score", f"WITH {DAILY_SQL} SELECT {s6('coalesce(sum(score), 0) / greatest(count(*), 1)', 'mean_competition_score')} FROM daily")
def mean_competition_score(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.mean_competition_score(_sums(spark, folder)))


@query("global_weighted_corr", f"""WITH {LI} SELECT {s6('sum(weight * responder_6 * prediction) / greatest(1e-10, sqrt(sum(weight * pow(responder_6, 2)) * sum(weight * pow(prediction, 2))))', 'global_weighted_corr')} FROM li""")
def global_weighted_corr(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.global_weighted_corr(_sums(spark, folder)))


@query("weighted_r2", _EXACT_R2.format(LI=LI, out=s6("1 - sum(weight * pow(responder_6 - prediction, 2)) / sum(weight * pow(responder_6 - mu, 2))", "weighted_r2")))
def weighted_r2(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.weighted_r2(_sums(spark, folder)))


@query("zero_mean_r2", f"WITH {LI} SELECT {s6(f'1 - {_SE} / sum(weight * pow(responder_6, 2))', 'zero_mean_r2')} FROM li")
def zero_mean_r2(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.zero_mean_r2(_sums(spark, folder)))


@query("weighted_rmse", f"WITH {LI} SELECT {s6(_WRMSE, 'weighted_rmse')} FROM li")
def weighted_rmse(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.weighted_rmse(_sums(spark, folder)))


@query("weighted_mae", f"WITH {LI} SELECT {s6(_WMAE, 'weighted_mae')} FROM li")
def weighted_mae(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.weighted_mae(_sums(spark, folder)))


_ALL = f"""(SELECT {s6('coalesce(sum(score), 0)', 'competition_score')}, {s6('coalesce(sum(score), 0) / count(*)', 'mean_competition_score')} FROM daily),
  (SELECT {s6(_WR2, 'weighted_r2')}, {s6(_WRMSE, 'weighted_rmse')}, {s6(_WMAE, 'weighted_mae')} FROM li)"""


@query("all_metrics", f"WITH {DAILY_SQL} SELECT * FROM {_ALL}")
def all_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.all_metrics(_sums(spark, folder)))


_BACKTEST = f"""SELECT -1 AS date_id, (SELECT count(*) FROM li) AS n_rows, * FROM {_ALL}
  UNION ALL SELECT li.date_id, count(*), {s6('coalesce(max(score), 0)', 'a')}, {s6('coalesce(max(score), 0)', 'b')},
  {s6(_WR2, 'c')}, {s6(_WRMSE, 'd')}, {s6(_WMAE, 'e')} FROM li JOIN daily USING (date_id) GROUP BY li.date_id"""


def _backtest_rows(table: DataFrame) -> DataFrame:
    """Date -1 stands for all dates."""
    return _all_rounded(table.withColumn(S.DATE, F.coalesce(S.DATE, F.lit(-1))), S.DATE, "n_rows")


@query("backtest_per_date", f"WITH {DAILY_SQL} {_BACKTEST}")
def backtest_per_date(spark: SparkSession, folder: str) -> DataFrame:
    return _backtest_rows(metrics.backtest_per_date(_sums(spark, folder)))


@query("predict_fn", f"WITH {DAILY_SQL} {_BACKTEST}")
def predict_fn(spark: SparkSession, folder: str) -> DataFrame:
    """A vectorised foreign model as the black box of a backtest."""
    @F.pandas_udf("double")
    def tax_model(tax: pd.Series) -> pd.Series:
        return tax - 0.04

    df = lineitem_panel(spark, folder).withColumn("tax", F.col(S.PREDICTION) + 0.04).drop(S.PREDICTION)
    _, table = metrics.run_backtest(df, lambda t: t.withColumn(S.PREDICTION, tax_model("tax")))
    return _backtest_rows(table)


@query("weighted_mean_fit", f"WITH {LI} SELECT {s6('sum(weight * responder_6) / sum(weight)', 'weighted_mean')} FROM li")
def weighted_mean_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(baselines.weighted_mean_fit(lineitem_panel(spark, folder)))


@query("median_fit", f"WITH {EV} SELECT {s6('median(responder_6)', 'median')} FROM ev")
def median_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(baselines.median_fit(events_panel(spark, folder)))


@query("symbol_weighted_mean", f"WITH {LI} SELECT symbol_id, {s6('sum(weight * responder_6) / sum(weight)', 'symbol_mean')} FROM li GROUP BY 1")
def symbol_weighted_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(baselines.symbol_weighted_mean(lineitem_panel(spark, folder)), "symbol_mean")


@query("group_mean_std", f"""WITH {EV} SELECT date_id, time_id, {s6('avg(feature_00)', 'feature_00_mean')}, {s6('avg(feature_01)', 'feature_01_mean')},
  {s6('stddev_samp(feature_00)', 'feature_00_std')}, {s6('stddev_samp(feature_01)', 'feature_01_std')} FROM ev GROUP BY 1, 2""")
def group_mean_std(spark: SparkSession, folder: str) -> DataFrame:
    df = cross.group_moments(events_panel(spark, folder), ["feature_00", "feature_01"], S.SNAPSHOT)
    return _all_rounded(df, *S.SNAPSHOT)


_COLS = ["feature_00", "feature_01", "responder_6", "weight"]


@query("missing_rates", f"WITH {EV} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {s6(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)', 'missing_rate')} FROM ev" for c in _COLS))
def missing_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.missing_rates(events_panel(spark, folder), _COLS), "missing_rate")


@query("overview_stats", f"""WITH {LI} SELECT count(*) AS n_rows, count(DISTINCT date_id) AS n_dates, count(DISTINCT time_id) AS n_times,
  count(DISTINCT symbol_id) AS n_symbols, min(date_id) AS first_date, max(date_id) AS last_date FROM li""")
def overview_stats(spark: SparkSession, folder: str) -> DataFrame:
    return profile.overview_stats(lineitem_panel(spark, folder))


@query("daily_mean_target", f"WITH {LI} SELECT date_id, {s6('avg(responder_6)', 'mean_target')} FROM li GROUP BY 1")
def daily_mean_target(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.daily_mean_target(lineitem_panel(spark, folder)), "mean_target")


@query("target_moments", f"""WITH {EV}, m AS (SELECT avg(responder_6) AS mu, stddev_pop(responder_6) AS sd FROM ev)
  SELECT {s6('max(mu)', 'mean')}, {s6('max(sd)', 'std')}, {s6('min(responder_6)', 'min')}, {s6('max(responder_6)', 'max')},
  {s6('avg(pow((responder_6 - mu) / sd, 3))', 'skew')} FROM ev, m""")
def target_moments(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(profile.target_moments(events_panel(spark, folder)))


@query("zero_weight_share", f"""WITH {EV} SELECT {s6('avg(CASE WHEN weight - 1 = 0 THEN 1.0 ELSE 0.0 END)', 'zero_weight_share')} FROM ev""")
def zero_weight_share(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder).withColumn(S.WEIGHT, F.col(S.WEIGHT) - 1)
    return _all_rounded(profile.zero_weight_share(df))


@query("distinct_per_date", f"""WITH {EV} SELECT date_id, count(DISTINCT symbol_id) AS n_symbols, count(DISTINCT time_id) AS n_times
  FROM ev GROUP BY 1""")
def distinct_per_date(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_per_date(events_panel(spark, folder))


@query("histogram", f"""WITH {EV}, b AS (SELECT min(feature_00) AS lo, max(feature_00) AS hi FROM ev),
  c AS (SELECT CAST(least(99, floor((feature_00 - lo) / (hi - lo) * 100)) AS INTEGER) AS bin, count(*) AS n FROM ev, b GROUP BY 1)
  SELECT CAST(i AS INTEGER) AS bin, {s6('lo + i * (hi - lo) / 100', 'left_edge')}, coalesce(n, 0) AS n
  FROM b, (SELECT unnest(range(100)) AS i) LEFT JOIN c ON c.bin = i""")
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.histogram(events_panel(spark, folder), "feature_00", 100), "left_edge")


@query("density_2d", f"""WITH {EV}, b AS (SELECT min(feature_00) AS xl, max(feature_00) AS xh, min(feature_01) AS yl, max(feature_01) AS yh FROM ev)
  SELECT CAST(least(49, floor((feature_00 - xl) / (xh - xl) * 50)) AS INTEGER) AS x_bin,
  CAST(least(49, floor((feature_01 - yl) / (yh - yl) * 50)) AS INTEGER) AS y_bin, count(*) AS n FROM ev, b
  WHERE feature_01 IS NOT NULL GROUP BY 1, 2""")
def density_2d(spark: SparkSession, folder: str) -> DataFrame:
    return profile.density_2d(events_panel(spark, folder), "feature_00", "feature_01", 50)


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{_CORR[j]}' AS column, '{_CORR[i]}' AS other, {s6(f'corr({_CORR[i]}, {_CORR[j]})', 'corr')} FROM lineitem"
    for i in range(4) for j in range(i + 1, 4)))
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    return rounded(profile.correlation_matrix(df, _CORR), "corr")


@query("negative_score_share", f"""WITH {DAILY_SQL} SELECT {s6('avg(CASE WHEN score < 0 THEN 1.0 ELSE 0.0 END)', 'negative_share')},
  {s6('avg(coalesce(score, 0))', 'mean_daily_score')} FROM daily""")
def negative_score_share(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(metrics.negative_score_share(_sums(spark, folder)))


_FOLD5 = f"""WITH {LI}, f AS (SELECT CAST(floor(date_id / 500.0) AS INTEGER) AS fold_idx, {_WRMSE} AS weighted_rmse, {_WMAE} AS weighted_mae
  FROM li GROUP BY 1)"""


@query("cv_summary", f"""{_FOLD5} SELECT 'weighted_rmse' AS metric, {s6('avg(weighted_rmse)', 'mean')}, {s6('stddev_pop(weighted_rmse)', 'std')} FROM f
  UNION ALL SELECT 'weighted_mae', {s6('avg(weighted_mae)', 'mean')}, {s6('stddev_pop(weighted_mae)', 'std')} FROM f""")
def cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics per 500 days, summarised over them."""
    df = lineitem_panel(spark, folder).withColumn("fold_idx", F.floor(F.col(S.DATE) / 500).cast("int"))
    sums = metrics.score_per_date(metrics.date_sums(df, by=("fold_idx", S.DATE)))
    folds = sums.groupBy("fold_idx").agg(*[c.alias(n) for n, c in metrics.metric_columns().items()])
    return rounded(metrics.cv_summary(folds, ["weighted_rmse", "weighted_mae"]), "mean", "std")


@query("date_bias", f"WITH {LI} SELECT date_id, {s6('avg(responder_6 - prediction)', 'bias')} FROM li GROUP BY 1")
def date_bias(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(blend.date_bias(lineitem_panel(spark, folder), S.TARGET, S.PREDICTION), "bias")


@query("daily_regime_stats", f"""WITH {EV} SELECT date_id, {s6('avg(feature_00)', 'feature_00_mean')}, {s6('avg(feature_01)', 'feature_01_mean')},
  {s6('stddev_samp(feature_00)', 'feature_00_std')}, {s6('stddev_samp(feature_01)', 'feature_01_std')} FROM ev GROUP BY 1""")
def daily_regime_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _all_rounded(profile.daily_regime_stats(events_panel(spark, folder), ["feature_00", "feature_01"]), S.DATE)


@query("regimes")
def regimes(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.daily_regime_stats(lineitem_panel(spark, folder), ["feature_00", S.TARGET])
    return profile.regimes(stats)


def _rmse_row(alias: str, prediction: str) -> str:
    return f"""SELECT '{alias}' AS experiment, {s6(f'sqrt(sum(weight * pow(responder_6 - {prediction}, 2)) / sum(weight))', 'weighted_rmse')},
  {s6(f'sum(weight * abs(responder_6 - {prediction})) / sum(weight)', 'weighted_mae')} FROM li"""


@query("compare_models", f"WITH {LI} {_rmse_row('tax', 'prediction')} UNION ALL {_rmse_row('half', 'prediction * 0.5')} UNION ALL {_rmse_row('zero', '0')}")
def compare_models(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem_panel(spark, folder)
    results = {}
    for name, factor in (("tax", 1.0), ("half", 0.5), ("zero", 0.0)):
        scaled = df.withColumn(S.PREDICTION, F.col(S.PREDICTION) * factor)
        results[name] = metrics.all_metrics(metrics.date_sums(scaled)).select("weighted_rmse", "weighted_mae")
    return rounded(metrics.compare_models(results, "weighted_rmse"), "weighted_rmse", "weighted_mae")


@query("best_params", f"""WITH {LI}, t AS (SELECT k / 10.0 AS factor, {s6('1 - sum(weight * pow(responder_6 - prediction * k / 10.0, 2)) / sum(weight * pow(responder_6, 2))', 'val_r2')}
  FROM li, (SELECT unnest(range(11)) AS k) GROUP BY k) SELECT CAST(factor AS DOUBLE) AS factor, val_r2 FROM t ORDER BY val_r2 DESC, factor LIMIT 1""")
def best_params(spark: SparkSession, folder: str) -> DataFrame:
    """Trial table of eleven scale factors, scored in one pass; the best row wins."""
    from tickloom.plans.models import best_params as best

    df = lineitem_panel(spark, folder)
    y, p, w = F.col(S.TARGET), F.col(S.PREDICTION), F.col(S.WEIGHT)
    scores = df.agg(
        *[(1 - F.sum(w * F.pow(y - p * (k / 10), 2)) / F.sum(w * y * y)).alias(f"s{k}") for k in range(11)]
    )
    rows = [F.struct(F.lit(k / 10).alias("factor"), r6(f"s{k}").alias("val_r2")) for k in range(11)]
    return best(scores.select(F.inline(F.array(*rows))))
