import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.operators import metrics


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    return [(d, float(y)) for d in range(5) for y in rng.normal(size=10)]


def scored(spark, rows, predict, weight=1.0):
    data = [(d, y, predict(y), weight) for d, y in rows]
    df = spark.createDataFrame(data, "date_id int, responder_6 double, prediction double, weight double")
    return metrics.date_sums(df)


def test_perfect_zero_and_flipped(spark, rows):
    score = lambda p: metrics.competition_score(scored(spark, rows, p)).first()[0]
    assert score(lambda y: y) == pytest.approx(5)
    assert score(lambda y: 0.0) == 0
    assert score(lambda y: -y) == pytest.approx(-5)


def test_mean_counts_skipped_dates(spark, rows):
    half = [(d, y if d < 2 else 0.0) for d, y in rows]
    sums = scored(spark, half, lambda y: y)
    assert metrics.competition_score(sums).first()[0] == pytest.approx(2)
    assert metrics.mean_competition_score(sums).first()[0] == pytest.approx(2 / 5)


def test_r2_and_errors(spark):
    four = [(0, y) for y in (1.0, 2.0, 3.0, 4.0)]
    r2 = lambda p: metrics.weighted_r2(scored(spark, four, p)).first()[0]
    assert r2(lambda y: y) == pytest.approx(1)
    assert r2(lambda y: 2.5) == pytest.approx(0)
    assert r2(lambda y: 5 - y) < 0
    one = scored(spark, [(0, 0.0), (0, 0.0)], lambda y: 1.0)
    assert metrics.weighted_rmse(one).first()[0] == 1.0
    assert metrics.weighted_mae(one).first()[0] == 1.0
    assert metrics.weighted_r2(one).first()[0] == 0.0


def test_no_weight_is_null(spark, rows):
    row = metrics.all_metrics(scored(spark, rows, lambda y: y, weight=0.0)).first()
    assert row["weighted_rmse"] is None and row["competition_score"] == 0


def test_empty_input(spark):
    row = metrics.all_metrics(metrics.date_sums(
        spark.createDataFrame([], "date_id int, responder_6 double, prediction double, weight double"))).first()
    assert row["competition_score"] == 0 and row["mean_competition_score"] == 0


def test_keys_and_backtest(spark, rows):
    sums = scored(spark, rows, lambda y: 0.5 * y + 0.1)
    out = metrics.backtest_per_date(sums).collect()
    assert len(out) == 6 and [r["date_id"] for r in out] == [None, 0, 1, 2, 3, 4]
    assert all(math.isfinite(v) for r in out for v in r[1:])
    assert out[0]["competition_score"] == pytest.approx(sum(r["competition_score"] for r in out[1:]))


def test_run_backtest_needs_prediction(spark, rows):
    df = spark.createDataFrame([(0, 1, 1.0, 1.0)], "date_id int, symbol_id int, responder_6 double, weight double")
    with pytest.raises(ValueError):
        metrics.run_backtest(df, lambda t: t)
    predictions, table = metrics.run_backtest(df, lambda t: t.withColumn("prediction", F.lit(1.0)))
    assert predictions.columns == ["date_id", "symbol_id", "y_true", "y_pred", "weight"]
    assert table.count() == 2


@pytest.mark.parametrize("days", [4, 9, 60, 200])
def test_trailing_score(spark, days):
    scores = spark.range(days).select(F.col("id").cast("int").alias("date_id"), F.sin("id").alias("score"))
    out = metrics.rolling_daily_score(scores).toPandas().sort_values("date_id")
    width = metrics.trailing_window(days, 20, 5)
    if width <= 1:
        assert out.empty
        return
    values = np.sin(np.arange(days))
    want = np.convolve(values, np.ones(width) / width, mode="valid")
    assert np.allclose(out["rolling_score"], want)


def test_r2_of_targets_far_from_zero(spark):
    rows = [(0, 1e8 + k, 1e8 + p, 1.0) for k, p in enumerate([3.0, 1.0, 5.0, 0.0, 6.0, 2.0, 4.0])]
    df = spark.createDataFrame(rows, f"{S.DATE} int, {S.TARGET} double, {S.PREDICTION} double, {S.WEIGHT} double")
    error = sum((y - p) ** 2 for _, y, p, _ in rows)
    got = metrics.weighted_r2(metrics.date_sums(df)).first()["weighted_r2"]
    assert abs(got - (1 - error / 28)) < 1e-6
