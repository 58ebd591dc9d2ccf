import pytest
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.operators import cross
from tickloom.operators import windows as win
from tickloom.plans import features as plan
from tickloom.session import scratch_path


def test_lag_is_the_previous_row_of_the_symbol(small):
    pdf = win.lag_features(small, ["feature_00"], [1]).toPandas().sort_values(["symbol_id", "date_id", "time_id"])
    want = pdf.groupby("symbol_id")["feature_00"].shift(1)
    assert (want.isna() == pdf["feature_00_lag1"].isna()).all()
    assert (want - pdf["feature_00_lag1"]).abs().max() < 1e-5


def test_rolling_mean_by_hand(small):
    pdf = win.rolling_features(small, ["feature_00"], [3], ["mean"]).toPandas()
    pdf = pdf.sort_values(["symbol_id", "date_id", "time_id"])
    want = pdf.groupby("symbol_id")["feature_00"].transform(lambda v: v.rolling(3, min_periods=1).mean())
    assert (want - pdf["feature_00_roll3_mean"]).abs().max() < 1e-4


def test_bad_arguments(small):
    with pytest.raises(ValueError):
        win.lag_features(small, ["feature_00"], [0])
    with pytest.raises(ValueError):
        plan.LagStep(["feature_00"], [-1])
    with pytest.raises(ValueError):
        plan.RollingStep(["feature_00"], [5], ["skew"])
    with pytest.raises(ValueError):
        plan.RollingStep(["feature_00"], [0])
    with pytest.raises(ValueError):
        cross.ranked(small, "feature_00", method="standard")
    with pytest.raises(ValueError):
        win.ewm_mean(small, ["feature_00"], [0.5])


def test_min_periods(small):
    out = win.rolling_features(small, ["responder_6"], [3], ["mean"], min_periods=3)
    empty = out.where(F.col("responder_6_roll3_mean").isNull()).count()
    assert empty == 2 * 5


def test_names_and_order():
    step = plan.RollingStep(["a", "b"], [5, 10], ["mean", "std"])
    assert step.names()[:4] == ["a_roll5_mean", "a_roll5_std", "a_roll10_mean", "a_roll10_std"]
    assert plan.LagStep(["a"], [2, 4]).names() == ["a_lag2", "a_lag4"]
    assert plan.RankStep(["a"]).names() == ["a_xrank_norm"]
    assert plan.EwmStep(["a"], [5.0]).names() == ["a_ewm5"]


def test_transform_before_fit(small):
    with pytest.raises(RuntimeError):
        plan.LagStep(["feature_00"], [1]).transform(small)
    with pytest.raises(RuntimeError):
        plan.FeatureChain([plan.LagStep(["feature_00"], [1])]).transform(small)


def test_rank_norm_is_centred_and_keeps_columns(small):
    out = cross.xs_rank(small, ["feature_00"])
    assert set(small.columns) < set(out.columns)
    means = out.groupBy("date_id", "time_id").agg(F.avg("feature_00_xrank_norm").alias("m"))
    assert means.where(F.abs("m") > 1e-9).count() == 0


def test_default_features(panel):
    config = {k: dict(v) for k, v in plan.DEFAULT_CONFIG.items()}
    config["rolling"]["columns"] = ["feature_00", "responder_6_lag_1"]
    chain = plan.build_features(config)
    out = chain.fit_transform(panel)
    assert len(chain.feature_names_out) == 4 + 12 + 4
    assert out.count() == panel.count() and not [c for c in out.columns if c.startswith("_")]
    full = plan.build_features()
    assert sum(len(s.names()) for s in full.steps) == 4 + 72 + 4
    off = plan.build_features({**config, "lag": {**config["lag"], "enabled": False}})
    assert len(off.steps) == 2


def test_chain_errors(small):
    with pytest.raises(ValueError):
        plan.FeatureChain([plan.LagStep(["feature_00"], [1])], feature_cols=["nope"]).fit(small)
    with pytest.raises(ValueError):
        plan.FeatureChain([]).fit(small)
    bad = plan.FunctionStep(lambda t: t.select("date_id"), ["x"])
    with pytest.raises(ValueError):
        bad.fit_transform(small)


def test_chain_reads_outputs_of_earlier_steps(small):
    steps = [plan.LagStep(["feature_00"], [1]), plan.RollingStep(["feature_00_lag1"], [3], ["mean"])]
    chain = plan.FeatureChain(steps)
    pdf = chain.fit_transform(small).toPandas().sort_values(["symbol_id", "date_id", "time_id"])
    want = pdf.groupby("symbol_id")["feature_00"].transform(lambda v: v.shift(1).rolling(3, min_periods=1).mean())
    assert (want - pdf["feature_00_lag1_roll3_mean"]).abs().max() < 1e-6


def test_save_and_load(spark, small):
    chain = plan.build_features({"lag": {"columns": ["feature_00"], "windows": [1]}, "rolling": None,
                                 "cross_sectional": {"columns": ["feature_01"]}}).fit(small)
    path = scratch_path(spark, "spec")
    chain.save(spark, path)
    again = plan.FeatureChain.load(spark, path)
    assert again.feature_names_out == chain.feature_names_out
    names = [*S.KEYS, *chain.feature_names_out]
    assert chain.transform(small).select(names).exceptAll(again.transform(small).select(names)).isEmpty()


def _exchanges(df):
    plan_text = df._jdf.queryExecution().executedPlan().toString()
    return plan_text.count("Exchange hashpartitioning")


def test_one_shuffle_per_axis(panel):
    """Lag and rolling steps share one exchange on the symbol; ranks add one on the snapshot."""
    entity = plan.FeatureChain([plan.LagStep(["feature_00"], [1, 2]), plan.RollingStep(["feature_01", "feature_02"], [5, 10])])
    assert _exchanges(entity.fit_transform(panel)) == 1
    both = plan.FeatureChain([*entity.steps, plan.ZScoreStep(["feature_03"])])
    assert _exchanges(both.fit_transform(panel)) == 2
