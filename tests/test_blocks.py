"""Split plans give what the plain windows give, with hot entities, hot steps and many small blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.catalog.common import ORDER
from tickloom.operators import blocks, cross, sampling
from tickloom.operators import windows as win
from tickloom.operators.baselines import median_fit
from tickloom.operators.blend import rank_average
from tickloom.plans import sizing
from tickloom.plans.features import FeatureChain, LagStep, RollingStep


def same(a, b, columns, key="event_id", tolerance=1e-9):
    left = a.select(key, *columns).toPandas().sort_values(key).reset_index(drop=True)
    right = b.select(key, *columns).toPandas().sort_values(key).reset_index(drop=True)
    assert len(left) == len(right) and left[key].is_unique
    for c in columns:
        x, y = left[c].astype(float), right[c].astype(float)
        assert (x.isna() == y.isna()).all(), c
        assert (x - y).abs().fillna(0.0).max() <= tolerance, c


@pytest.mark.parametrize("n", [3, 400])
def test_lag_and_rolling(hot_events, n):
    args = dict(order=ORDER)
    columns = ["feature_00", "feature_01"]
    for fn, options in (
        (win.lag_features, dict(lags=[1, 40])),
        (win.rolling_features, dict(windows=[1, 5, 20], stats=list(win.STATS))),
        (win.rolling_features, dict(windows=[5], stats=["mean"], min_periods=3)),
    ):
        plain = fn(hot_events, columns, **options, **args)
        names = [c for c in plain.columns if c not in hot_events.columns]
        same(plain, fn(hot_events, columns, **options, **args, blocks=n), names)
        same(plain, fn(hot_events, columns, **options, **args, blocks=n, batches=True), names)


@pytest.mark.parametrize("size", [7, 10_000])
def test_batches_equal_windows(spark, hot_events, size):
    """Batches smaller than the frames, and entities that end inside a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        columns = ["feature_00", "feature_01"]
        options = dict(windows=[1, 2, 20], stats=list(win.STATS), min_periods=2, order=ORDER)
        plain = win.rolling_features(hot_events, columns, batches=False, **options)
        names = [c for c in plain.columns if c not in hot_events.columns]
        same(plain, win.rolling_features(hot_events, columns, batches=True, **options), names)
        keys = dict(entity=["symbol_id", "date_id"], order=["time_id", "event_id"])
        plain = win.lag_features(hot_events, ["event_id", "feature_01"], [1, 9], batches=False, **keys)
        out = win.lag_features(hot_events, ["event_id", "feature_01"], [1, 9], batches=True, **keys)
        assert out.schema["event_id_lag1"].dataType == plain.schema["event_id_lag1"].dataType
        same(plain, out, ["event_id_lag1", "event_id_lag9", "feature_01_lag1", "feature_01_lag9"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_null_entity_in_batches(spark):
    rows = [(None, i, float(i)) for i in range(4)] + [(1, i, float(10 * i)) for i in range(4)]
    df = spark.createDataFrame(rows, "symbol_id int, event_id int, x double")
    a, b = (win.rolling_features(df, ["x"], [2], ["mean"], order=["event_id"], batches=x) for x in (True, False))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("n", [None, 3, 400])
def test_ewm_matches_pandas(hot_events, n):
    out = win.ewm_mean(hot_events, ["feature_00", "feature_01"], [1.0, 5.0, 20.0], order=ORDER, blocks=n)
    pdf = out.toPandas().sort_values(ORDER)
    for c in ("feature_00", "feature_01"):
        for span in (1, 5, 20):
            want = pdf.groupby("symbol_id")[c].transform(
                lambda v: v.dropna().ewm(span=span, adjust=False).mean().reindex(v.index).ffill()
            )
            got = pdf[f"{c}_ewm{span}"]
            assert (want.isna() == got.isna()).all()
            assert (want - got).abs().max() < 1e-9


def test_ewm_over_many_runs(spark):
    """A single entity long enough for several runs of the scaled sum, span close to 1 included."""
    df = spark.range(20_000).select(
        F.lit(1).alias("symbol_id"), F.col("id").alias("event_id"), F.sin("id").alias("x"), F.col("id").alias("date_id")
    )
    for span in (1.01, 3.0, 50.0):
        for n in (None, 7):
            out = win.ewm_mean(df, ["x"], [span], order=["date_id"], blocks=n).toPandas().sort_values("date_id")
            want = out["x"].ewm(span=span, adjust=False).mean()
            assert (want - out[f"x_ewm{int(span)}"]).abs().max() < 1e-9


@pytest.mark.parametrize("method", cross.RANK_METHODS)
@pytest.mark.parametrize("n", [3, 60])
def test_ranks(hot_events, method, n):
    """Half of the rows share one value, and one step holds a third of the rows."""
    tied = hot_events.withColumn(
        "feature_01", F.when(F.col("event_id") % 2 == 0, F.lit(7.0)).otherwise(F.col("feature_01"))
    )
    group = ["time_id"]
    plain = cross.ranked(tied, "feature_01", group, method, "r", ["event_id"])
    split = cross.ranked(tied, "feature_01", group, method, "r", ["event_id"], blocks=n)
    same(plain, split, ["r"])


def test_average_rank_matches_pandas(hot_events):
    out = cross.xs_rank(hot_events, ["feature_01"], normalize=False).toPandas()
    want = out.groupby(["date_id", "time_id"])["feature_01"].rank(method="average")
    assert (want - out["feature_01_xrank"]).abs().max() == 0
    assert (want.isna() == out["feature_01_xrank"].isna()).all()


def test_norms_and_zscores(hot_events):
    for fn, name in (
        (cross.xs_rank, "feature_01_xrank_norm"),
        (cross.xs_zscore, "feature_01_xzscore"),
        (cross.cs_zscore_safe, "feature_01_cs_zscore"),
    ):
        same(fn(hot_events, ["feature_01"]), fn(hot_events, ["feature_01"], blocks=5), [name], tolerance=1e-6)


def test_global_rank_and_median(hot_events):
    plain = cross.rank_percentile(hot_events, ["feature_00"])
    same(plain, cross.rank_percentile(hot_events, ["feature_00"], blocks=9), ["feature_00_pct"])
    pdf = plain.toPandas()
    assert (pdf["feature_00"].rank(method="average") / len(pdf) - pdf["feature_00_pct"]).abs().max() < 1e-12
    exact = pdf["responder_6"].median()
    assert median_fit(hot_events).first()[0] == pytest.approx(exact)
    assert median_fit(hot_events, blocks=9).first()[0] == pytest.approx(exact)
    two = hot_events.withColumn("other", F.col("feature_00") * 2)
    same(rank_average(two, ["feature_00", "other"]), plain.withColumn("blend", F.col("feature_00_pct")), ["blend"])


@pytest.mark.parametrize("n", [2, 50])
def test_samples(hot_events, n):
    group = ["time_id"]
    same(
        sampling.group_sample_rank(hot_events, group, "event_id"),
        sampling.group_sample_rank(hot_events, group, "event_id", slices=n),
        ["sample_rank"],
    )
    plain = sampling.sample_by_group(hot_events, 0.2, group, "event_id")
    split = sampling.sample_by_group(hot_events, 0.2, group, "event_id", slices=n)
    ids = [sorted(r[0] for r in d.select("event_id").collect()) for d in (plain, split)]
    assert ids[0] == ids[1]
    sizes = hot_events.groupBy("time_id").count().toPandas().set_index("time_id")["count"].sort_index()
    kept = plain.groupBy("time_id").count().toPandas().set_index("time_id")["count"].sort_index()
    assert (kept == np.maximum(1, np.floor(sizes * 0.2))).all()
    assert sampling.sample_by_group(hot_events, None, group, "event_id") is hot_events


def test_blocks_bound_the_hot_entity(hot_events):
    """Only hot entities are cut, and their blocks are about as large as asked."""
    split = sizing.find_split(hot_events, ["symbol_id"], 20)
    cut = blocks.with_blocks(hot_events, ["symbol_id"], ORDER, split).groupBy("symbol_id", blocks.BLOCK).count()
    assert cut.agg(F.max("count")).first()[0] <= 2 * split.block_rows
    assert cut.where(F.col("symbol_id") != 0).agg(F.max(blocks.BLOCK)).first()[0] == 0
    assert cut.where(F.col("symbol_id") == 0).count() >= 5


def test_size_check_finds_only_hot_groups(hot_events, monkeypatch):
    assert sizing.find_split(hot_events, ["symbol_id"]) is None
    monkeypatch.setattr(sizing, "ONE_TASK_BYTES", 0)
    assert sizing.find_split(hot_events, ["symbol_id"]) is None
    monkeypatch.setattr(sizing, "ONE_TASK_ROWS", 1000)
    monkeypatch.setattr(sizing, "BLOCK_ROWS", 500)
    split = sizing.find_split(hot_events, ["symbol_id"])
    assert [r["symbol_id"] for r in split.hot.collect()] == [0]
    out = win.lag_features(hot_events, ["feature_00"], [1], order=ORDER)
    monkeypatch.undo()
    same(win.lag_features(hot_events, ["feature_00"], [1], order=ORDER), out, ["feature_00_lag1"])


def test_large_lookup_is_not_broadcast(hot_events, monkeypatch):
    side = hot_events.groupBy("symbol_id").agg(F.count("*").alias("n"))

    def hinted():
        return "broadcast" in sizing.lookup_side(side)._jdf.queryExecution().analyzed().toString().lower()

    assert hinted()
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    assert hinted()
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    assert not hinted()


@pytest.mark.parametrize("batches", [False, True])
def test_chain_split_equals_plain(hot_events, batches):
    def chain(n, how=None):
        return FeatureChain(
            [
                LagStep(["feature_00"], [3], order=ORDER, blocks=n, batches=how),
                RollingStep(["feature_01"], [4], ["mean", "max"], order=ORDER, blocks=n, batches=how),
            ]
        )

    a, b = chain(None), chain(30, batches)
    same(a.fit_transform(hot_events), b.fit_transform(hot_events), a.feature_names_out)


@pytest.mark.parametrize("values", [[], [None], [3.0], [3.0, 9.0], [1.0, 2.0, 9.0], [1.0] * 50 + [2.0] * 49 + [None], list(range(1000))])
def test_exact_medians(spark, values):
    """Tiny inputs, ties and even counts, where a bracket may miss the middle."""
    rows = [(None if v is None else float(v), 1.0) for v in values]
    df = spark.createDataFrame(rows, "x double, y double")
    got = {r["column"]: r["median"] for r in cross.exact_medians(df, ["x", "y"]).collect()}
    want = pd.Series([r[0] for r in rows], dtype=float).median()
    assert got.get("x") == (None if pd.isna(want) else want)
    assert got.get("y") == (1.0 if rows else None)
