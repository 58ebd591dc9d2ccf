import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.catalog.common import ORDER, events_panel
from tickloom.catalog.streams import COLUMNS, CHUNKS, Arrivals
from tickloom.operators import windows as win
from tickloom.plans.features import LagStep, RollingStep
from tickloom.streaming.features import FeatureStream
from tickloom.streaming import keyed as keyed_module
from tickloom.streaming.keyed import KeyedFeatureStream

STATS = ["mean", "std", "min", "max", "zscore"]


def exact(out, want, names):
    a = out.select("event_id", *names).toPandas().set_index("event_id").sort_index().astype(float)
    b = want.select("event_id", *names).toPandas().set_index("event_id").sort_index().astype(float)
    assert a.index.equals(b.index)
    assert (a.isna() == b.isna()).all().all()
    assert (a - b).abs().fillna(0.0).max().max() < 1e-9


@pytest.fixture(scope="module")
def batch(spark, folder):
    return events_panel(spark, folder).select(*COLUMNS)


@pytest.fixture
def run(spark, folder):
    def go(stream, chunks=CHUNKS, **options):
        arrivals = Arrivals(spark, folder)
        for first, end in zip(chunks, chunks[1:]):
            arrivals.land(first, end)
            stream.run(arrivals.stream(spark), **options)
        return stream

    return go


def test_stream_equals_batch(spark, batch, run):
    """The steps must be exact: mean, deviation, extremes, z-score and lag of every row."""
    steps = [RollingStep(["feature_00", "feature_01"], [3, 8], STATS, order=ORDER), LagStep(["feature_01"], [1, 5], order=ORDER)]
    stream = run(FeatureStream(spark, steps, batch.schema))
    want = win.rolling_features(batch, ["feature_00", "feature_01"], [3, 8], STATS, order=ORDER)
    want = win.lag_features(want, ["feature_01"], [1, 5], order=ORDER)
    names = [n for s in steps for n in s.names()]
    noisy = {n for n in names if n.endswith("zscore")}
    exact(stream.output(), want, [n for n in names if n not in noisy])
    assert stream.n_updates == 3 and stream.n_symbols() == batch.select("symbol_id").distinct().count()


def test_split_stream_equals_batch(spark, batch, run):
    """The same with each batch cut in blocks, as for a hot entity."""
    step = RollingStep(["feature_00"], [4], ["mean", "max"], order=ORDER, blocks=5)
    want = win.rolling_features(batch, ["feature_00"], [4], ["mean", "max"], order=ORDER)
    exact(run(FeatureStream(spark, [step], batch.schema)).output(), want, step.names())


def test_keyed_state_equals_batch(spark, batch, run):
    keyed = KeyedFeatureStream(spark, batch.schema, rolling=["feature_01"], windows=[3, 8], stats=["mean", "std"],
                               lagged=["feature_01"], lags=[2], order=ORDER)
    want = win.rolling_features(batch, ["feature_01"], [3, 8], ["mean", "std"], order=ORDER)
    want = win.lag_features(want, ["feature_01"], [2], order=ORDER)
    exact(run(keyed).output(), want, keyed.names())


def test_keyed_warm_up(spark, batch, run):
    """With all history as initial state the first streamed rows equal the batch answer."""
    keyed = KeyedFeatureStream(spark, batch.schema, rolling=["feature_00"], windows=[5], stats=["mean"], order=ORDER)
    run(keyed, CHUNKS[1:], history=batch.where(F.col("date_id") < CHUNKS[1]))
    want = win.rolling_features(batch, ["feature_00"], [5], ["mean"], order=ORDER).where(F.col("date_id") >= CHUNKS[1])
    exact(keyed.output(), want, ["feature_00_roll5_mean"])


def test_small_buffer_is_refused(spark, batch):
    with pytest.raises(ValueError):
        FeatureStream(spark, [RollingStep(["feature_00"], [20], ["mean"], order=ORDER)], batch.schema, buffer_size=10)
    with pytest.raises(ValueError):
        KeyedFeatureStream(spark, batch.schema, rolling=["feature_00"], windows=[20], buffer_size=10)


def test_late_rows_are_counted(spark, batch):
    stream = FeatureStream(spark, [LagStep(["feature_00"], [1], order=ORDER)], batch.schema)
    stream.process(batch.where("date_id < 12"), 0)
    stream.process(batch.where("date_id >= 9 and date_id < 21"), 1)
    seen = batch.where("date_id < 12").groupBy("symbol_id").agg(F.max(F.struct(*ORDER)).alias("seen"))
    again = batch.where("date_id >= 9 and date_id < 21").join(seen, "symbol_id")
    assert stream.late_rows == again.where(F.struct(*ORDER) <= F.col("seen")).count() > 0
    assert stream.output().count() == batch.where("date_id < 21").count()
    assert stream.late().count() == stream.late_rows and stream.late().columns == [*batch.columns, "batch"]
    resumed = FeatureStream(spark, stream.steps, batch.schema, home=stream.home)
    assert resumed.n_updates == 2 and resumed.state().exceptAll(stream.state()).isEmpty()


def test_a_repeated_batch_changes_nothing(spark, batch):
    """A batch that runs again after a failure gives the same output and state."""
    stream = FeatureStream(spark, [RollingStep(["feature_00"], [5], ["mean"], order=ORDER)], batch.schema)
    stream.process(batch.where("date_id < 12"), 0)
    stream.process(batch.where("date_id >= 12"), 1)
    stream.process(batch.where("date_id >= 12"), 1)
    want = win.rolling_features(batch, ["feature_00"], [5], ["mean"], order=ORDER)
    exact(stream.output(), want, ["feature_00_roll5_mean"])


def test_buffer_bound_and_reset(spark, batch):
    stream = FeatureStream(spark, [LagStep(["feature_00"], [1], order=ORDER)], batch.schema, buffer_size=4)
    assert stream.state().isEmpty()
    stream.process(batch, 0)
    assert stream.state().groupBy("symbol_id").count().agg(F.max("count")).first()[0] == 4
    stream.reset()
    assert stream.state().isEmpty() and stream.n_updates == 0


def test_resume_from_home(spark, batch, folder):
    step = [RollingStep(["feature_00"], [5], ["mean"], order=ORDER)]
    arrivals = Arrivals(spark, folder)
    first = FeatureStream(spark, step, batch.schema)
    arrivals.land(0, 12)
    first.run(arrivals.stream(spark))
    second = FeatureStream(spark, step, batch.schema, home=first.home)
    arrivals.land(12, 30)
    second.run(arrivals.stream(spark))
    want = win.rolling_features(batch, ["feature_00"], [5], ["mean"], order=ORDER)
    exact(second.output(), want, ["feature_00_roll5_mean"])


def test_lag_rows_that_land_after_their_batch_are_late(spark, folder, run):
    """Chunk two's lag rows land after its batch: its rows keep null lags, and those lag rows are counted late."""
    from tickloom.catalog.streams import lag_arrivals, land_lags

    arrivals = Arrivals(spark, folder)
    lags, table = lag_arrivals(spark, folder)
    stream = FeatureStream(spark, [LagStep(["feature_00"], [1], order=ORDER)], arrivals.schema, lags=table)
    assert stream.late_lags().count() == 0
    for k, (first, end) in enumerate(zip(CHUNKS, CHUNKS[1:])):
        arrivals.land(first, end)
        if k != 1:
            land_lags(lags, table, first, end)
        stream.run(arrivals.stream(spark))
        if k == 1:
            land_lags(lags, table, first, end)
    out = stream.output()
    second = out.where(F.col("batch") == 1)
    assert second.count() > 0 and second.where(F.col("responder_6_lag_1").isNotNull()).count() == 0
    others = out.where(F.col("batch") != 1).join(lags, ["date_id", "time_id", "symbol_id"], "left_semi")
    assert others.where(F.col("responder_6_lag_1").isNull()).count() == 0
    late = stream.late_lags()
    want = lags.join(second.select("date_id", "time_id", "symbol_id").distinct(), ["date_id", "time_id", "symbol_id"], "left_semi")
    assert late.count() == want.count() > 0
    assert late.select("batch").distinct().collect() == [(1,)]
    # Rows already written stay as they were.
    assert stream.output().where(F.col("batch") == 1).where(F.col("responder_6_lag_1").isNotNull()).count() == 0


def test_keyed_late_rows_are_kept_apart(spark, folder, batch):
    """Rows landed again after their entity moved on are late: flagged and counted, and change no feature."""
    arrivals = Arrivals(spark, folder)
    keyed = KeyedFeatureStream(spark, batch.schema, lagged=["feature_00"], lags=[1], order=ORDER)
    arrivals.land(CHUNKS[0], CHUNKS[1])
    keyed.run(arrivals.stream(spark))
    arrivals.land(CHUNKS[0], CHUNKS[1])
    arrivals.land(CHUNKS[1], CHUNKS[-1])
    keyed.run(arrivals.stream(spark))
    first = batch.where(F.col("date_id") < CHUNKS[1])
    assert keyed.late_rows() == first.count() > 0
    assert sorted(r[0] for r in keyed.late().select("event_id").collect()) == sorted(r[0] for r in first.select("event_id").collect())
    out = keyed.output()
    assert out.count() == batch.count()
    exact(out, win.lag_features(batch, ["feature_00"], [1], order=ORDER), keyed.names())


def test_keyed_columns_equal_pandas_without_a_frame_per_statistic():
    rng = np.random.default_rng(4)
    x = rng.normal(size=200)
    x[rng.random(200) < 0.3] = np.nan
    x[50:80], x[90] = 0.1, np.inf
    stats, rows = ["mean", "std", "min", "max", "zscore"], pd.DataFrame({"x": x})
    got = keyed_module.trailing_columns({"x": x}, ["x"], [1, 5, 20], stats, ["x"], [1, 4, 300])
    for w in (1, 5, 20):
        frame = rows["x"].rolling(w, min_periods=1)
        want = {"mean": frame.mean(), "std": frame.std(), "min": frame.min(), "max": frame.max(), "zscore": (rows["x"] - frame.mean()) / (frame.std() + 1e-8)}
        for stat in stats:
            a, b = got[f"x_roll{w}_{stat}"], want[stat].to_numpy()
            if stat == "zscore":
                a, b = (np.where(frame.std() > 1e-6, v, 0.0) for v in (a, b))
            assert np.allclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True), (w, stat)
    for k in (1, 4, 300):
        assert np.array_equal(got[f"x_lag{k}"], rows["x"].shift(k).to_numpy(), equal_nan=True)
