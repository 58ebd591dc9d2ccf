"""Streams over the events table, arriving in chunks of days (SS, ST2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import EV, GRID, ORDER, W_E, events_panel, grid_panel, lag_table, query, rounded, s6
from tickloom.catalog.windows import _frame
from tickloom.plans.features import LagStep, RollingStep
from tickloom.session import scratch_path
from tickloom.streaming import features as st
from tickloom.streaming import keyed

# The first day of each chunk of the events, and the end.
CHUNKS = (0, 12, 21, 30)
COLUMNS = [*S.KEYS, "event_id", "feature_00", "feature_01", S.TARGET, S.WEIGHT]
STATS = ["mean", "std", "min", "max"]


class Arrivals:
    """A landing folder that receives the events chunk by chunk."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.panel = events_panel(spark, folder).select(*COLUMNS)
        self.path = scratch_path(spark, "landing")
        self.schema = self.panel.schema

    def land(self, first: int, end: int) -> None:
        """The last chunk has no end, so later days are never left out."""
        part = self.panel.where(F.col(S.DATE) >= first)
        if end != CHUNKS[-1]:
            part = part.where(F.col(S.DATE) < end)
        part.write.mode("append").parquet(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        return st.file_stream(spark, self.path, self.schema)


def _steps() -> list:
    return [
        RollingStep(["feature_00", "feature_01"], [5, 20], STATS, order=ORDER),
        LagStep(["feature_00"], [1, 4], order=ORDER),
    ]


def _run(spark: SparkSession, folder: str, steps: Sequence, chunks: Sequence[int] = CHUNKS, **options) -> st.FeatureStream:
    """One incremental run per chunk, on the same checkpoint and state."""
    arrivals = Arrivals(spark, folder)
    stream = st.FeatureStream(spark, list(steps), arrivals.schema, **options)
    for first, end in zip(chunks, chunks[1:]):
        arrivals.land(first, end)
        stream.run(arrivals.stream(spark))
    return stream


def lag_arrivals(spark: SparkSession, folder: str) -> tuple[DataFrame, st.LagTable]:
    """The responders of the day before per key, and an empty landing folder for them."""
    lags = lag_table(grid_panel(spark, folder))
    return lags, st.LagTable(scratch_path(spark, "lags"), lags.schema)


def land_lags(lags: DataFrame, table: st.LagTable, first: int, end: int) -> None:
    part = lags.where(F.col(S.DATE) >= first)
    table.land(part if end == CHUNKS[-1] else part.where(F.col(S.DATE) < end))


_FN = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _stats_sql(columns: Sequence[str], sizes: Sequence[int], stats: Sequence[str]) -> str:
    return ", ".join(s6(f"{_FN[s]}({c}) OVER w{n}", f"{c}_roll{n}_{s}") for c in columns for n in sizes for s in stats)


_WINDOWS = f"WINDOW w AS ({W_E}), w5 AS {_frame(5)}, w20 AS {_frame(20)}"


@query("stream_rolling", f"WITH {EV} SELECT event_id, {_stats_sql(['feature_00', 'feature_01'], [5, 20], STATS)} FROM ev {_WINDOWS}")
def stream_rolling(spark: SparkSession, folder: str) -> DataFrame:
    steps = _steps()[:1]
    names = steps[0].names()
    return rounded(_run(spark, folder, steps).output().select("event_id", *names), *names)


@query("stream_rolling_keyed", f"WITH {EV} SELECT event_id, {_stats_sql(['feature_00', 'feature_01'], [5, 20], STATS)}, "
       f"lag(feature_00, 1) OVER w AS feature_00_lag1, lag(feature_00, 4) OVER w AS feature_00_lag4 FROM ev {_WINDOWS}")
def stream_rolling_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """The same features with the buffer of each entity in Spark's state store."""
    arrivals = Arrivals(spark, folder)
    run = keyed.KeyedFeatureStream(
        spark, arrivals.schema, rolling=["feature_00", "feature_01"], windows=[5, 20], stats=STATS,
        lagged=["feature_00"], lags=[1, 4], order=ORDER,
    )
    for first, end in zip(CHUNKS, CHUNKS[1:]):
        arrivals.land(first, end)
        run.run(arrivals.stream(spark))
    names = run.names()
    return rounded(run.output().select("event_id", *names), *[n for n in names if "_roll" in n])


@query("stream_lag", f"""WITH {EV} SELECT event_id, lag(feature_00, 1) OVER w AS feature_00_lag1, lag(feature_00, 4) OVER w AS feature_00_lag4
  FROM ev {_WINDOWS}""")
def stream_lag(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, _steps()[1:]).output().select("event_id", "feature_00_lag1", "feature_00_lag4")


@query("stream_update_evict", f"""WITH {EV}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol_id ORDER BY date_id DESC, time_id DESC, event_id DESC) AS k FROM ev)
  SELECT event_id, symbol_id, feature_00 FROM k WHERE k <= 8""")
def stream_update_evict(spark: SparkSession, folder: str) -> DataFrame:
    """The buffers after the last batch: the newest eight rows of each user."""
    stream = _run(spark, folder, _steps()[1:], buffer_size=8)
    return stream.state().select("event_id", S.SYMBOL, "feature_00")


@query("stream_warm_up", f"""WITH {EV}, s AS (SELECT DISTINCT date_id, time_id FROM ev WHERE date_id < 12 ORDER BY 1 DESC, 2 DESC LIMIT 30),
  kept AS (SELECT ev.* FROM ev JOIN s USING (date_id, time_id) UNION ALL SELECT * FROM ev WHERE date_id >= 12),
  f AS (SELECT event_id, date_id, {_stats_sql(['feature_00'], [5], ['mean', 'std'])} FROM kept {_WINDOWS})
  SELECT event_id, feature_00_roll5_mean, feature_00_roll5_std FROM f WHERE date_id >= 12""")
def stream_warm_up(spark: SparkSession, folder: str) -> DataFrame:
    arrivals = Arrivals(spark, folder)
    step = RollingStep(["feature_00"], [5], ["mean", "std"], order=ORDER)
    stream = st.FeatureStream(spark, [step], arrivals.schema)
    stream.warm_up(arrivals.panel.where(F.col(S.DATE) < CHUNKS[1]))
    for first, end in zip(CHUNKS[1:], CHUNKS[2:]):
        arrivals.land(first, end)
        stream.run(arrivals.stream(spark))
    return rounded(stream.output().select("event_id", *step.names()), *step.names())


@query("stream_reset", f"""WITH {EV}, late AS (SELECT * FROM ev WHERE date_id >= 21)
  SELECT event_id, {_stats_sql(['feature_00'], [5], ['mean'])}, 1 AS n_updates FROM late {_WINDOWS}""")
def stream_reset(spark: SparkSession, folder: str) -> DataFrame:
    """After a reset the next chunk starts without any past."""
    step = RollingStep(["feature_00"], [5], ["mean"], order=ORDER)
    stream = _run(spark, folder, [step], CHUNKS[:2])
    stream.reset()
    arrivals = Arrivals(spark, folder)
    arrivals.land(*CHUNKS[2:])
    stream.run(arrivals.stream(spark))
    out = stream.output().select("event_id", *step.names(), F.lit(stream.n_updates).alias("n_updates"))
    return rounded(out, *step.names())


@query("stream_score", f"""WITH {EV}, f AS (SELECT event_id, avg(feature_00) OVER w5 AS m, lag(feature_00, 1) OVER w AS l FROM ev {_WINDOWS})
  SELECT event_id, CASE WHEN l IS NOT NULL THEN {s6('greatest(-5.0, least(5.0, 0.2 * (m - l)))', 'p')[:-5]} END AS prediction FROM f""")
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """Features, a column the model asks for and the stream lacks, prediction, limits, then the state."""

    def predict(df: DataFrame) -> DataFrame:
        gap = F.col("feature_00_roll5_mean") - F.col("feature_00_lag1")
        return df.withColumn(S.PREDICTION, 0.2 * gap + F.coalesce("feature_09", F.lit(0.0)))

    steps = [RollingStep(["feature_00"], [5], ["mean"], order=ORDER), LagStep(["feature_00"], [1], order=ORDER)]
    stream = _run(spark, folder, steps, scorer=st.Scorer(predict, required=["feature_09"]))
    return rounded(stream.output().select("event_id", S.PREDICTION), S.PREDICTION)


@query("stream_batches", f"""WITH {EV} SELECT CASE WHEN date_id < 12 THEN 0 ELSE 1 END AS batch, count(*) AS n_rows FROM ev
  WHERE date_id < 21 GROUP BY 1""")
def stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches arrive in order, the cap stops after two."""
    stream = _run(spark, folder, _steps()[1:], max_batches=2)
    return stream.output().groupBy("batch").agg(F.count("*").alias("n_rows"))


@query("stream_batches_resumed", f"""WITH {EV} SELECT event_id, CASE WHEN date_id < 12 THEN 0 WHEN date_id < 21 THEN 1 ELSE 2 END AS batch,
  {_stats_sql(['feature_00'], [5], ['mean'])} FROM ev {_WINDOWS}""")
def stream_batches_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """The cap stops after two batches; a later stream with the same home gets the third, and no row is lost."""
    steps = [RollingStep(["feature_00"], [5], ["mean"], order=ORDER)]
    arrivals = Arrivals(spark, folder)
    capped = st.FeatureStream(spark, steps, arrivals.schema, max_batches=2)
    for first, end in zip(CHUNKS, CHUNKS[1:]):
        arrivals.land(first, end)
        capped.run(arrivals.stream(spark))
    later = st.FeatureStream(spark, steps, arrivals.schema, home=capped.home)
    later.run(arrivals.stream(spark))
    return rounded(later.output().select("event_id", "batch", "feature_00_roll5_mean"), "feature_00_roll5_mean")


@query("union_batches", f"WITH {EV} SELECT event_id, CASE WHEN date_id < 12 THEN 0 WHEN date_id < 21 THEN 1 ELSE 2 END AS batch FROM ev")
def union_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, _steps()[1:]).output().select("event_id", "batch")


@query("stream_running_score", f"""WITH {EV}, d AS (SELECT date_id, sum(weight * responder_6 * (feature_00 * 0.1)) AS yp,
  sqrt(sum(weight * pow(responder_6, 2)) * sum(weight * pow(feature_00 * 0.1, 2))) AS den, count(*) AS n_rows FROM ev GROUP BY 1)
  SELECT date_id, n_rows, {s6('CASE WHEN den >= 1e-10 THEN yp / den END', 'score')} FROM d""")
def stream_running_score(spark: SparkSession, folder: str) -> DataFrame:
    arrivals = Arrivals(spark, folder)
    home = scratch_path(spark, "score")
    for first, end in zip(CHUNKS, CHUNKS[1:]):
        arrivals.land(first, end)
        stream = arrivals.stream(spark).withColumn(S.PREDICTION, F.col("feature_00") * 0.1)
        path, _ = st.running_score(stream, home)
    return rounded(spark.read.parquet(path).select(S.DATE, F.col("rows").alias("n_rows"), "score"), "score")


@query("stream_latency", f"WITH {EV} SELECT CAST(3 AS BIGINT) AS n_batches, CAST(count(*) AS BIGINT) AS n_rows, true AS measured FROM ev")
def stream_latency(spark: SparkSession, folder: str) -> DataFrame:
    """Batches, rows, and whether a mean latency was measured; its value depends on the machine."""
    summary = st.latency_summary(_run(spark, folder, _steps()[1:]).latencies())
    return summary.select("n_batches", "n_rows", (F.col("mean_latency_ms") > 0).alias("measured"))


@query("stream_lag_table", f"""WITH {GRID}, f AS (SELECT event_id, date_id, time_id, symbol_id, lag(feature_00, 1) OVER w AS l FROM ev WINDOW w AS ({W_E}))
  SELECT f.event_id, {s6('f.l', 'feature_00_lag1')}, {s6('0.5 * f.l + g.responder_6', 'prediction')}, {s6('g.responder_6', 'responder_6_lag_1')}
  FROM f LEFT JOIN grid g ON g.date_id + 1 = f.date_id AND g.time_id = f.time_id AND g.symbol_id = f.symbol_id""")
def stream_lag_table(spark: SparkSession, folder: str) -> DataFrame:
    """Lag rows land with each chunk, a second input that the stream reads at each batch; the model uses them."""
    arrivals = Arrivals(spark, folder)
    lags, table = lag_arrivals(spark, folder)

    def predict(df: DataFrame) -> DataFrame:
        return df.withColumn(S.PREDICTION, 0.5 * F.col("feature_00_lag1") + F.col("responder_6_lag_1"))

    scorer = st.Scorer(predict, low=None, high=None)
    stream = st.FeatureStream(spark, [LagStep(["feature_00"], [1], order=ORDER)], arrivals.schema, lags=table, scorer=scorer)
    for first, end in zip(CHUNKS, CHUNKS[1:]):
        arrivals.land(first, end)
        land_lags(lags, table, first, end)
        stream.run(arrivals.stream(spark))
    out = stream.output().select("event_id", "feature_00_lag1", S.PREDICTION, "responder_6_lag_1")
    return rounded(out, "feature_00_lag1", S.PREDICTION, "responder_6_lag_1")
