"""Named queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog import checks, models, scoring, streams, tables, windows  # noqa: F401
from tickloom.catalog.common import EV, ORDER, QUERIES, SQL, W_E, events_panel, query, r6, s6
from tickloom.operators import metrics
from tickloom.plans.features import FeatureChain, LagStep, RollingStep


@query("daily_lag_score", f"""WITH {EV}, f AS (SELECT date_id, responder_6 AS y, weight AS w, lag(responder_6, 1) OVER w1 AS p,
  avg(feature_00) OVER (w1 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m FROM ev WINDOW w1 AS ({W_E})),
  d AS (SELECT date_id, sum(w * y * p) AS yp, sqrt(sum(w * y * y) * sum(w * p * p)) AS den, count(*) AS n_rows, avg(m) AS m
  FROM f WHERE p IS NOT NULL GROUP BY date_id)
  SELECT date_id, n_rows, {s6('CASE WHEN den >= 1e-10 THEN yp / den END', 'score')}, {s6('m', 'mean_roll5')} FROM d""")
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Scan, panel, lag and rolling features in one pass, then the daily score of the lagged target."""
    steps = [LagStep([S.TARGET], [1], order=ORDER), RollingStep(["feature_00"], [5], ["mean"], order=ORDER)]
    df = FeatureChain(steps).fit_transform(events_panel(spark, folder))
    y, p, w = F.col(S.TARGET), F.col(f"{S.TARGET}_lag1"), F.col(S.WEIGHT)
    sums = df.where(p.isNotNull()).groupBy(S.DATE).agg(
        F.count("*").alias("n_rows"),
        F.sum(w * y * p).alias("wyp"),
        F.sum(w * y * y).alias("wyy"),
        F.sum(w * p * p).alias("wpp"),
        F.avg("feature_00_roll5_mean").alias("mean_roll5"),
    )
    scored = metrics.score_per_date(sums)
    return scored.select(S.DATE, "n_rows", r6("score").alias("score"), r6("mean_roll5").alias("mean_roll5"))
