"""Windows, sorts, samples and feature chains (WN, XS, SL, SP, FP, UD2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import (
    EV, LI, ORDER, W_E, big, events_panel, lineitem_panel, query, r6, rounded, s6,
)
from tickloom.operators import blend, cross, joins, metrics, sampling, splits
from tickloom.operators import windows as win
from tickloom.plans import features as plan
from tickloom.session import scratch_path


@query("lag_features", f"""WITH {EV} SELECT event_id, lag(feature_00, 1) OVER w AS feature_00_lag1,
  lag(feature_00, 4) OVER w AS feature_00_lag4, lag(feature_01, 1) OVER w AS feature_01_lag1,
  lag(feature_01, 4) OVER w AS feature_01_lag4 FROM ev WINDOW w AS ({W_E})""")
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    df = win.lag_features(events_panel(spark, folder), ["feature_00", "feature_01"], [1, 4], order=ORDER)
    return df.select("event_id", *[f"feature_0{i}_lag{k}" for i in (0, 1) for k in (1, 4)])


def _frame(n: int) -> str:
    return f"({W_E} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _rolling(name: str, stat: str, sql: str, min_periods: int = 1) -> None:
    """Register one rolling statistic over 5 and 20 rows of both features."""

    def column(c: str, n: int) -> str:
        expr = sql.format(c=c, w=f"w{n}")
        if min_periods > 1:
            expr = f"CASE WHEN count({c}) OVER w{n} >= {min_periods} THEN {expr} END"
        return s6(expr, f"{c}_roll{n}_{stat}")

    pairs = [(c, n) for c in ("feature_00", "feature_01") for n in (5, 20)]
    text = f"WITH {EV} SELECT event_id, {', '.join(column(c, n) for c, n in pairs)} FROM ev WINDOW w5 AS {_frame(5)}, w20 AS {_frame(20)}"

    @query(name, text)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = win.rolling_features(
            events_panel(spark, folder), ["feature_00", "feature_01"], [5, 20], [stat], order=ORDER, min_periods=min_periods
        )
        names = [f"{c}_roll{n}_{stat}" for c, n in pairs]
        return rounded(df.select("event_id", *names), *names)


_rolling("rolling_mean", "mean", "avg({c}) OVER {w}")
_rolling("rolling_std", "std", "stddev_samp({c}) OVER {w}", min_periods=3)
_rolling("rolling_min", "min", "min({c}) OVER {w}")
_rolling("rolling_max", "max", "max({c}) OVER {w}")


_ROUTES = {"windows": {"batches": False}, "batches": {"batches": True}, "blocks": {"batches": False, "blocks": 3}, "blocks_batches": {"batches": True, "blocks": 3}}
_ROUTE_COLUMNS = ["with_nan", "whole"]
_ROUTE_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


@query("trailing_routes", f"""WITH {EV}, b AS (SELECT *, CASE WHEN event_id % 7 <> 0 THEN feature_00 END AS with_nan,
  CAST(event_id % 100 AS INTEGER) AS whole FROM ev), r AS (SELECT event_id, lag(with_nan, 2) OVER w AS with_nan_lag2, CAST(lag(whole, 2) OVER w AS DOUBLE) AS whole_lag2,
  {', '.join(s6(f'{fn}({c}) OVER w5', f'{c}_roll5_{stat}') for c in _ROUTE_COLUMNS for stat, fn in _ROUTE_STATS.items())}
  FROM b WINDOW w AS ({W_E}), w5 AS {_frame(5)})
  SELECT route, r.* FROM r, (VALUES {', '.join(f"('{n}')" for n in _ROUTES)}) AS t(route)""")
def trailing_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Lag and rolling columns by every route, on a column with NaN and a whole-number column."""
    nan = F.when(F.col("event_id") % 7 != 0, F.col("feature_00")).otherwise(F.lit(float("nan")))
    base = events_panel(spark, folder).withColumns({"with_nan": nan, "whole": (F.col("event_id") % 100).cast("int")})
    names = [f"{c}_roll5_{s}" for c in _ROUTE_COLUMNS for s in _ROUTE_STATS]
    parts = []
    for route, how in _ROUTES.items():
        df = win.rolling_features(base, _ROUTE_COLUMNS, [5], list(_ROUTE_STATS), order=ORDER, **how)
        df = win.lag_features(df, _ROUTE_COLUMNS, [2], order=ORDER, **how)
        kept = rounded(df.select("event_id", "with_nan_lag2", F.col("whole_lag2").cast("double").alias("whole_lag2"), *names), *names)
        parts.append(kept.withColumn("route", F.lit(route)))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query("rolling_zscore", f"""WITH {EV}, z AS (SELECT event_id, feature_00, avg(feature_00) OVER w AS m, stddev_samp(feature_00) OVER w AS s
  FROM ev WINDOW w AS {_frame(20)}) SELECT event_id,
  round(CASE WHEN s > 1e-6 THEN (feature_00 - m) / (s + 1e-8) END + 1e-9, 6) + 0.0 AS feature_00_roll20_zscore FROM z""")
def rolling_zscore(spark: SparkSession, folder: str) -> DataFrame:
    """Shown where the deviation is above rounding noise; equal values give 0 or noise over 1e-8."""
    df = win.rolling_features(events_panel(spark, folder), ["feature_00"], [20], ["std", "zscore"], order=ORDER)
    z = F.when(F.col("feature_00_roll20_std") > 1e-6, F.col("feature_00_roll20_zscore"))
    return df.select("event_id", r6(z).alias("feature_00_roll20_zscore"))


@query("ewm_mean", f"""WITH RECURSIVE {EV}, n AS (SELECT event_id, symbol_id, feature_01, feature_00, row_number() OVER ({W_E}) AS k FROM ev),
  e AS (SELECT event_id, symbol_id, k, feature_00 AS y0, feature_01 AS y1 FROM n WHERE k = 1
  UNION ALL SELECT n.event_id, n.symbol_id, n.k, n.feature_00 * (1.0/3) + e.y0 * (2.0/3),
  CASE WHEN n.feature_01 IS NULL THEN e.y1 WHEN e.y1 IS NULL THEN n.feature_01 ELSE n.feature_01 * (2.0/21) + e.y1 * (19.0/21) END
  FROM e JOIN n ON n.symbol_id = e.symbol_id AND n.k = e.k + 1)
  SELECT event_id, {s6('y0', 'feature_00_ewm5')}, {s6('y1', 'feature_01_ewm20')} FROM e""")
def ewm_mean(spark: SparkSession, folder: str) -> DataFrame:
    df = win.ewm_mean(events_panel(spark, folder), ["feature_00"], [5.0], order=ORDER)
    df = win.ewm_mean(df, ["feature_01"], [20.0], order=ORDER)
    names = ["feature_00_ewm5", "feature_01_ewm20"]
    return rounded(df.select("event_id", *names), *names)


_RANKS = {
    "average": "rank() OVER o + (count(*) OVER (PARTITION BY date_id, time_id, feature_01) - 1) / 2.0",
    "min": "rank() OVER o",
    "max": "rank() OVER o + count(*) OVER (PARTITION BY date_id, time_id, feature_01) - 1",
    "dense": "dense_rank() OVER o",
    "ordinal": "row_number() OVER (PARTITION BY date_id, time_id ORDER BY feature_01 NULLS LAST, event_id)",
    "random": """row_number() OVER (PARTITION BY date_id, time_id ORDER BY feature_01 NULLS LAST,
      substr(md5('42:' || event_id), 1, 8), event_id)""",
}


@query("xs_rank", f"WITH {EV} SELECT event_id, " + ", ".join(
    f"CAST(CASE WHEN feature_01 IS NOT NULL THEN {sql} END AS DOUBLE) AS rank_{m}" for m, sql in _RANKS.items())
    + " FROM ev WINDOW o AS (PARTITION BY date_id, time_id ORDER BY feature_01 NULLS LAST)")
def xs_rank(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder)
    for m in cross.RANK_METHODS:
        df = cross.ranked(df, "feature_01", S.SNAPSHOT, m, f"rank_{m}", ["event_id"])
    return df.select("event_id", *[f"rank_{m}" for m in cross.RANK_METHODS])


_AVG_RANK = f"""r AS (SELECT event_id, date_id, time_id, CASE WHEN feature_01 IS NOT NULL THEN {_RANKS['average']} END AS k
  FROM ev WINDOW o AS (PARTITION BY date_id, time_id ORDER BY feature_01 NULLS LAST))"""


@query("xs_rank_norm", f"""WITH {EV}, {_AVG_RANK}
  SELECT event_id, {s6('(k - avg(k) OVER w) / (stddev_samp(k) OVER w + 1e-8)', 'feature_01_xrank_norm')}
  FROM r WINDOW w AS (PARTITION BY date_id, time_id)""")
def xs_rank_norm(spark: SparkSession, folder: str) -> DataFrame:
    df = cross.xs_rank(events_panel(spark, folder), ["feature_01"])
    return df.select("event_id", r6("feature_01_xrank_norm").alias("feature_01_xrank_norm"))


@query("xs_zscore", f"""WITH {EV} SELECT event_id,
  {s6('(feature_00 - avg(feature_00) OVER w) / (stddev_samp(feature_00) OVER w + 1e-8)', 'feature_00_xzscore')},
  {s6('(feature_01 - avg(feature_01) OVER w) / (stddev_samp(feature_01) OVER w + 1e-8)', 'feature_01_xzscore')}
  FROM ev WINDOW w AS (PARTITION BY date_id, time_id)""")
def xs_zscore(spark: SparkSession, folder: str) -> DataFrame:
    df = cross.xs_zscore(events_panel(spark, folder), ["feature_00", "feature_01"])
    return rounded(df.select("event_id", "feature_00_xzscore", "feature_01_xzscore"), "feature_00_xzscore", "feature_01_xzscore")


@query("cs_zscore_safe", f"""WITH {EV}, z AS (SELECT event_id, feature_01 AS x, avg(feature_01) OVER w AS m, stddev_samp(feature_01) OVER w AS s
  FROM ev WINDOW w AS (PARTITION BY date_id, time_id)) SELECT event_id,
  round(CAST(CAST(CASE WHEN s IS NOT NULL AND s > 0 THEN (x - m) / s ELSE 0 END AS FLOAT) AS DOUBLE), 4) + 0.0 AS feature_01_cs_zscore FROM z""")
def cs_zscore_safe(spark: SparkSession, folder: str) -> DataFrame:
    df = cross.cs_zscore_safe(events_panel(spark, folder), ["feature_01"])
    z = F.round(F.col("feature_01_cs_zscore").cast("double"), 4) + F.lit(0.0)
    return df.select("event_id", z.alias("feature_01_cs_zscore"))


@query("rank_percentile", f"""WITH {EV} SELECT event_id,
  {s6('(rank() OVER (ORDER BY feature_00) + (count(*) OVER (PARTITION BY feature_00) - 1) / 2.0) / count(*) OVER ()', 'feature_00_pct')} FROM ev""")
def rank_percentile(spark: SparkSession, folder: str) -> DataFrame:
    df = cross.rank_percentile(events_panel(spark, folder), ["feature_00"])
    return df.select("event_id", r6("feature_00_pct").alias("feature_00_pct"))


DAILY_SQL = LI + """, ds AS (SELECT date_id, sum(weight * responder_6 * prediction) AS yp,
  sqrt(sum(weight * pow(responder_6, 2)) * sum(weight * pow(prediction, 2))) AS den, count(*) AS n FROM li
  GROUP BY date_id), daily AS (SELECT date_id, CASE WHEN den >= 1e-10 THEN yp / den END AS score FROM ds)"""


def daily_scores(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.score_per_date(metrics.date_sums(lineitem_panel(spark, folder)))


@query("rolling_daily_score", f"""WITH {DAILY_SQL}, k AS (SELECT least(20, count(*) // 5) AS w FROM daily),
  s AS (SELECT date_id, score, row_number() OVER (ORDER BY date_id) AS i,
  avg(coalesce(score, 0)) OVER (ORDER BY date_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS m FROM daily)
  SELECT date_id, {s6('score', 'score')}, {s6('m', 'rolling_score')} FROM s, k WHERE i >= w AND w = 20""")
def rolling_daily_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.rolling_daily_score(daily_scores(spark, folder)), "score", "rolling_score")


_BIAS = "d AS (SELECT date_id, avg(responder_6 - prediction) AS bias FROM li GROUP BY date_id)"
SMOOTH = _BIAS + """, sm AS (SELECT date_id, bias, CASE WHEN count(*) OVER () >= 20 THEN
  (sum(bias) OVER w + (20 - count(*) OVER w) * first_value(bias) OVER (ORDER BY date_id)) / 20 ELSE bias END AS smoothed
  FROM d WINDOW w AS (ORDER BY date_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


@query("smoothed_bias", f"WITH {LI}, {SMOOTH} SELECT date_id, {s6('bias', 'bias')}, {s6('smoothed', 'smoothed')} FROM sm")
def smoothed_bias(spark: SparkSession, folder: str) -> DataFrame:
    bias = blend.date_bias(lineitem_panel(spark, folder), S.TARGET, S.PREDICTION)
    return rounded(blend.smoothed_bias(bias), "bias", "smoothed")


HASH = "substr(md5('42:' || event_id), 1, 8), event_id"


@query("group_sample_rank", f"""WITH {EV} SELECT event_id,
  row_number() OVER (PARTITION BY date_id ORDER BY {HASH}) AS sample_rank FROM ev""")
def group_sample_rank(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.group_sample_rank(events_panel(spark, folder), [S.DATE], "event_id")
    return df.select("event_id", big("sample_rank"))


@query("group_size", f"WITH {EV} SELECT event_id, count(*) OVER (PARTITION BY date_id, time_id) AS group_size FROM ev")
def group_size(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.group_size(events_panel(spark, folder), S.SNAPSHOT).select("event_id", "group_size")


# Sorts, limits, samples


@query("sort_panel", f"WITH {EV} SELECT symbol_id, date_id, time_id, event_id FROM ev ORDER BY 1, 2, 3, 4")
def sort_panel(spark: SparkSession, folder: str) -> DataFrame:
    keys = [S.SYMBOL, S.DATE, S.TIME, "event_id"]
    return events_panel(spark, folder).select(*keys).orderBy(*keys)


@query("limit_rows", f"WITH {EV} SELECT date_id, time_id, event_id FROM ev ORDER BY 1, 2, 3 LIMIT 500")
def limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return events_panel(spark, folder).select(*ORDER).orderBy(*ORDER).limit(500)


IMPORTANCE_SQL = """imp AS (SELECT p_brand || '/' || p_type AS feature, sum(l_extendedprice) AS importance
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)"""


def importance(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by brand and type in the place of feature importance."""
    lines, part = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "part"))
    by_part = lines.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("v"))
    named = by_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    name = F.concat("p_brand", F.lit("/"), "p_type").alias("feature")
    return named.groupBy(name).agg(F.sum("v").alias("importance"))


@query("top_features", f"WITH {IMPORTANCE_SQL} SELECT feature, {s6('importance', 'importance')} FROM imp ORDER BY imp.importance DESC, feature LIMIT 30")
def top_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.top_features(importance(spark, folder), 30), "importance")


@query("importance_share", f"""WITH {IMPORTANCE_SQL}, t AS (SELECT importance FROM imp ORDER BY importance DESC, feature LIMIT 10)
  SELECT {s6('(SELECT sum(importance) FROM t) / sum(importance)', 'share')} FROM imp""")
def importance_share(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.importance_share(importance(spark, folder)), "share")


_BY_SYMBOL = """SELECT symbol_id, count(*) AS n_rows, round(sqrt(avg(pow(responder_6 - prediction, 2))) + 1e-9, 6) + 0.0 AS rmse,
  round(avg(abs(responder_6 - prediction)) + 1e-9, 6) + 0.0 AS mae, round(avg(prediction) + 1e-9, 6) + 0.0 AS mean_pred,
  round(avg(responder_6) + 1e-9, 6) + 0.0 AS mean_true FROM li GROUP BY symbol_id"""


@query("error_by_symbol", f"WITH {LI} {_BY_SYMBOL}")
def error_by_symbol(spark: SparkSession, folder: str) -> DataFrame:
    df = metrics.error_by_symbol(lineitem_panel(spark, folder), S.TARGET, S.PREDICTION)
    return rounded(df, "rmse", "mae", "mean_pred", "mean_true")


@query("worst_symbols", f"""WITH {LI} SELECT symbol_id, n_rows, rmse, mae, mean_pred, mean_true FROM ({_BY_SYMBOL}) t
  ORDER BY rmse DESC, symbol_id LIMIT 20""")
def worst_symbols(spark: SparkSession, folder: str) -> DataFrame:
    df = metrics.error_by_symbol(lineitem_panel(spark, folder), S.TARGET, S.PREDICTION)
    return rounded(df, "rmse", "mae", "mean_pred", "mean_true").orderBy(F.desc("rmse"), S.SYMBOL).limit(20)


@query("last_n_steps", f"WITH {EV} SELECT DISTINCT date_id, time_id FROM ev ORDER BY 1 DESC, 2 DESC LIMIT 30")
def last_n_steps(spark: SparkSession, folder: str) -> DataFrame:
    return joins.last_n_steps(events_panel(spark, folder), 30)


@query("distinct_dates", f"WITH {LI} SELECT DISTINCT date_id FROM li")
def distinct_dates(spark: SparkSession, folder: str) -> DataFrame:
    return splits.distinct_dates(lineitem_panel(spark, folder))


@query("sample_by_group", f"""WITH {EV}, n AS (SELECT *, row_number() OVER (PARTITION BY date_id, time_id ORDER BY {HASH}) AS k,
  count(*) OVER (PARTITION BY date_id, time_id) AS size FROM ev)
  SELECT event_id, date_id, time_id FROM n WHERE k <= greatest(1, floor(size * 0.2))""")
def sample_by_group(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.sample_by_group(events_panel(spark, folder), 0.2, key="event_id")
    return df.select("event_id", S.DATE, S.TIME)


@query("sample_rows", f"WITH {EV} SELECT event_id, feature_00 FROM ev ORDER BY {HASH} LIMIT 1000")
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_rows(events_panel(spark, folder).select("event_id", "feature_00"), 1000, "event_id")


# Feature chains

CHAIN_CONFIG = {
    "lag": {"columns": ["feature_00"], "windows": [2, 4]},
    "rolling": {"columns": ["feature_00", "feature_01"], "windows": [5, 10], "stats": ["mean", "std"]},
    "cross_sectional": {"columns": ["feature_01"], "normalize": True},
}
_PARTS = ["lag(feature_00, 2) OVER w AS feature_00_lag2", "lag(feature_00, 4) OVER w AS feature_00_lag4"] + [
    s6(f"{f}({c}) OVER w{n}", f"{c}_roll{n}_{stat}")
    for c in ("feature_00", "feature_01") for n in (5, 10) for stat, f in (("mean", "avg"), ("std", "stddev_samp"))
]
CHAIN_SQL = f"""WITH {EV}, {_AVG_RANK}, k AS (SELECT event_id,
  {s6('(k - avg(k) OVER w) / (stddev_samp(k) OVER w + 1e-8)', 'feature_01_xrank_norm')}
  FROM r WINDOW w AS (PARTITION BY date_id, time_id)), e AS (SELECT event_id, {', '.join(_PARTS)}
  FROM ev WINDOW w AS ({W_E}), w5 AS {_frame(5)}, w10 AS {_frame(10)}) SELECT * FROM e JOIN k USING (event_id)"""


def _chain_output(df: DataFrame, names: list[str]) -> DataFrame:
    return rounded(df.select("event_id", *names), *[n for n in names if "_lag" not in n])


@query("transformer_contract", f"""WITH {EV} SELECT event_id, feature_00, feature_01, lag(feature_00, 1) OVER w AS feature_00_lag1
  FROM ev WINDOW w AS ({W_E})""")
def transformer_contract(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder)
    out = plan.LagStep(["feature_00"], [1], order=ORDER).fit_transform(df)
    return out.select("event_id", "feature_00", "feature_01", "feature_00_lag1")


@query("feature_chain", CHAIN_SQL)
def feature_chain(spark: SparkSession, folder: str) -> DataFrame:
    steps = [
        plan.LagStep(["feature_00"], [2, 4], order=ORDER),
        plan.RollingStep(["feature_00", "feature_01"], [5, 10], order=ORDER),
        plan.RankStep(["feature_01"]),
    ]
    chain = plan.FeatureChain(steps)
    return _chain_output(chain.fit_transform(events_panel(spark, folder)), chain.feature_names_out)


@query("default_features", CHAIN_SQL)
def default_features(spark: SparkSession, folder: str) -> DataFrame:
    """The configured lag, rolling and rank features."""
    chain = plan.build_features(CHAIN_CONFIG, ORDER)
    return _chain_output(chain.fit_transform(events_panel(spark, folder)), chain.feature_names_out)


@query("features_reloaded", CHAIN_SQL)
def features_reloaded(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted chain stored, loaded and applied."""
    df = events_panel(spark, folder)
    path = scratch_path(spark, "chain")
    plan.build_features(CHAIN_CONFIG, ORDER).fit(df).save(spark, path)
    chain = plan.FeatureChain.load(spark, path)
    return _chain_output(chain.transform(df), chain.feature_names_out)


@query("custom_transformer", f"""WITH {EV} SELECT event_id, {s6('feature_00 * weight', 'weighted_value')},
  {s6('avg(feature_00 * weight) OVER w5', 'weighted_value_roll5_mean')} FROM ev WINDOW w5 AS {_frame(5)}""")
def custom_transformer(spark: SparkSession, folder: str) -> DataFrame:
    """A user function as a step, read by a built-in step after it."""
    product = plan.FunctionStep(
        lambda t: t.withColumn("weighted_value", F.col("feature_00") * F.col(S.WEIGHT)), ["weighted_value"]
    )
    chain = plan.FeatureChain([product, plan.RollingStep(["weighted_value"], [5], ["mean"], order=ORDER)])
    out = chain.fit_transform(events_panel(spark, folder)).select("event_id", *chain.feature_names_out)
    return rounded(out, *chain.feature_names_out)
