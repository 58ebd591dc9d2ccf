"""Baselines, models, calibration and blends (BL, ML, CA, EN)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import LI, lineitem_panel, query, r6, rounded, s6, stored_panel
from tickloom.catalog.windows import SMOOTH
from tickloom.operators import baselines, blend, metrics, splits
from tickloom.plans import models
from tickloom.session import checkpointed

FEATURES = ["feature_00", "feature_01", S.TIME]
KEYS = [*S.KEYS, "l_orderkey", "l_partkey"]
# Small trees keep a whole-table fit short; the presets are the full sizes.
SMALL = {"n_estimators": 4, "learning_rate": 0.2, "max_depth": 3, "min_data_in_leaf": 20, "random_state": 42}
LOW, HIGH = 1200, 1250


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    return lineitem_panel(spark, folder).drop(S.PREDICTION)


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(S.DATE) < LOW), df.where(F.col(S.DATE) >= HIGH)


_SPLIT = f"tr AS (SELECT * FROM li WHERE date_id < {LOW}), va AS (SELECT * FROM li WHERE date_id >= {HIGH})"


def _per_symbol(df: DataFrame, column: str = S.PREDICTION) -> DataFrame:
    return df.groupBy(S.SYMBOL).agg(F.count("*").alias("n"), r6(F.avg(column)).alias(column))


@query("zero_baseline", f"WITH {LI}, {_SPLIT} SELECT symbol_id, count(*) AS n, 0.0::DOUBLE AS prediction FROM va GROUP BY 1")
def zero_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _per_symbol(baselines.zero_baseline(_parts(_panel(spark, folder))[1]))


@query("weighted_mean_baseline", f"""WITH {LI}, {_SPLIT}, g AS (SELECT sum(weight * responder_6) / sum(weight) AS v FROM tr)
  SELECT symbol_id, count(*) AS n, {s6('max(v)', 'prediction')} FROM va, g GROUP BY 1""")
def weighted_mean_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _per_symbol(baselines.weighted_mean_baseline(*_parts(_panel(spark, folder))))


@query("median_baseline", f"""WITH {LI}, {_SPLIT}, g AS (SELECT median(responder_6) AS v FROM tr)
  SELECT symbol_id, count(*) AS n, {s6('max(v)', 'prediction')} FROM va, g GROUP BY 1""")
def median_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _per_symbol(baselines.median_baseline(*_parts(_panel(spark, folder))))


@query("symbol_mean_baseline", f"""WITH {LI}, {_SPLIT}, m AS (SELECT symbol_id, sum(weight * responder_6) / sum(weight) AS v FROM tr GROUP BY 1),
  g AS (SELECT sum(weight * responder_6) / sum(weight) AS v FROM tr)
  SELECT va.symbol_id, count(*) AS n, {s6('max(coalesce(m.v, g.v))', 'prediction')} FROM va LEFT JOIN m USING (symbol_id), g GROUP BY 1""")
def symbol_mean_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _per_symbol(baselines.symbol_mean_baseline(*_parts(_panel(spark, folder))))


# Calibration and blends


@query("temporal_bias", f"""WITH {LI}, {SMOOTH.replace('FROM li GROUP', 'FROM li WHERE date_id < 2000 GROUP')},
  g AS (SELECT avg(responder_6 - prediction) AS v FROM li WHERE date_id < 2000)
  SELECT date_id, count(*) AS n, {s6('avg(prediction + coalesce(smoothed, v))', 'corrected')} FROM li LEFT JOIN sm USING (date_id), g GROUP BY 1""")
def temporal_bias(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem_panel(spark, folder)
    out = blend.temporal_bias(df, df.where(F.col(S.DATE) < 2000), S.TARGET, S.PREDICTION)
    return out.groupBy(S.DATE).agg(F.count("*").alias("n"), r6(F.avg("corrected")).alias("corrected"))


@query("isotonic", f"""WITH {LI}, t AS (SELECT round(prediction, 4) AS x, avg(responder_6) AS y, count(*) AS n FROM li GROUP BY 1),
  m AS (SELECT a.x AS lo, b.x AS hi, sum(t.y * t.n) / sum(t.n) AS v FROM t a JOIN t b ON a.x <= b.x JOIN t ON t.x BETWEEN a.x AND b.x GROUP BY 1, 2),
  w AS (SELECT t.x, m.lo, min(m.v) AS v FROM t JOIN m ON m.lo <= t.x AND m.hi >= t.x GROUP BY 1, 2),
  f AS (SELECT x, max(v) AS v FROM w GROUP BY 1)
  SELECT {s6('f.x', 'prediction')}, max(t.n) AS n, {s6('max(f.v)', 'calibrated')} FROM f JOIN t USING (x) GROUP BY f.x""")
def isotonic(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem_panel(spark, folder).withColumn(S.PREDICTION, F.round(S.PREDICTION, 4))
    out = blend.isotonic(df, df, S.TARGET, S.PREDICTION)
    return out.groupBy(r6(S.PREDICTION).alias(S.PREDICTION)).agg(F.count("*").alias("n"), r6(F.avg("calibrated")).alias("calibrated"))


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """Two prediction columns: the tax and a scaled price."""
    price = (F.col("feature_00") / 50000 - 1) * 0.05
    return lineitem_panel(spark, folder).withColumns({"a": F.col(S.PREDICTION), "b": price})


MEMBERS = LI + ", mb AS (SELECT *, prediction AS a, (feature_00 / 50000 - 1) * 0.05 AS b FROM li)"


@query("weighted_blend", f"WITH {MEMBERS} SELECT date_id, {s6('sum(a * 0.7 + b * 0.3)', 'blend')} FROM mb GROUP BY 1")
def weighted_blend(spark: SparkSession, folder: str) -> DataFrame:
    df = blend.weighted_blend(_members(spark, folder), ["a", "b"], [0.7, 0.3])
    return df.groupBy(S.DATE).agg(r6(F.sum("blend")).alias("blend"))


def _search_sql(steps: int, rounds: int) -> str:
    """The same lattice search, written as one query per round."""
    parts = [MEMBERS + """, ds AS (SELECT date_id, sum(weight * pow(responder_6, 2)) AS yy, sum(weight * responder_6 * a) AS ya,
  sum(weight * responder_6 * b) AS yb, sum(weight * a * a) AS aa, sum(weight * a * b) AS ab, sum(weight * b * b) AS bb FROM mb GROUP BY 1)"""]
    parts.append(f"c0 AS (SELECT k / {float(steps)} AS w0, {steps} - k AS r, ({steps} - k) / {float(steps)} AS w1 FROM (SELECT unnest(range({steps + 1})) AS k))")
    pull = 0.5
    for i in range(rounds + 1):
        den = "sqrt(greatest(yy * (w0 * w0 * aa + 2 * w0 * w1 * ab + w1 * w1 * bb), 0))"
        parts.append(f"""s{i} AS (SELECT w0, w1, sum(CASE WHEN {den} >= 1e-10 THEN (w0 * ya + w1 * yb) / {den} END) AS score FROM ds, c{i} GROUP BY 1, 2),
  b{i} AS (SELECT w0, w1, score FROM s{i} ORDER BY score DESC, w0, w1 LIMIT 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS (SELECT w0, w1 FROM b{i} UNION SELECT b.w0 + {pull} * (c.w0 - b.w0), b.w1 + {pull} * (c.w1 - b.w1) FROM b{i} b, c0 c)""")
            pull /= 2.5
    return f"WITH {', '.join(parts)} SELECT {s6('w0', 'w0')}, {s6('w1', 'w1')}, {s6('score', 'score')} FROM b{rounds}"


@query("blend_weight_search", _search_sql(10, 2))
def blend_weight_search(spark: SparkSession, folder: str) -> DataFrame:
    df = _members(spark, folder)
    best = blend.blend_weight_search(df, ["a", "b"], steps=10, rounds=2)
    scored = blend.score_blends(blend.blend_sums(df, ["a", "b"]), [best])
    return rounded(scored, "w0", "w1", "score")


@query("rank_average", f"""WITH {MEMBERS}, r AS (SELECT date_id,
  (rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0) / count(*) OVER () AS pa,
  (rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0) / count(*) OVER () AS pb FROM mb)
  SELECT date_id, count(*) AS n, {s6('avg((pa + pb) / 2)', 'blend')} FROM r GROUP BY 1""")
def rank_average(spark: SparkSession, folder: str) -> DataFrame:
    df = blend.rank_average(_members(spark, folder), ["a", "b"])
    return df.groupBy(S.DATE).agg(F.count("*").alias("n"), r6(F.avg("blend")).alias("blend"))


# Least squares on two centred columns, solved in closed form.
_STACK = f"""WITH {MEMBERS}, mu AS (SELECT sum(weight) AS w, sum(weight * a) / sum(weight) AS a, sum(weight * b) / sum(weight) AS b,
  sum(weight * responder_6) / sum(weight) AS y FROM mb),
  g AS (SELECT sum(m.weight * pow(m.a - mu.a, 2)) AS aa, sum(m.weight * (m.a - mu.a) * (m.b - mu.b)) AS ab, sum(m.weight * pow(m.b - mu.b, 2)) AS bb,
  sum(m.weight * (m.a - mu.a) * (m.responder_6 - mu.y)) AS ya, sum(m.weight * (m.b - mu.b) * (m.responder_6 - mu.y)) AS yb FROM mb m, mu),
  c AS (SELECT (ya * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS cb FROM g)
  SELECT date_id, count(*) AS n, {s6('avg(mu.y + ca * (m.a - mu.a) + cb * (m.b - mu.b))', 'prediction')} FROM mb m, mu, c GROUP BY 1"""


@query("stacking", _STACK)
def stacking(spark: SparkSession, folder: str) -> DataFrame:
    """A linear meta-model on the two members."""
    df = _members(spark, folder).drop(S.PREDICTION)
    model = models.stacking(df, ["a", "b"])
    return model.predict(df).groupBy(S.DATE).agg(F.count("*").alias("n"), r6(F.avg(S.PREDICTION)).alias(S.PREDICTION))


# Models


def _ridge_sql(alphas: list[float], tail: str) -> str:
    """Closed form of the two-column weighted ridge after median fill and standardisation."""
    return f"""WITH {LI}, {_SPLIT}, md AS (SELECT median(feature_00) AS m0, median(feature_01) AS m1 FROM tr),
  st AS (SELECT avg(feature_00) AS u0, stddev_pop(feature_00) AS s0, avg(coalesce(feature_01, m1)) AS u1, stddev_pop(coalesce(feature_01, m1)) AS s1 FROM tr, md),
  x AS (SELECT (coalesce(feature_00, m0) - u0) / s0 AS a, (coalesce(feature_01, m1) - u1) / s1 AS b, responder_6 AS y, weight AS w FROM tr, md, st),
  mu AS (SELECT sum(w * a) / sum(w) AS a, sum(w * b) / sum(w) AS b, sum(w * y) / sum(w) AS y FROM x),
  g AS (SELECT sum(x.w * pow(x.a - mu.a, 2)) AS aa, sum(x.w * (x.a - mu.a) * (x.b - mu.b)) AS ab, sum(x.w * pow(x.b - mu.b, 2)) AS bb,
  sum(x.w * (x.a - mu.a) * (x.y - mu.y)) AS ya, sum(x.w * (x.b - mu.b) * (x.y - mu.y)) AS yb FROM x, mu),
  al AS (SELECT unnest({alphas}) AS alpha),
  c AS (SELECT alpha, (ya * (bb + alpha) - yb * ab) / ((aa + alpha) * (bb + alpha) - ab * ab) AS ca,
  (yb * (aa + alpha) - ya * ab) / ((aa + alpha) * (bb + alpha) - ab * ab) AS cb FROM g, al),
  p AS (SELECT alpha, va.symbol_id, va.responder_6, va.weight, mu.y + ca * ((coalesce(feature_00, m0) - u0) / s0 - mu.a)
  + cb * ((coalesce(feature_01, m1) - u1) / s1 - mu.b) AS prediction FROM va, md, st, mu, c) {tail}"""


@query("ridge", _ridge_sql([500.0], f"SELECT symbol_id, count(*) AS n, {s6('avg(prediction)', 'prediction')} FROM p GROUP BY 1"))
def ridge(spark: SparkSession, folder: str) -> DataFrame:
    train, val = _parts(_panel(spark, folder))
    model = models.ridge_grid(train, ["feature_00", "feature_01"], [500.0])[0]
    return _per_symbol(model.predict(val))


_ALPHAS = [100.0, 1000.0, 10000.0, 100000.0]


@query("ridge_alpha_grid", _ridge_sql(_ALPHAS, f"""SELECT CAST(alpha AS DOUBLE) AS alpha,
  {s6('1 - sum(weight * pow(responder_6 - prediction, 2)) / sum(weight * pow(responder_6, 2))', 'val_r2')} FROM p GROUP BY 1"""))
def ridge_alpha_grid(spark: SparkSession, folder: str) -> DataFrame:
    train, val = _parts(_panel(spark, folder))
    _, records = models.ridge_alpha_grid(train, val, ["feature_00", "feature_01"], _ALPHAS)
    return rounded(models.records_table(train, records), "val_r2")


def _cv(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, models.CrossValidation]:
    df = _panel(spark, folder)
    folds = splits.purged_kfold(df, 3, 5, 10, min_train_dates=100)
    return df, models.cv_train(df, folds, FEATURES, SMALL, keys=KEYS, **options)


@query("cv_train")
def cv_train(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics per purged fold with early stopping."""
    return _cv(spark, folder)[1].fold_metrics


@query("oof_predictions")
def oof_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _cv(spark, folder, kind="forest", early_stop=False)[1].oof


@query("fold_average")
def fold_average(spark: SparkSession, folder: str) -> DataFrame:
    df, cv = _cv(spark, folder, kind="linear", early_stop=False)
    return models.fold_average(cv.models, df).select(*KEYS, S.PREDICTION)


@query("mean_importance")
def mean_importance(spark: SparkSession, folder: str) -> DataFrame:
    return _cv(spark, folder)[1].importance


@query("gbt_holdout")
def gbt_holdout(spark: SparkSession, folder: str) -> DataFrame:
    """Plain and with z-scores of the snapshot, train rows sampled within dates."""
    train, val = _parts(_panel(spark, folder))
    records = []
    for name, zscore in (("plain", []), ("zscore", ["feature_00"])):
        done = models.gbt_holdout(train, val, FEATURES, SMALL, train_fraction=0.5, key="l_orderkey", zscore=zscore)
        records.append({"features": name, **done.record})
    return models.records_table(train, records)


@query("gbt_holdout_early_stop")
def gbt_holdout_early_stop(spark: SparkSession, folder: str) -> DataFrame:
    train, val = _parts(_panel(spark, folder))
    done = models.gbt_holdout(train, val, FEATURES, SMALL, early_stop=True, rounds=8)
    return models.records_table(train, [done.record])


@query("grid_search")
def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    """Three small stages; each goes on from the best of the one before."""
    train, val = _parts(_panel(spark, folder))
    base = {**SMALL, "n_estimators": 2}
    grids = [{"num_leaves": [3, 31], "max_depth": [2]}, {"bagging_fraction": [0.8, 1.0]}, {"learning_rate": [0.1, 0.3]}]
    medians = models.known_medians(train, FEATURES)
    _, records = models.grid_search(lambda p: models.gbt_holdout(train, val, FEATURES, p, medians=medians).record, base, grids)
    return models.records_table(train, records)


@query("random_search")
def random_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ranges of every set-up, with all their trials and rounds, over the folds of one table."""
    df = _panel(spark, folder)
    folds = checkpointed(splits.purged_kfold(df, 3, 5, 10, min_train_dates=100))
    numbers, score = models.fold_numbers(folds), models.fold_score(df, folds, FEATURES)
    records = []
    for name, space in models.SPACES.items():
        search = models.RandomSearch(space, fixed={"n_estimators": models.SEARCH_ROUNDS, "random_state": 42})
        search.run(numbers, score, df)
        records += [{"model": name, **r} for r in search.records]
    return models.records_table(df, records)


@query("backtest_records")
def backtest_records(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted trees of full size and ridge, validated on every partition after the first."""
    df = spark.read.parquet(stored_panel(spark, folder)).drop(S.PREDICTION)
    trees = models.partition_backtest(df, None, None, FEATURES, models.FINAL_PARAMS, reference_rows=10_000)
    linear = models.ridge_backtest(df, None, None, ["feature_00", "feature_01"], 500.0, 10_000)
    return models.records_table(df, [{"model": "trees", **r} for r in trees] + [{"model": "ridge", **r} for r in linear])


@query("final_fit_importance")
def final_fit_importance(spark: SparkSession, folder: str) -> DataFrame:
    from tickloom.functions.scalar import with_time_decay

    train = with_time_decay(_parts(_panel(spark, folder))[0])
    model = models.fit(train, FEATURES, SMALL, weight="decayed_weight")
    return metrics.top_features(models.importance_table(train, [model]), 20)


@query("onehot_symbol", f"""WITH {LI}, k AS (SELECT symbol_id, dense_rank() OVER (ORDER BY count(*) DESC, CAST(symbol_id AS VARCHAR)) - 1 AS level
  FROM li GROUP BY symbol_id) SELECT symbol_id, CAST(level AS INTEGER) AS level, (SELECT count(*) FROM k) AS width FROM k""")
def onehot_symbol(spark: SparkSession, folder: str) -> DataFrame:
    """Position of the one in the symbol's vector."""
    from pyspark.ml.functions import vector_to_array

    df = lineitem_panel(spark, folder)
    coded = models.onehot_symbol(df).transform(df.select(S.SYMBOL).distinct())
    array = vector_to_array("symbol_vector")
    return coded.select(
        S.SYMBOL,
        (F.array_position(array, F.lit(1.0)) - 1).cast("int").alias("level"),
        F.size(array).cast("bigint").alias("width"),
    )
