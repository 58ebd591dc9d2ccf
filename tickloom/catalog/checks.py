"""Time splits and data-quality checks (SPL, ST4, DQ)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import (
    EV, LI, ORDER, W_E, events_panel, lineitem_panel, query, r6, rounded, s6, stored_panel,
)
from tickloom.catalog.tables import _ROLES
from tickloom.operators import profile, quality, splits
from tickloom.operators import windows as win

_BOTH_SIDES = """t AS (SELECT ntile(5) OVER (ORDER BY date_id) - 1 AS fold_idx, date_id FROM (SELECT DISTINCT date_id FROM ev)),
  b AS (SELECT fold_idx, min(date_id) AS lo, max(date_id) AS hi FROM t GROUP BY fold_idx),
  c AS (SELECT b.fold_idx, d.date_id FROM b, (SELECT DISTINCT date_id FROM ev) d WHERE d.date_id < lo - 2 OR d.date_id > hi + 3)
  SELECT CAST(fold_idx AS INTEGER) AS fold_idx, date_id, 'train' AS role FROM c
  UNION ALL SELECT CAST(fold_idx AS INTEGER), date_id, 'val' FROM t"""
_PURGED = """t AS (SELECT ntile(5) OVER (ORDER BY date_id) - 1 AS fold_idx, date_id FROM (SELECT DISTINCT date_id FROM ev)),
  b AS (SELECT fold_idx, min(date_id) AS lo, max(date_id) AS hi FROM t GROUP BY fold_idx),
  c AS (SELECT b.fold_idx, d.date_id FROM b, (SELECT DISTINCT date_id FROM ev) d WHERE d.date_id < lo - 2),
  ok AS (SELECT fold_idx FROM c GROUP BY fold_idx HAVING count(*) >= 5),
  folds AS (SELECT CAST(fold_idx AS INTEGER) AS fold_idx, date_id, 'train' AS role FROM c JOIN ok USING (fold_idx)
  UNION ALL SELECT CAST(fold_idx AS INTEGER), date_id, 'val' FROM t JOIN ok USING (fold_idx))"""


def _folds(spark: SparkSession, folder: str) -> DataFrame:
    return splits.purged_kfold(events_panel(spark, folder), 5, 2, 3, min_train_dates=5)


@query("purged_kfold", f"WITH {EV}, {_PURGED} SELECT fold_idx, date_id, role FROM folds")
def purged_kfold(spark: SparkSession, folder: str) -> DataFrame:
    return _folds(spark, folder)


@query("purged_kfold_both_sides", f"WITH {EV}, {_BOTH_SIDES}")
def purged_kfold_both_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Training dates before and after the test window."""
    return splits.purged_kfold(events_panel(spark, folder), 5, 2, 3, forward_only=False, min_train_dates=5)


@query("walk_forward", f"""WITH {LI}, d AS (SELECT date_id, row_number() OVER (ORDER BY date_id) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT date_id FROM li)), f AS (SELECT CAST(k AS INTEGER) AS fold_idx, date_id,
  CASE WHEN pos < 500 + k * 300 - 5 THEN 'train' WHEN pos >= 500 + k * 300 AND pos < 500 + k * 300 + 200 THEN 'val' END AS role
  FROM d, (SELECT unnest(range(50)) AS k) WHERE 500 + k * 300 + 200 <= n) SELECT * FROM f WHERE role IS NOT NULL""")
def walk_forward(spark: SparkSession, folder: str) -> DataFrame:
    return splits.walk_forward(lineitem_panel(spark, folder), 500, 200, 300, 5)


@query("holdout_split", f"WITH {EV}, {_ROLES.format(t='ev')} SELECT 0 AS fold_idx, date_id, role FROM h WHERE role IS NOT NULL")
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.holdout_split(events_panel(spark, folder))


@query("expanding_partitions", f"""WITH {LI}, p AS (SELECT CAST(floor(date_id / 250.0) AS INTEGER) AS partition_id, weight FROM li)
  SELECT CAST(v AS INTEGER) AS val_partition, count_if(partition_id < v) AS train_rows, count_if(partition_id = v) AS val_rows
  FROM p, (SELECT unnest(range(1, 10)) AS v) WHERE partition_id <= v GROUP BY v""")
def expanding_partitions(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.read.parquet(stored_panel(spark, folder))
    out = None
    for v, train, val in splits.expanding_partitions(df, 1, 9):
        rows = train.select(F.lit(1).alias("t")).unionByName(val.select(F.lit(0).alias("t")))
        row = rows.agg(
            F.lit(v).alias("val_partition"),
            F.count_if(F.col("t") == 1).alias("train_rows"),
            F.count_if(F.col("t") == 0).alias("val_rows"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("sliding_retrain", f"""WITH {LI}, e AS (SELECT max(date_id) AS last FROM li),
  w AS (SELECT CAST(1000 + 350 * k AS INTEGER) AS first_date FROM (SELECT unnest(range(100)) AS k), e WHERE 1000 + 350 * k <= last),
  m AS (SELECT first_date, sum(weight * responder_6) / sum(weight) AS mu FROM w JOIN li ON date_id BETWEEN first_date - 1000 AND first_date - 1 GROUP BY 1)
  SELECT first_date, count(*) AS n_rows, {s6('max(mu)', 'mean_prediction')} FROM m JOIN li ON date_id BETWEEN first_date AND first_date + 349 GROUP BY 1""")
def sliding_retrain(spark: SparkSession, folder: str) -> DataFrame:
    """A mean refitted every 350 days on the 1000 days before, through the date-range scan."""
    from tickloom.operators import baselines
    from tickloom.sources import scan

    path, out = stored_panel(spark, folder), None
    last = spark.read.parquet(path).agg(F.max(S.DATE)).first()[0]
    for lo, hi, end in splits.sliding_windows(0, last, 350, 1000):
        train, rows = scan.scan_date_range(spark, path, (lo, hi)), scan.scan_date_range(spark, path, (hi + 1, end))
        scored = baselines.weighted_mean_baseline(train, rows)
        part = scored.agg(
            F.lit(hi + 1).alias("first_date"), F.count("*").alias("n_rows"), r6(F.max(S.PREDICTION)).alias("mean_prediction")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("fold_overlap", f"""WITH {EV}, {_PURGED} SELECT count(*) AS n_overlap FROM (SELECT fold_idx, date_id FROM folds WHERE role = 'train'
  INTERSECT SELECT fold_idx, date_id FROM folds WHERE role = 'val')""")
def fold_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return splits.fold_overlap(_folds(spark, folder)).agg(F.count("*").alias("n_overlap"))


# Checks

_FEATURES = ["feature_00", "feature_01", "feature_02", "feature_03"]


def _sparse_panel(spark: SparkSession, folder: str) -> DataFrame:
    """events with columns that miss 40% and 90% of their values."""
    v = F.col("feature_00")
    e = F.col("event_id")
    return events_panel(spark, folder).withColumns(
        {"feature_02": F.when(e % 10 >= 4, v), "feature_03": F.when(e % 10 >= 9, v)}
    )


SPARSE = EV + """, sp AS (SELECT *, CASE WHEN event_id % 10 >= 4 THEN feature_00 END AS feature_02,
  CASE WHEN event_id % 10 >= 9 THEN feature_00 END AS feature_03 FROM ev)"""


def _report(check: str, column: str, error: str, warning: str, value: str, threshold: str) -> str:
    return f"""SELECT '{check}' AS "check", {column} AS "column", CASE WHEN {error} THEN 'error' WHEN {warning} THEN 'warning' ELSE 'ok' END AS severity,
  {s6(value, 'value')}, CAST({threshold} AS DOUBLE) AS threshold FROM sp"""


def _missing(c: str) -> str:
    rate = f"1 - count({c}) / CAST(count(*) AS DOUBLE)"
    return _report("missing_rate", f"'{c}'", f"{rate} >= 0.8", f"{rate} >= 0.3", rate, f"CASE WHEN {rate} >= 0.8 THEN 0.8 ELSE 0.3 END")


_NOT_EMPTY = _report("not_empty", "CAST(NULL AS VARCHAR)", "count(*) = 0", "false", "count(*)", "1")
_MISSING_SQL = " UNION ALL ".join([_NOT_EMPTY, *[_missing(c) for c in _FEATURES]])
_WEIGHT_SQL = " UNION ALL ".join([
    _report("weight_negative", "'weight'", "count_if(weight < 0) > 0", "false", "count_if(weight < 0)", "0"),
    _report("weight_sum", "'weight'", "sum(weight) = 0", "false", "sum(weight)", "0"),
    _report("weight_null", "'weight'", "false", "sum(weight) <> 0 AND count_if(weight IS NULL) > 0", "count_if(weight IS NULL)", "0"),
])
_TARGET_SQL = " UNION ALL ".join([
    _report("target_known", "'responder_6'", "count(responder_6) = 0", "false", "count(responder_6)", "1"),
    _report("target_spread", "'responder_6'", "stddev_samp(responder_6) IS NULL OR stddev_samp(responder_6) = 0", "false", "stddev_samp(responder_6)", "0"),
    _report("target_mean", "'responder_6'", "false", "abs(avg(responder_6)) > 1", "avg(responder_6)", "1"),
])
_REQUIRED = ["date_id", "time_id", "symbol_id", "weight", "responder_6"]
_REQUIRED_SQL = " UNION ALL ".join(
    f"""SELECT 'required_columns' AS "check", '{c}' AS "column", 'ok' AS severity, CAST(1 AS DOUBLE) AS value, CAST(1 AS DOUBLE) AS threshold""" for c in _REQUIRED)
_MONOTONIC_SQL = """SELECT 'date_monotonic' AS "check", 'date_id' AS "column", 'ok' AS severity, CAST(0 AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold"""


@query("required_columns", f"""SELECT 'required_columns' AS "check", 'ts' AS "column", 'ok' AS severity, 1.0::DOUBLE AS value, 1.0::DOUBLE AS threshold
  UNION ALL SELECT 'required_columns', 'weight', 'error', 0.0, 1.0""")
def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    return quality.required_columns(spark, spark.read.parquet(f"{folder}/events.parquet").columns, ["ts", "weight"])


@query("date_monotonic", f"""WITH d AS (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS date_id,
  lag(CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER)) OVER (ORDER BY event_id) AS prev FROM events)
  SELECT 'date_monotonic' AS "check", 'date_id' AS "column", CASE WHEN count_if(date_id < prev) > 0 THEN 'error' ELSE 'ok' END AS severity,
  CAST(count_if(date_id < prev) AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold FROM d""")
def date_monotonic(spark: SparkSession, folder: str) -> DataFrame:
    """The events file is stored in event order."""
    df = spark.read.parquet(f"{folder}/events.parquet")
    return quality.date_monotonic(df.withColumn(S.DATE, F.datediff("ts", F.lit("2024-01-01").cast("date"))))


@query("missing_thresholds", f"WITH {SPARSE} {_MISSING_SQL}")
def missing_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.missing_thresholds(_sparse_panel(spark, folder), _FEATURES), "value")


@query("weight_checks", f"WITH {SPARSE} {_WEIGHT_SQL}")
def weight_checks(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.weight_checks(_sparse_panel(spark, folder)), "value")


@query("target_checks", f"WITH {SPARSE} {_TARGET_SQL}")
def target_checks(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.target_checks(_sparse_panel(spark, folder)), "value")


@query("validate_panel", f"WITH {SPARSE} " + " UNION ALL ".join([_REQUIRED_SQL, _MISSING_SQL, _WEIGHT_SQL, _TARGET_SQL, _MONOTONIC_SQL]))
def validate_panel(spark: SparkSession, folder: str) -> DataFrame:
    df = _sparse_panel(spark, folder)
    return rounded(quality.validate_panel(df, _FEATURES), "value")


@query("no_future_leakage", f"""WITH {EV}, {_ROLES.format(t='ev')} SELECT CAST(max(date_id) FILTER (WHERE role = 'train') AS INTEGER) AS last_train,
  CAST(min(date_id) FILTER (WHERE role = 'val') AS INTEGER) AS first_val, 'ok' AS severity FROM h""")
def no_future_leakage(spark: SparkSession, folder: str) -> DataFrame:
    folds = splits.holdout_split(events_panel(spark, folder))
    return quality.no_future_leakage(folds.where("role = 'train'"), folds.where("role = 'val'"))


@query("lag_leakage_corr", f"""WITH {EV}, l AS (SELECT responder_6 AS y, lag(responder_6) OVER ({W_E}) AS x FROM ev)
  SELECT {s6('corr(y, x)', 'corr')}, abs(corr(y, x)) > 0.99 AS warning FROM l""")
def lag_leakage_corr(spark: SparkSession, folder: str) -> DataFrame:
    df = win.lag_features(events_panel(spark, folder), [S.TARGET], [1], order=ORDER)
    return rounded(profile.lag_leakage_corr(df, S.TARGET, f"{S.TARGET}_lag1"), "corr")
