"""Scans, sinks, projections and joins (SC, SK, PF, MA, JN, ST)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import (
    EV, GRID, LI, events_panel, grid_panel, lag_table, lineitem_panel, query, r6, rounded, s6,
    stored_panel,
)
from tickloom.functions import scalar
from tickloom.operators import cross, joins, metrics, splits
from tickloom.session import scratch_path
from tickloom.sources import generate, scan, sinks

ROW = [S.DATE, S.TIME, S.SYMBOL, "l_orderkey", "l_partkey", "feature_00"]
ROW_SQL = "date_id, time_id, symbol_id, l_orderkey, l_partkey, feature_00"


@query("scan_panel", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def scan_panel(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return scan.scan_panel(spark, f"{folder}/lineitem.parquet", columns)


@query("scan_date_range", f"WITH {LI} SELECT {ROW_SQL} FROM li WHERE date_id BETWEEN 400 AND 1500")
def scan_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return scan.scan_date_range(spark, stored_panel(spark, folder), (400, 1500), ROW)


@query("scan_lag", f"""WITH {GRID} SELECT date_id + 1 AS date_id, time_id, symbol_id,
  {s6('responder_6', 'responder_6_lag_1')} FROM grid WHERE date_id + 1 BETWEEN 5 AND 20""")
def scan_lag(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lag")
    sinks.write_parquet(lag_table(grid_panel(spark, folder)), path, [S.DATE])
    return rounded(scan.scan_lag(spark, path, (5, 20)), "responder_6_lag_1")


@query("scan_test", f"""WITH {GRID} SELECT row_id, date_id, time_id, symbol_id, weight, time_id >= 12 AS is_scored,
  {s6('feature_00', 'feature_00')} FROM grid""")
def scan_test(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "test")
    rows = grid_panel(spark, folder).withColumn("is_scored", F.col(S.TIME) >= 12)
    sinks.write_parquet(rows, path, [S.DATE])
    df = scan.scan_test(spark, path)
    return rounded(df.select(S.ROW_ID, *S.KEYS, S.WEIGHT, "is_scored", "feature_00"), "feature_00")


@query("scan_generic", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_generic(spark: SparkSession, folder: str) -> DataFrame:
    df = scan.scan_generic(spark, f"{folder}/orders.parquet", mergeSchema="true")
    return df.select("o_orderkey", "o_custkey", "o_totalprice")


@query("scan_partitions", f"""WITH {LI}, p AS (SELECT *, CAST(floor(date_id / 250.0) AS INTEGER) AS partition_id,
  concat_ws('-', l_orderkey, time_id, l_partkey, symbol_id, CAST(round(feature_00 * 100) AS BIGINT)) AS row_id FROM li
  WHERE floor(date_id / 250.0) IN (1, 3, 4)), n AS (SELECT *, row_number() OVER (PARTITION BY partition_id, date_id
  ORDER BY substr(md5('42:' || row_id), 1, 8), row_id) AS k,
  count(*) OVER (PARTITION BY partition_id, date_id) AS size FROM p)
  SELECT partition_id, date_id, row_id FROM n WHERE k <= greatest(1, floor(size * 0.25))""")
def scan_partitions(spark: SparkSession, folder: str) -> DataFrame:
    df = scan.scan_partitions(spark, stored_panel(spark, folder), [1, 3, 4], 0.25)
    return df.select("partition_id", S.DATE, S.ROW_ID)


_TAGS = [f"tag_{i}" for i in range(17)]


@query("scan_csv_meta", "SELECT 'feature_' || CAST(p_partkey AS VARCHAR) AS feature, "
       + ", ".join(f"(p_partkey * 7919 + p_size) // {2 ** i} % 2 = 1 AS {t}" for i, t in enumerate(_TAGS)) + " FROM part")
def scan_csv_meta(spark: SparkSession, folder: str) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet")
    bits = F.col("p_partkey") * 7919 + F.col("p_size")
    tags = [(F.floor(bits / F.lit(2**i)) % 2 == 1).alias(t) for i, t in enumerate(_TAGS)]
    path = scratch_path(spark, "tags")
    named = F.concat(F.lit("feature_"), F.col("p_partkey").cast("string")).alias("feature")
    part.select(named, *tags).write.option("header", True).csv(path)
    return scan.scan_csv_meta(spark, path, S.FEATURE_TAGS_SCHEMA)


@query("generate_panel", f"""WITH {EV}, k AS (SELECT max(date_id) + 1 AS d, count(DISTINCT symbol_id) AS s FROM ev)
  SELECT CAST(i AS INTEGER) AS date_id, 6 * s AS n_rows, s AS n_symbols, 6 AS n_times,
  CASE WHEN i = 0 THEN s ELSE 0 END AS first_step_missing, true AS weights_positive
  FROM (SELECT unnest(range(d)) AS i, s FROM k)""")
def generate_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Panel of the size of the events table: its days and users, six steps a day."""
    size = events_panel(spark, folder).agg(F.max(S.DATE).alias("d"), F.countDistinct(S.SYMBOL).alias("s")).first()
    df = generate.generate_panel(spark, size["d"] + 1, 6, size["s"], features=4)
    return df.groupBy(S.DATE).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(S.SYMBOL).alias("n_symbols"),
        F.countDistinct(S.TIME).cast("int").alias("n_times"),
        F.count_if(F.col("responder_6_lag_1").isNull()).alias("first_step_missing"),
        F.every(F.col(S.WEIGHT) > 0).alias("weights_positive"),
    )


@query("write_parquet", f"WITH {LI} SELECT {ROW_SQL} FROM li")
def write_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "table")
    sinks.write_parquet(lineitem_panel(spark, folder).select(*ROW), path, [S.SYMBOL], [S.DATE, S.TIME])
    return spark.read.parquet(path).select(*ROW).withColumn(S.SYMBOL, F.col(S.SYMBOL).cast("bigint"))


@query("write_metrics", f"WITH {LI} SELECT {s6('sqrt(sum(weight * pow(responder_6 - prediction, 2)) / sum(weight))', 'weighted_rmse')}, "
       + s6("sum(weight * abs(responder_6 - prediction)) / sum(weight)", "weighted_mae") + " FROM li")
def write_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    sums = metrics.date_sums(lineitem_panel(spark, folder))
    sinks.write_metrics(metrics.all_metrics(sums), path)
    stored = spark.read.schema("weighted_rmse double, weighted_mae double").json(path)
    return rounded(stored, "weighted_rmse", "weighted_mae")


@query("write_submission", f"WITH {GRID} SELECT row_id, {s6('greatest(-5.0, least(5.0, responder_6))', 'responder_6')} FROM grid")
def write_submission(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "submission")
    predicted = grid_panel(spark, folder).withColumn(S.PREDICTION, scalar.clipped(F.col(S.TARGET)))
    sinks.write_submission(predicted, path)
    return rounded(scan.scan_csv_meta(spark, path, S.SUBMISSION_SCHEMA), S.TARGET)


# Projections and scalar functions


@query("drop_leaky_columns", "SELECT event_id, user_id, value AS responder_6 FROM events")
def drop_leaky_columns(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("value")
    df = spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", "user_id", *[(v * (i + 1)).alias(c) for i, c in enumerate(S.LEAKY)], v.alias(S.TARGET)
    )
    return scalar.drop_leaky_columns(df)


@query("between_filter", f"WITH {EV} SELECT event_id, date_id FROM ev WHERE date_id BETWEEN 7 AND 21")
def between_filter(spark: SparkSession, folder: str) -> DataFrame:
    return scalar.between_filter(events_panel(spark, folder), S.DATE, 7, 21).select("event_id", S.DATE)


@query("not_null_target", f"WITH {EV} SELECT event_id, feature_01 FROM ev WHERE feature_01 IS NOT NULL")
def not_null_target(spark: SparkSession, folder: str) -> DataFrame:
    return scalar.not_null_target(events_panel(spark, folder), "feature_01").select("event_id", "feature_01")


@query("prepare_xywd", f"""WITH {EV} SELECT event_id, CAST(feature_00 AS FLOAT) AS feature_00,
  CAST(feature_01 AS FLOAT) AS feature_01, CAST(responder_6 AS FLOAT) AS responder_6,
  CAST(coalesce(CASE WHEN weight > 1 THEN weight END, 0) AS FLOAT) AS weight, date_id FROM ev""")
def prepare_xywd(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder).withColumn(S.WEIGHT, F.when(F.col(S.WEIGHT) > 1, F.col(S.WEIGHT)))
    return scalar.prepare_xywd(df, ["feature_00", "feature_01"], keep=["event_id"])


@query("prepare_with_zscore", f"""WITH {EV}, z AS (SELECT *, avg(feature_00) OVER w AS m, stddev_samp(feature_00) OVER w AS s
  FROM ev WINDOW w AS (PARTITION BY date_id, time_id))
  SELECT event_id, CAST(feature_00 AS FLOAT) AS feature_00,
  round(CAST(CAST(CASE WHEN s IS NOT NULL AND s > 0 THEN (feature_00 - m) / s ELSE 0 END AS FLOAT) AS DOUBLE), 4) + 0.0 AS feature_00_cs_zscore,
  CAST(responder_6 AS FLOAT) AS responder_6, CAST(weight AS FLOAT) AS weight, date_id FROM z""")
def prepare_with_zscore(spark: SparkSession, folder: str) -> DataFrame:
    df = scalar.not_null_target(events_panel(spark, folder))
    scored = cross.cs_zscore_safe(df, ["feature_00"])
    out = scalar.prepare_xywd(scored, ["feature_00", "feature_00_cs_zscore"], keep=["event_id"])
    z = F.round(F.col("feature_00_cs_zscore").cast("double"), 4) + F.lit(0.0)
    return out.withColumn("feature_00_cs_zscore", z)


@query("ensure_columns", f"WITH {EV} SELECT event_id, feature_00, feature_01, CAST(NULL AS DOUBLE) AS feature_02 FROM ev")
def ensure_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder).select("event_id", "feature_00", "feature_01")
    return scalar.ensure_columns(df, S.FEATURES[:3])


@query("project_features", f"WITH {EV} SELECT feature_01, feature_00, responder_6, weight FROM ev")
def project_features(spark: SparkSession, folder: str) -> DataFrame:
    return scalar.project_features(events_panel(spark, folder), ["feature_01", "feature_00"])


@query("rename_columns", f"WITH {LI} SELECT date_id, symbol_id, responder_6 AS y_true, prediction AS y_pred, weight FROM li")
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem_panel(spark, folder).select(S.DATE, S.SYMBOL, S.TARGET, S.PREDICTION, S.WEIGHT)
    return scalar.rename_columns(df, {S.TARGET: "y_true", S.PREDICTION: "y_pred"})


@query("clip_prediction", f"""WITH {EV} SELECT event_id,
  CASE WHEN feature_01 IS NOT NULL THEN greatest(-5.0, least(5.0, feature_01)) END AS prediction FROM ev""")
def clip_prediction(spark: SparkSession, folder: str) -> DataFrame:
    return events_panel(spark, folder).select("event_id", scalar.clipped(F.col("feature_01")).alias(S.PREDICTION))


@query("error_columns", f"""WITH {LI} SELECT symbol_id, {s6('sum(pow(responder_6 - prediction, 2))', 'squared_error')},
  {s6('sum(abs(responder_6 - prediction))', 'absolute_error')} FROM li GROUP BY symbol_id""")
def error_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = scalar.error_columns(lineitem_panel(spark, folder), S.TARGET, S.PREDICTION)
    return df.groupBy(S.SYMBOL).agg(
        r6(F.sum("squared_error")).alias("squared_error"), r6(F.sum("absolute_error")).alias("absolute_error")
    )


@query("conditional_zscore", f"""WITH {EV}, z AS (SELECT *, avg(feature_01) OVER w AS m, stddev_samp(feature_01) OVER w AS s
  FROM ev WINDOW w AS (PARTITION BY symbol_id, date_id)) SELECT event_id,
  {s6('CASE WHEN s IS NOT NULL AND s > 0 THEN (feature_01 - m) / s ELSE 0 END', 'z')} FROM z""")
def conditional_zscore(spark: SparkSession, folder: str) -> DataFrame:
    df = cross.with_group_moments(events_panel(spark, folder), ["feature_01"], [S.SYMBOL, S.DATE])
    z = scalar.conditional_zscore(F.col("feature_01"), F.col("feature_01_mean"), F.col("feature_01_std"))
    return df.select("event_id", r6(z).alias("z"))


@query("time_decay_weight", f"""WITH {EV}, b AS (SELECT min(date_id) AS lo, max(date_id) AS hi FROM ev)
  SELECT event_id, {s6('weight * (0.5 + (date_id - lo) / CAST(hi - lo AS DOUBLE) * 1.0)', 'decayed_weight')} FROM ev, b""")
def time_decay_weight(spark: SparkSession, folder: str) -> DataFrame:
    df = scalar.with_time_decay(events_panel(spark, folder))
    return df.select("event_id", r6("decayed_weight").alias("decayed_weight"))


@query("ewm_sample_weight", f"""WITH {EV} SELECT event_id,
  {s6('pow(0.98, (SELECT max(date_id) FROM ev) - date_id)', 'sample_weight')} FROM ev""")
def ewm_sample_weight(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder)
    last = df.agg(F.max(S.DATE)).scalar()
    return df.select("event_id", r6(scalar.ewm_sample_weight(F.col(S.DATE), last, 0.98)).alias("sample_weight"))


@query("dynamic_min_leaf", f"""WITH {LI} SELECT CAST(floor(date_id / 250.0) AS INTEGER) AS partition_id, count(*) AS n,
  CAST(greatest(100, round_even(800 * sqrt(count(*) / 5000.0), 0)) AS BIGINT) AS min_leaf FROM li GROUP BY 1""")
def dynamic_min_leaf(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf size per partition from its row count."""
    df = spark.read.parquet(stored_panel(spark, folder)).groupBy("partition_id").agg(F.count("*").alias("n"))
    # One row per partition directory.
    sizes = [(r["partition_id"], r["n"], scalar.dynamic_min_leaf(r["n"], 5000)) for r in df.collect()]
    return spark.createDataFrame(sizes, "partition_id int, n bigint, min_leaf bigint")


@query("scaled_alpha", f"""WITH {LI}, n AS (SELECT CAST(floor(date_id / 250.0) AS INTEGER) AS partition_id, count(*) AS rows FROM li GROUP BY 1)
  SELECT a.partition_id, {s6('5000000.0 * sum(b.rows) / max(r.rows)', 'alpha')} FROM n a JOIN n b ON b.partition_id < a.partition_id,
  (SELECT rows FROM n ORDER BY partition_id DESC LIMIT 1) r GROUP BY a.partition_id""")
def scaled_alpha(spark: SparkSession, folder: str) -> DataFrame:
    """Penalty per expanding training set, relative to the rows of the last partition."""
    df = spark.read.parquet(stored_panel(spark, folder)).groupBy("partition_id").agg(F.count("*").alias("n"))
    counts = {r["partition_id"]: r["n"] for r in df.collect()}
    last = counts[max(counts)]
    rows = [
        (p, scalar.scaled_alpha(5_000_000.0, sum(counts[q] for q in counts if q < p), last))
        for p in sorted(counts)
        if p > min(counts)
    ]
    return rounded(spark.createDataFrame(rows, "partition_id int, alpha double"), "alpha")


# Joins


@query("join_lag", f"""WITH {GRID} SELECT g.date_id, g.time_id, g.symbol_id, {s6('g.responder_6', 'responder_6')},
  {s6('l.responder_6', 'responder_6_lag_1')} FROM grid g LEFT JOIN grid l
  ON l.date_id + 1 = g.date_id AND l.time_id = g.time_id AND l.symbol_id = g.symbol_id""")
def join_lag(spark: SparkSession, folder: str) -> DataFrame:
    grid = grid_panel(spark, folder).select(*S.KEYS, S.TARGET)
    return rounded(joins.join_lag(grid, lag_table(grid)), S.TARGET, "responder_6_lag_1")


@query("join_group_stats", f"""WITH {EV} SELECT event_id, {s6('avg(feature_00) OVER w', 'feature_00_mean')},
  {s6('stddev_samp(feature_00) OVER w', 'feature_00_std')} FROM ev WINDOW w AS (PARTITION BY date_id, time_id)""")
def join_group_stats(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder)
    joined = joins.join_group_stats(df, cross.group_moments(df, ["feature_00"], S.SNAPSHOT))
    return rounded(joined.select("event_id", "feature_00_mean", "feature_00_std"), "feature_00_mean", "feature_00_std")


@query("join_oof", f"""WITH {GRID} SELECT date_id, time_id, symbol_id, {s6('feature_00 * 0.1', 'oof_prediction')},
  {s6('responder_6', 'responder_6')} FROM grid WHERE date_id >= 10""")
def join_oof(spark: SparkSession, folder: str) -> DataFrame:
    grid = grid_panel(spark, folder)
    oof = grid.where(F.col(S.DATE) >= 10).withColumn("oof_prediction", F.col("feature_00") * 0.1)
    joined = joins.join_oof(grid.select(*S.KEYS, S.TARGET), oof)
    return rounded(joined, "oof_prediction", S.TARGET)


@query("semi_join_last_steps", f"""WITH {EV}, s AS (SELECT DISTINCT date_id, time_id FROM ev ORDER BY 1 DESC, 2 DESC LIMIT 30)
  SELECT event_id, date_id, time_id FROM ev JOIN s USING (date_id, time_id)""")
def semi_join_last_steps(spark: SparkSession, folder: str) -> DataFrame:
    return joins.semi_join_last_steps(events_panel(spark, folder), 30).select("event_id", S.DATE, S.TIME)


_ROLES = """d AS (SELECT date_id, row_number() OVER (ORDER BY date_id) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT date_id FROM {t})), h AS (SELECT date_id, CASE WHEN pos >= n - greatest(1, floor(n * 0.2)) THEN 'val'
  WHEN pos < n - greatest(1, floor(n * 0.2)) - 5 THEN 'train' END AS role FROM d)"""


@query("fold_role_join", f"""WITH {EV}, {_ROLES.format(t='ev')} SELECT event_id, date_id, 0 AS fold_idx, role
  FROM ev JOIN h USING (date_id) WHERE role IS NOT NULL""")
def fold_role_join(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder)
    return splits.fold_role_join(df, splits.holdout_split(df)).select("event_id", S.DATE, "fold_idx", "role")


@query("map_lookup_fallback", f"""WITH {LI}, m AS (SELECT symbol_id, sum(responder_6 * weight) / sum(weight) AS v FROM li
  WHERE date_id < 60 GROUP BY symbol_id), g AS (SELECT sum(responder_6 * weight) / sum(weight) AS v FROM li WHERE date_id < 60)
  SELECT date_id, symbol_id, count(*) AS n, {s6('max(coalesce(m.v, g.v))', 'value')} FROM li LEFT JOIN m USING (symbol_id), g
  GROUP BY date_id, symbol_id""")
def map_lookup_fallback(spark: SparkSession, folder: str) -> DataFrame:
    from tickloom.operators import baselines

    df = lineitem_panel(spark, folder)
    train = df.where(F.col(S.DATE) < 60)
    fitted = baselines.symbol_weighted_mean(train)
    overall = baselines.weighted_mean_fit(train).scalar()
    found = joins.map_lookup_fallback(df, fitted, [S.SYMBOL], "symbol_mean", overall, "value")
    return found.groupBy(S.DATE, S.SYMBOL).agg(F.count("*").alias("n"), r6(F.max("value")).alias("value"))


@query("align_models", f"""WITH {GRID} SELECT date_id, time_id, symbol_id, {s6('feature_00 * 0.1', 'a')},
  {s6('feature_00 - 40', 'b')} FROM grid WHERE date_id BETWEEN 3 AND 25""")
def align_models(spark: SparkSession, folder: str) -> DataFrame:
    grid = grid_panel(spark, folder)
    a = grid.where(F.col(S.DATE) >= 3).withColumn("oof_prediction", F.col("feature_00") * 0.1)
    b = grid.where(F.col(S.DATE) <= 25).withColumn("oof_prediction", F.col("feature_00") - 40)
    return rounded(joins.align_models({"a": a, "b": b}), "a", "b")


# Set operations


@query("union_partitions", f"WITH {EV} SELECT event_id, CAST(feature_00 AS DOUBLE) AS feature_00 FROM ev")
def union_partitions(spark: SparkSession, folder: str) -> DataFrame:
    df = events_panel(spark, folder).select("event_id", "feature_00", S.DATE)
    early, late = df.where(F.col(S.DATE) < 15), df.where(F.col(S.DATE) >= 15)
    return scan.union_partitions([early, late]).select("event_id", "feature_00")


_CHUNKS = """t AS (SELECT ntile(5) OVER (ORDER BY date_id) - 1 AS fold_idx, date_id FROM (SELECT DISTINCT date_id FROM ev)),
  b AS (SELECT fold_idx, min(date_id) AS lo, max(date_id) AS hi FROM t GROUP BY fold_idx)"""


@query("fold_range_join", f"""WITH {EV}, {_CHUNKS} SELECT CAST(b.fold_idx AS INTEGER) AS fold_idx, d.date_id,
  CASE WHEN d.date_id < lo THEN 'purge' ELSE 'embargo' END AS role FROM b, (SELECT DISTINCT date_id FROM ev) d
  WHERE (d.date_id >= lo - 2 AND d.date_id < lo) OR (d.date_id > hi AND d.date_id <= hi + 3)""")
def fold_range_join(spark: SparkSession, folder: str) -> DataFrame:
    return splits.fold_range_join(events_panel(spark, folder), 5, 2, 3)


@query("fold_exclusion", f"""WITH {EV}, {_CHUNKS} SELECT CAST(b.fold_idx AS INTEGER) AS fold_idx, d.date_id
  FROM b, (SELECT DISTINCT date_id FROM ev) d WHERE d.date_id < lo - 2 OR d.date_id > hi + 3""")
def fold_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    return splits.fold_exclusion(events_panel(spark, folder), 5, 2, 3)
