"""Registry of named queries with their SQL, and the given tables seen as panels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.session import scratch_path
from tickloom.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

ORDER = [S.DATE, S.TIME, "event_id"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Rounded for comparison.

    The nudge keeps exact halves from depending on the engine; adding 0 turns -0.0 into 0.0.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double") + F.lit(1e-9), 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


def s6(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE) + 1e-9, 6) + 0.0 AS {name}"


def events_panel(spark: SparkSession, folder: str) -> DataFrame:
    """events: user per (day, hour); feature_01 has missing values."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias(S.SYMBOL),
        F.datediff("ts", F.lit("2024-01-01").cast("date")).alias(S.DATE),
        F.hour("ts").alias(S.TIME),
        "event_id",
        F.col("value").alias("feature_00"),
        F.when(F.col("event_id") % 13 != 0, F.col("value") * 0.5 - F.col("event_id") % 7).alias("feature_01"),
        (F.col("value") - 50).alias(S.TARGET),
        (1 + F.col("event_id") % 3).cast("double").alias(S.WEIGHT),
    )


EV = """ev AS (SELECT user_id AS symbol_id,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS date_id,
  CAST(hour(ts) AS INTEGER) AS time_id, event_id, value AS feature_00,
  CASE WHEN event_id % 13 <> 0 THEN value * 0.5 - event_id % 7 END AS feature_01,
  value - 50 AS responder_6, CAST(1 + event_id % 3 AS DOUBLE) AS weight FROM events)"""
W_E = "PARTITION BY symbol_id ORDER BY date_id, time_id, event_id"


def lineitem_panel(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem: supplier per ship day; truth is the discount and prediction the tax, both centred."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias(S.SYMBOL),
        F.datediff("l_shipdate", F.lit("1995-01-01").cast("date")).alias(S.DATE),
        F.col("l_linenumber").cast("int").alias(S.TIME),
        "l_orderkey",
        "l_partkey",
        F.col("l_extendedprice").alias("feature_00"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("l_tax")).alias("feature_01"),
        (F.col("l_discount") - 0.05).alias(S.TARGET),
        (F.col("l_tax") - 0.04).alias(S.PREDICTION),
        F.col("l_quantity").alias(S.WEIGHT),
    )


LI = """li AS (SELECT l_suppkey AS symbol_id,
  CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS date_id,
  CAST(l_linenumber AS INTEGER) AS time_id, l_orderkey, l_partkey, l_extendedprice AS feature_00,
  CASE WHEN l_partkey % 13 <> 0 THEN l_tax END AS feature_01,
  l_discount - 0.05 AS responder_6, l_tax - 0.04 AS prediction, l_quantity AS weight FROM lineitem)"""


def grid_panel(spark: SparkSession, folder: str) -> DataFrame:
    """events with one row per key: means per (date, time, symbol)."""
    return (
        events_panel(spark, folder)
        .groupBy(*S.KEYS)
        .agg(
            F.min("event_id").alias(S.ROW_ID),
            F.avg("feature_00").alias("feature_00"),
            F.avg(S.TARGET).alias(S.TARGET),
            F.sum(S.WEIGHT).alias(S.WEIGHT),
        )
    )


GRID = EV + """, grid AS (SELECT date_id, time_id, symbol_id, min(event_id) AS row_id, avg(feature_00) AS feature_00,
  avg(responder_6) AS responder_6, sum(weight) AS weight FROM ev GROUP BY date_id, time_id, symbol_id)"""


def lag_table(grid: DataFrame) -> DataFrame:
    """The responders of the day before, keyed by the day that may use them."""
    return grid.select(
        (F.col(S.DATE) + 1).alias(S.DATE), S.TIME, S.SYMBOL, F.col(S.TARGET).alias("responder_6_lag_1")
    )


PARTITION_DAYS = 250
_stores: dict[tuple[str, str], str] = {}


def stored_panel(spark: SparkSession, folder: str) -> str:
    """The lineitem panel written once per session, in directories of ``PARTITION_DAYS`` days."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stores:
        path = scratch_path(spark, "panel")
        cents = F.round(F.col("feature_00") * 100).cast("bigint")
        # These five columns are unique together.
        row_id = F.concat_ws("-", "l_orderkey", S.TIME, "l_partkey", S.SYMBOL, cents)
        day = F.floor(F.col(S.DATE) / F.lit(PARTITION_DAYS)).cast("int")
        df = lineitem_panel(spark, folder).withColumn("partition_id", day)
        sinks.write_parquet(df, path, ["partition_id"], [S.DATE, S.TIME, S.SYMBOL], derived={S.ROW_ID: row_id})
        _stores[key] = path
    return _stores[key]
