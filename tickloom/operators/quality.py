"""Data-quality checks as tables of (check, column, severity, value, threshold)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom import schema as S

REPORT = "check string, column string, severity string, value double, threshold double"


def _row(check: str, column: Column | str, severity: Column, value: Column, threshold: Column | float | None) -> Column:
    named = F.lit(column) if isinstance(column, str) else column
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.struct(
        F.lit(check).alias("check"),
        named.alias("column"),
        severity.alias("severity"),
        value.cast("double").alias("value"),
        limit.cast("double").alias("threshold"),
    )


def _severity(error: Column, warning: Column | None = None) -> Column:
    out = F.when(error, "error")
    if warning is not None:
        out = out.when(warning, "warning")
    return out.otherwise("ok")


def required_columns(spark: SparkSession, columns: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row per required column; read from the schema alone."""
    rows = [
        ("required_columns", c, "ok" if c in columns else "error", float(c in columns), 1.0) for c in required
    ]
    return spark.createDataFrame(rows, REPORT)


def date_monotonic(df: DataFrame, date: str = S.DATE) -> DataFrame:
    """Whether dates never fall, in file order, within and across files; needs a file-based frame.

    Dates rise within a file exactly when each date's first row comes after the last row of all earlier
    dates. So the rows shrink to first and last row per (file, date) before any shuffle. The value is the
    number of dates and files out of order.
    """
    spans = df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col(date).alias("date")
    ).agg(F.min("_metadata.row_index").alias("first"), F.max("_metadata.row_index").alias("last"))
    earlier = Window.partitionBy("file").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    per_file = (
        spans.withColumn("late", (F.col("first") < F.max("last").over(earlier)).cast("int"))
        .groupBy("file")
        .agg(F.sum("late").alias("late"), F.min("date").alias("low"), F.max("date").alias("high"))
    )
    # One row per file from here on.
    files_before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    behind = (F.col("low") < F.max("high").over(files_before)).cast("int")
    bad = per_file.withColumn("behind", behind).agg(
        F.coalesce(F.sum(F.coalesce("late", F.lit(0)) + F.coalesce("behind", F.lit(0))), F.lit(0)).alias("_bad")
    )
    return bad.select(F.inline(F.array(_row("date_monotonic", date, _severity(F.col("_bad") > 0), F.col("_bad"), 0.0))))


def missing_thresholds(
    df: DataFrame, columns: Sequence[str], warn: float = 0.30, error: float = 0.80
) -> DataFrame:
    one = df.agg(*_missing_aggregates(columns))
    return one.select(F.inline(F.array(*_missing_rows(columns, warn, error))))


def _missing_aggregates(columns: Sequence[str]) -> list[Column]:
    return [F.count("*").alias("_n")] + [F.count(c).alias(f"_known_{c}") for c in columns]


def _missing_rows(columns: Sequence[str], warn: float, error: float) -> list[Column]:
    out = [_row("not_empty", F.lit(None).cast("string"), _severity(F.col("_n") == 0), F.col("_n"), 1.0)]
    for c in columns:
        rate = 1 - F.try_divide(F.col(f"_known_{c}"), F.col("_n"))
        limit = F.when(rate >= error, F.lit(error)).otherwise(F.lit(warn))
        out.append(_row("missing_rate", c, _severity(rate >= error, rate >= warn), rate, limit))
    return out


def weight_checks(df: DataFrame, weight: str = S.WEIGHT) -> DataFrame:
    return df.agg(*_weight_aggregates(weight)).select(F.inline(F.array(*_weight_rows(weight))))


def _weight_aggregates(weight: str) -> list[Column]:
    return [
        F.count_if(F.col(weight) < 0).alias("_w_negative"),
        F.coalesce(F.sum(weight), F.lit(0.0)).alias("_w_sum"),
        F.count_if(F.col(weight).isNull()).alias("_w_null"),
    ]


def _weight_rows(weight: str) -> list[Column]:
    no_sum = F.col("_w_sum") == 0
    return [
        _row("weight_negative", weight, _severity(F.col("_w_negative") > 0), F.col("_w_negative"), 0.0),
        _row("weight_sum", weight, _severity(no_sum), F.col("_w_sum"), 0.0),
        _row(
            "weight_null", weight, _severity(F.lit(False), ~no_sum & (F.col("_w_null") > 0)), F.col("_w_null"), 0.0
        ),
    ]


def target_checks(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.agg(*_target_aggregates(target)).select(F.inline(F.array(*_target_rows(target))))


def _target_aggregates(target: str) -> list[Column]:
    return [
        F.count(target).alias("_t_known"),
        F.stddev_samp(target).alias("_t_std"),
        F.avg(target).alias("_t_mean"),
    ]


def _target_rows(target: str) -> list[Column]:
    known = F.col("_t_known") > 0
    flat = known & (F.col("_t_std").isNull() | (F.col("_t_std") == 0))
    far = known & ~flat & (F.abs("_t_mean") > 1.0)
    return [
        _row("target_known", target, _severity(~known), F.col("_t_known"), 1.0),
        _row("target_spread", target, _severity(flat), F.col("_t_std"), 0.0),
        _row("target_mean", target, _severity(F.lit(False), far), F.col("_t_mean"), 1.0),
    ]


def validate_panel(
    df: DataFrame,
    features: Sequence[str],
    *,
    target: str = S.TARGET,
    weight: str = S.WEIGHT,
    keys: Sequence[str] = tuple(S.KEYS),
    warn: float = 0.30,
    error: float = 0.80,
    file_order: bool = True,
) -> DataFrame:
    """All checks as one report; values come from one aggregate pass, file order from a second."""
    present = set(df.columns)
    parts = [required_columns(df.sparkSession, df.columns, [*keys, weight, target])]
    found = [c for c in features if c in present]
    aggregates, rows = _missing_aggregates(found), _missing_rows(found, warn, error)
    if weight in present:
        aggregates, rows = aggregates + _weight_aggregates(weight), rows + _weight_rows(weight)
    if target in present:
        aggregates, rows = aggregates + _target_aggregates(target), rows + _target_rows(target)
    parts.append(df.agg(*aggregates).select(F.inline(F.array(*rows))))
    if file_order and S.DATE in present:
        parts.append(date_monotonic(df))
    return reduce(DataFrame.unionByName, parts)


def raise_if_failed(report: DataFrame) -> None:
    """Strict mode: name every check that failed."""
    failed = report.where(F.col("severity") == "error").select("check", "column", "value").limit(100).collect()
    if failed:
        raise ValueError("validation failed: " + "; ".join(f"{r['check']}({r['column']})={r['value']}" for r in failed))


def no_future_leakage(train: DataFrame, val: DataFrame, date: str = S.DATE) -> DataFrame:
    """The last training date must be before the first validation date."""
    last = train.agg(F.max(date)).scalar()
    ends = val.agg(F.min(date).alias("first_val")).select(last.alias("last_train"), "first_val")
    ok = F.col("last_train").isNotNull() & F.col("first_val").isNotNull() & (F.col("last_train") < F.col("first_val"))
    return ends.withColumn("severity", F.when(ok, "ok").otherwise("error"))


def assert_no_future_leakage(train: DataFrame, val: DataFrame, date: str = S.DATE) -> None:
    row = no_future_leakage(train, val, date).first()
    if row["severity"] == "error":
        raise ValueError(f"last train {date}={row['last_train']}, first validation {date}={row['first_val']}")
