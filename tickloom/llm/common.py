"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Buckets per group of the first step of a top-k list.
BUCKETS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    ``batch_rows`` is the number of rows that go to Python at once while this is written; texts are large.
    """
    spark, setting = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = scratch_path(spark, name), spark.conf.get(setting)
    if batch_rows:
        spark.conf.set(setting, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df_columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column of the table has that name (case-insensitively)."""
    taken = {c.lower() for c in df_columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def top_per(df: DataFrame, group: list[str], order: list[Column], k: int, spread: Column) -> DataFrame:
    """The first ``k`` rows per group by ``order`` (a total order) with their rank, in two steps."""
    bucket = F.pmod(spread, F.lit(BUCKETS))
    first = df.withColumn("_bucket", bucket).withColumn("_r", F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order)))
    first = first.where(F.col("_r") <= k).drop("_bucket", "_r")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")).where(F.col("rank") <= k)
