"""Readers for panel tables, their lag and test companions, and metadata files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schema as S
from tickloom.functions.scalar import between_filter, nan_to_null
from tickloom.operators.sampling import sample_by_group


def scan_panel(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    nan_as_null: bool = True,
) -> DataFrame:
    """A parquet file or a tree of them; partition directories become columns that prune."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return nan_to_null(df) if nan_as_null else df


def scan_date_range(
    spark: SparkSession,
    path: str,
    date_range: tuple[int | None, int | None] | None = None,
    columns: Sequence[str] | None = None,
    max_rows: int | None = None,
    order: Sequence[str] = (),
    date: str = S.DATE,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan with an inclusive date range that reaches the parquet filter; optional row cap.

    A cap without ``order`` keeps whatever rows come first; with ``order`` it keeps the same rows always.
    """
    df = scan_panel(spark, path, None, schema)
    if date_range is not None:
        df = between_filter(df, date, *date_range)
    if columns is not None:
        df = df.select(*columns)
    if max_rows is not None:
        df = (df.orderBy(*order) if order else df).limit(max_rows)
    return df


def scan_lag(
    spark: SparkSession, path: str, date_range: tuple[int | None, int | None] | None = None, date: str = S.DATE
) -> DataFrame:
    """The lag table, laid out by date, so a date range skips whole directories."""
    return scan_date_range(spark, path, date_range, date=date)


def scan_test(spark: SparkSession, path: str) -> DataFrame:
    """The test table: row ids and no responders."""
    df = scan_panel(spark, path)
    return df.drop(*[c for c in S.RESPONDERS if c in df.columns])


def scan_generic(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def scan_partitions(
    spark: SparkSession,
    path: str,
    ids: Sequence[int],
    fraction: float | None = None,
    group: Sequence[str] = (S.DATE,),
    key: str = S.ROW_ID,
    seed: int = 42,
    partition: str = "partition_id",
) -> DataFrame:
    """Chosen partition directories in one scan, optionally sampled within each partition and group."""
    df = scan_panel(spark, path).where(F.col(partition).isin([int(i) for i in ids]))
    return sample_by_group(df, fraction, [partition, *group], key, seed)


def scan_csv_meta(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small header CSV with a declared schema (tag tables, submission template)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def union_partitions(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by name; numeric types are widened to the widest of each column."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
