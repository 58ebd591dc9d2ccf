"""Writers for tables, metrics and submissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schema as S
from tickloom.plans import sizing

# Input that one writing task should hold, by the plan's estimate; Parquet rows are some ten times larger in memory.
WRITE_BYTES = 8 * 1024 * 1024
# Directories of one table: each file takes some 20 ms to write and read.
DIRECTORIES = 5000
# An estimate over joins may be far too high.
WRITE_TASKS = 4096


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    derived: dict[str, Column] | None = None,
) -> None:
    """Parquet by partition column; ``derived`` columns are made from the others as rows are written.

    Rows are dealt by range of partition and sort columns into about one task per ``WRITE_BYTES`` of input, so a task
    sorts few rows whatever the number of files, partition values or shuffle partitions, a value's rows meet in few
    tasks, and a hot value is written by many: ties are dealt by a hash of the row. Only the columns that ``derived``
    does not make are shuffled.

    Up to ``DIRECTORIES`` partition values have a directory each. More would make files of a few rows, whose number
    grows with the values; such a table is written without directories. Its files hold ranges of the partition columns
    in order, so a filter on these skips files and row groups by their statistics.
    """
    by: list[str] = []
    if partition_by:
        few = df.select(*partition_by).distinct().limit(DIRECTORIES + 1).count() <= DIRECTORIES
        by = list(partition_by) if few else []
        tied = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
        tasks = min(WRITE_TASKS, 1 + sizing.estimated_bytes(df) // WRITE_BYTES)
        df = df.repartitionByRange(tasks, *partition_by, *sort_by, F.xxhash64(*tied))
    if sort_by or partition_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.withColumns(derived or {}).write.mode(mode).partitionBy(*by).parquet(path)


def write_metrics(row: DataFrame, path: str) -> None:
    """One-row metrics as a JSON line."""
    row.coalesce(1).write.mode("overwrite").json(path)


def write_report_table(df: DataFrame, path: str) -> None:
    """A small report table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def markdown_table(df: DataFrame, limit: int = 20) -> str:
    """The first rows of a report table as markdown text."""
    rows = df.limit(limit).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(str(v) for v in r) + " |" for r in rows])


def submission(df: DataFrame, prediction: str = S.PREDICTION) -> DataFrame:
    """Exactly the row id and the predicted target."""
    return df.select(S.ROW_ID, F.col(prediction).cast("double").alias(S.TARGET))


def write_submission(df: DataFrame, path: str, prediction: str = S.PREDICTION) -> None:
    submission(df, prediction).write.mode("overwrite").option("header", True).csv(path)
