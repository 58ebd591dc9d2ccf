"""Size checks that choose between a one-shuffle plan and a plan that splits hot groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import checkpointed

X, Y = TypeVar("X"), TypeVar("Y")

# A whole input below this size fits one task, so no group in it can be too large.
ONE_TASK_BYTES = 128 * 1024 * 1024
# Largest group that one window task may hold.
ONE_TASK_ROWS = 2_000_000
# Rows aimed at per block once a group is split.
BLOCK_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 200_000
# Bytes of files that one task of a fit should read: what Spark ML keeps of a row is some fifteen times larger.
FIT_BYTES = 16 * 1024 * 1024


@contextmanager
def small_scans(spark: SparkSession, size: int = FIT_BYTES) -> Iterator[None]:
    """Within it, a task reads at most about ``size`` bytes of files (one row group, if that is larger)."""
    name = "spark.sql.files.maxPartitionBytes"
    before, now = spark.conf.get(name, None), int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    spark.conf.set(name, min(size, now))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan, in bytes."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fit_tasks(df: DataFrame) -> int:
    """Tasks that a fit on ``df`` needs if each reads about ``FIT_BYTES``."""
    return max(1, -(-estimated_bytes(df) // FIT_BYTES))


def packed(df: DataFrame) -> DataFrame:
    """A small input in no more partitions than a fit needs, as every level of every tree is a job over them."""
    tasks = fit_tasks(df)
    return df.coalesce(tasks) if tasks < df.sparkSession.sparkContext.defaultParallelism else df


def fits_side_by_side(df: DataFrame, fit: Callable[[X], Y], items: Iterable[X]) -> list[Y]:
    """``fit`` of every item, in order; those on small parts of ``df`` run at the same time, as many as fill the cores.

    The setting of ``small_scans`` belongs to the session, so it is held here around all fits.
    """
    spark = df.sparkSession
    at_once = max(1, spark.sparkContext.defaultParallelism // fit_tasks(df))
    with small_scans(spark), ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fit), items))


@dataclass
class Split:
    """Groups that must be cut, with their row counts, and the rows a block should hold."""

    hot: DataFrame
    block_rows: int


def find_split(df: DataFrame, group: Sequence[str], blocks: int | None = None) -> Split | None:
    """The groups of ``df`` that are too large for one task, or None if there are none.

    Small inputs are settled by the plan's size estimate, without a job. Larger ones cost one pass over
    the grouping columns, counted map-side before the shuffle; only the hot groups are kept, at most one
    per ``ONE_TASK_ROWS`` rows of input. ``blocks`` forces about that many blocks over the whole input.
    """
    if blocks is None and estimated_bytes(df) <= ONE_TASK_BYTES:
        return None
    counts = df.groupBy(*group).agg(F.count("*").alias("_count"))
    if blocks is not None:
        rows = max(1, df.count() // blocks)
        return Split(checkpointed(counts.where(F.col("_count") > rows)), rows)
    hot = checkpointed(counts.where(F.col("_count") > ONE_TASK_ROWS))
    return None if hot.isEmpty() else Split(hot, BLOCK_ROWS)


def lookup_side(df: DataFrame) -> DataFrame:
    """Prepare the small side of a join.

    Broadcast only if the size is known to be small, from the plan or from a count of the written table.
    Anything larger is returned as a plain table for a shuffle join, which AQE splits on hot keys.
    """
    if estimated_bytes(df) <= BROADCAST_BYTES:
        return F.broadcast(df)
    kept = checkpointed(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept

