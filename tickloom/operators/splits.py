"""Leak-free time splits as tables of (fold_idx, date_id, role).

Folds are cut on the distinct dates, a calendar-sized table, so one ordered window over it is enough. Rows
get their role by an equi-join on the date.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.plans import sizing
from tickloom.session import checkpointed


def distinct_dates(df: DataFrame, date: str = S.DATE) -> DataFrame:
    return df.select(date).distinct()


def _numbered(df: DataFrame, date: str) -> DataFrame:
    """Distinct dates with their position from 0 and the number of dates."""
    return distinct_dates(df, date).select(
        F.col(date),
        (F.row_number().over(Window.orderBy(date)) - 1).alias("pos"),
        F.count("*").over(Window.partitionBy()).alias("n_dates"),
    )


def calendar(df: DataFrame, date: str = S.DATE) -> DataFrame:
    """The distinct dates, derived once: everything about folds follows from this small table."""
    return checkpointed(distinct_dates(df, date).select(F.col(date).cast("int").alias(date)))


def _chunks(dates: DataFrame, n_splits: int, date: str) -> DataFrame:
    """Consecutive chunks of dates; the first ones take one date more if the division leaves a rest."""
    return dates.select((F.ntile(n_splits).over(Window.orderBy(date)) - 1).alias("fold_idx"), date)


def _bounds(tests: DataFrame, date: str) -> DataFrame:
    return tests.groupBy("fold_idx").agg(F.min(date).alias("lo"), F.max(date).alias("hi"))


def _zones(dates: DataFrame, bounds: DataFrame, purge: int, embargo: int, date: str) -> DataFrame:
    def zone(role: str, first, last, size: int) -> DataFrame:
        days = F.sequence(first, last) if size > 0 else F.array().cast("array<int>")
        return bounds.select("fold_idx", F.explode(days).alias(date), F.lit(role).alias("role"))

    purged = zone("purge", F.col("lo") - purge, F.col("lo") - 1, purge)
    embargoed = zone("embargo", F.col("hi") + 1, F.col("hi") + embargo, embargo)
    return purged.unionByName(embargoed).join(dates, date).select("fold_idx", date, "role")


def _allowed(dates: DataFrame, tests: DataFrame, zones: DataFrame, n_splits: int, date: str) -> DataFrame:
    barred = tests.select("fold_idx", date).unionByName(zones.select("fold_idx", date))
    folds = dates.select(F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold_idx"), date)
    return folds.join(barred, ["fold_idx", date], "left_anti")


def fold_range_join(df: DataFrame, n_splits: int, purge: int, embargo: int, date: str = S.DATE) -> DataFrame:
    """The purged dates before and the embargoed dates after each fold's test window, by date value."""
    dates = calendar(df, date)
    return _zones(dates, _bounds(_chunks(dates, n_splits, date), date), purge, embargo, date)


def fold_exclusion(df: DataFrame, n_splits: int, purge: int, embargo: int, date: str = S.DATE) -> DataFrame:
    """Dates that may train for each fold: every date that is not tested, purged or embargoed."""
    dates = calendar(df, date)
    tests = _chunks(dates, n_splits, date)
    zones = _zones(dates, _bounds(tests, date), purge, embargo, date)
    return _allowed(dates, tests, zones, n_splits, date)


def purged_kfold(
    df: DataFrame,
    n_splits: int = 5,
    purge: int = 5,
    embargo: int = 10,
    forward_only: bool = True,
    min_train_dates: int = 30,
    date: str = S.DATE,
) -> DataFrame:
    """Folds with purge and embargo; folds with too few training dates are left out.

    Raises if there are fewer than two dates per fold, or if no fold is left.
    """
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    n = distinct_dates(df, date).count()
    if n < 2 * n_splits:
        raise ValueError(f"{n} dates are not enough for {n_splits} folds")
    dates = calendar(df, date)
    tests = _chunks(dates, n_splits, date)
    bounds = _bounds(tests, date)
    candidates = _allowed(dates, tests, _zones(dates, bounds, purge, embargo, date), n_splits, date)
    if forward_only:
        candidates = candidates.join(bounds, "fold_idx").where(F.col(date) < F.col("lo")).select("fold_idx", date)
    size = F.count("*").over(Window.partitionBy("fold_idx"))
    train = candidates.withColumn("_size", size).where(F.col("_size") >= min_train_dates)
    train = train.select("fold_idx", date, F.lit("train").alias("role"))
    if train.isEmpty():
        raise ValueError("no fold has enough training dates")
    val = tests.select("fold_idx", date, F.lit("val").alias("role"))
    if min_train_dates > 0:
        val = val.join(train.select("fold_idx").distinct(), "fold_idx", "left_semi")
    return train.unionByName(val)


def walk_forward(
    df: DataFrame,
    min_train: int = 200,
    test_window: int = 50,
    step: int = 50,
    embargo: int = 5,
    date: str = S.DATE,
) -> DataFrame:
    """Expanding training window, then a gap of ``embargo`` positions, then ``test_window`` dates."""
    if min(min_train, test_window, step) <= 0 or embargo < 0:
        raise ValueError("min_train, test_window and step must be positive, embargo not negative")
    rows = _numbered(df, date)
    last = F.floor((F.col("n_dates") - test_window - min_train) / F.lit(step))
    folds = F.when(last >= 0, F.sequence(F.lit(0), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    placed = rows.select(date, "pos", F.explode(folds).alias("fold_idx"))
    start = F.lit(min_train) + F.col("fold_idx") * F.lit(step)
    role = F.when(F.col("pos") < start - embargo, "train").when(
        (F.col("pos") >= start) & (F.col("pos") < start + test_window), "val"
    )
    return placed.select("fold_idx", F.col(date).cast("int").alias(date), role.alias("role")).where(
        F.col("role").isNotNull()
    )


def holdout_split(df: DataFrame, val_fraction: float = 0.2, purge: int = 5, date: str = S.DATE) -> DataFrame:
    """The last dates for validation, ``purge`` positions before them dropped, the rest for training.

    Raises if the purge leaves no date to train on.
    """
    n = distinct_dates(df, date).count()
    if n - max(1, int(n * val_fraction)) <= purge:
        raise ValueError(f"purging {purge} dates leaves none to train on")
    n_val = F.greatest(F.lit(1), F.floor(F.col("n_dates") * F.lit(val_fraction)))
    n_train = F.col("n_dates") - n_val
    role = F.when(F.col("pos") >= n_train, "val").when(F.col("pos") < n_train - purge, "train")
    rows = _numbered(df, date).select(F.lit(0).alias("fold_idx"), F.col(date).cast("int").alias(date), role.alias("role"))
    return rows.where(F.col("role").isNotNull())


def expanding_partitions(
    df: DataFrame, first_val: int, last_val: int, start: int = 0, partition: str = "partition_id"
) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """Per validation partition: (partition, all earlier rows, its rows); filters prune partitions."""
    for v in range(first_val, last_val + 1):
        yield v, df.where(F.col(partition).between(start, v - 1)), df.where(F.col(partition) == v)


def sliding_windows(first: int, last: int, every: int, history: int) -> list[tuple[int, int, int]]:
    """(train_lo, train_hi, predict_to) for a model refitted every ``every`` dates on ``history`` dates."""
    return [(d - history, d - 1, min(d + every - 1, last)) for d in range(first + history, last + 1, every)]


def fold_role_join(df: DataFrame, folds: DataFrame, date: str = S.DATE) -> DataFrame:
    """Each row once per fold that uses it, with its role."""
    return df.join(sizing.lookup_side(folds), date)


def fold_rows(df: DataFrame, folds: DataFrame, fold: int, role: str, date: str = S.DATE) -> DataFrame:
    """Rows of one side of a fold. The range of its dates reaches the scan, so files outside are skipped."""
    dates = folds.where((F.col("fold_idx") == fold) & (F.col("role") == role)).select(date)
    ends = dates.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).first()
    if ends["lo"] is None:
        return df.where(F.lit(False))
    return df.where(F.col(date).between(ends["lo"], ends["hi"])).join(sizing.lookup_side(dates), date, "left_semi")


def fold_overlap(folds: DataFrame, date: str = S.DATE) -> DataFrame:
    """Dates that a fold both trains and validates on; must be empty."""
    roles = folds.select("fold_idx", date, "role")
    train = roles.where(F.col("role") == "train").drop("role")
    return train.intersect(roles.where(F.col("role") == "val").drop("role"))
