import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality, splits


def dates_frame(spark, dates):
    return spark.createDataFrame([(int(d), 0, s) for d in dates for s in (0, 1)], "date_id int, time_id int, symbol_id int")


def as_sets(folds):
    out = {}
    for r in folds.collect():
        out.setdefault(r["fold_idx"], {"train": set(), "val": set()})[r["role"]].add(r["date_id"])
    return out


def brute(dates, k, purge, embargo, forward, least):
    dates = np.unique(dates)
    out = {}
    for i, chunk in enumerate(np.array_split(dates, k)):
        lo, hi = chunk.min(), chunk.max()
        keep = {
            int(d) for d in dates
            if not lo - purge <= d <= hi + embargo and (not forward or d < lo)
        }
        if len(keep) >= least:
            out[i] = {"train": keep, "val": {int(d) for d in chunk}}
    return out


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("dates", [list(range(20)), [0, 1, 2, 5, 9, 10, 11, 17, 30, 31, 40, 44, 45]])
def test_purged_kfold(spark, forward, dates):
    folds = splits.purged_kfold(dates_frame(spark, dates), 4, 2, 3, forward, 3)
    assert as_sets(folds) == brute(dates, 4, 2, 3, forward, 3)
    assert splits.fold_overlap(folds).isEmpty()


def test_purged_kfold_errors(spark):
    with pytest.raises(ValueError):
        splits.purged_kfold(dates_frame(spark, [0, 1, 2]), 5)
    with pytest.raises(ValueError):
        splits.purged_kfold(dates_frame(spark, range(20)), 1)
    with pytest.raises(ValueError):
        splits.purged_kfold(dates_frame(spark, range(12)), 3, min_train_dates=30)


def test_walk_forward(spark):
    got = as_sets(splits.walk_forward(dates_frame(spark, range(40)), 10, 5, 8, 2))
    assert sorted(got) == [0, 1, 2, 3]
    for k, fold in got.items():
        start = 10 + 8 * k
        assert fold["train"] == set(range(start - 2)) and fold["val"] == set(range(start, start + 5))
    assert splits.walk_forward(dates_frame(spark, range(12)), 10, 5, 8, 2).isEmpty()


def test_holdout(spark):
    got = as_sets(splits.holdout_split(dates_frame(spark, range(20)), 0.2, 5))[0]
    assert got == {"train": set(range(11)), "val": set(range(16, 20))}
    with pytest.raises(ValueError):
        splits.holdout_split(dates_frame(spark, range(6)), 0.2, 5)


def test_rows_get_roles(spark):
    df = dates_frame(spark, range(20))
    folds = splits.holdout_split(df)
    roles = splits.fold_role_join(df, folds).groupBy("role").count().collect()
    assert {r["role"]: r["count"] for r in roles} == {"train": 22, "val": 8}
    assert splits.fold_rows(df, folds, 0, "val").agg(F.min("date_id")).first()[0] == 16


def test_sliding_windows():
    assert splits.sliding_windows(0, 10, 4, 5) == [(0, 4, 8), (4, 8, 10)]


def test_leakage(spark):
    df = dates_frame(spark, range(10))
    early, late = df.where("date_id < 5"), df.where("date_id >= 5")
    quality.assert_no_future_leakage(early, late)
    for train, val in ((late, early), (df, late), (early.where("false"), late)):
        with pytest.raises(ValueError):
            quality.assert_no_future_leakage(train, val)
