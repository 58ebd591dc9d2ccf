"""Names and types of the panel tables."""

from __future__ import annotations

from pyspark.sql import types as T

DATE = "date_id"
TIME = "time_id"
SYMBOL = "symbol_id"
KEYS = [DATE, TIME, SYMBOL]
SNAPSHOT = [DATE, TIME]
WEIGHT = "weight"
TARGET = "responder_6"
ROW_ID = "row_id"
PREDICTION = "prediction"

FEATURES = [f"feature_{i:02d}" for i in range(79)]
RESPONDERS = [f"responder_{i}" for i in range(9)]
LAGGED_RESPONDERS = [f"{r}_lag_1" for r in RESPONDERS]

# The other responders move with the target, so they are never inputs.
LEAKY = [r for r in RESPONDERS if r != TARGET]

# The features that get a cross-sectional z-score in the boosted-tree runs.
ZSCORE_TOP10 = [f"feature_{i:02d}" for i in (6, 7, 36, 4, 52, 60, 59, 15, 58, 30)]
ZSCORE_TOP15 = ZSCORE_TOP10 + [f"feature_{i:02d}" for i in (76, 5, 75, 8, 56)]


def _floats(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.FloatType()) for n in names]


_KEY_FIELDS = [
    T.StructField(DATE, T.ShortType()),
    T.StructField(TIME, T.ShortType()),
    T.StructField(SYMBOL, T.ByteType()),
]

TRAIN_SCHEMA = T.StructType(_KEY_FIELDS + _floats([WEIGHT] + FEATURES + RESPONDERS))
LAG_SCHEMA = T.StructType(_KEY_FIELDS + _floats(LAGGED_RESPONDERS))
TEST_SCHEMA = T.StructType(
    [T.StructField(ROW_ID, T.LongType())]
    + _KEY_FIELDS
    + [T.StructField(WEIGHT, T.FloatType()), T.StructField("is_scored", T.BooleanType())]
    + _floats(FEATURES)
)
FEATURE_TAGS_SCHEMA = T.StructType(
    [T.StructField("feature", T.StringType())]
    + [T.StructField(f"tag_{i}", T.BooleanType()) for i in range(17)]
)
RESPONDER_TAGS_SCHEMA = T.StructType(
    [T.StructField("responder", T.StringType())]
    + [T.StructField(f"tag_{i}", T.BooleanType()) for i in range(5)]
)
SUBMISSION_SCHEMA = T.StructType(
    [T.StructField(ROW_ID, T.LongType()), T.StructField(TARGET, T.DoubleType())]
)
