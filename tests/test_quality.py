import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality
from tickloom.operators.sampling import sample_rows
from tickloom.session import scratch_path, shared_dir
from tickloom.sources import scan


def stored(spark, df):
    path = scratch_path(spark, "checked")
    df.coalesce(1).sortWithinPartitions("date_id", "time_id", "symbol_id").write.parquet(path)
    return scan.scan_panel(spark, path)


FEATURES = ["feature_00", "feature_01"]


def severities(report):
    return {(r["check"], r["column"]): r["severity"] for r in report.collect()}


def test_clean_panel_passes(spark, panel):
    report = quality.validate_panel(stored(spark, panel), FEATURES)
    quality.raise_if_failed(report)
    assert set(severities(report).values()) == {"ok"}


@pytest.mark.parametrize(
    "change, check, column, severity",
    [
        (lambda d: d.withColumn("feature_00", F.lit(None).cast("float")), "missing_rate", "feature_00", "error"),
        (lambda d: d.withColumn("feature_00", F.when(F.col("symbol_id") > 7, F.col("feature_00"))), "missing_rate", "feature_00", "warning"),
        (lambda d: d.withColumn("weight", F.when(F.col("symbol_id") == 0, F.lit(-1.0)).otherwise(F.col("weight"))), "weight_negative", "weight", "error"),
        (lambda d: d.withColumn("weight", F.lit(0.0)), "weight_sum", "weight", "error"),
        (lambda d: d.withColumn("weight", F.when(F.col("symbol_id") > 0, F.col("weight"))), "weight_null", "weight", "warning"),
        (lambda d: d.withColumn("responder_6", F.lit(None).cast("float")), "target_known", "responder_6", "error"),
        (lambda d: d.withColumn("responder_6", F.lit(0.5)), "target_spread", "responder_6", "error"),
        (lambda d: d.withColumn("responder_6", F.col("responder_6") + 3), "target_mean", "responder_6", "warning"),
        (lambda d: d.drop("weight"), "required_columns", "weight", "error"),
        (lambda d: d.where("false"), "not_empty", None, "error"),
    ],
)
def test_faults_are_found(spark, panel, change, check, column, severity):
    report = quality.validate_panel(change(stored(spark, panel)), FEATURES, file_order=False)
    assert severities(report)[(check, column)] == severity
    if severity == "error":
        with pytest.raises(ValueError):
            quality.raise_if_failed(report)


def test_file_order(spark, panel):
    path = scratch_path(spark, "disorder")
    panel.coalesce(1).sortWithinPartitions(F.desc("date_id")).write.parquet(path)
    assert quality.date_monotonic(spark.read.parquet(path)).first()["severity"] == "error"
    assert quality.date_monotonic(stored(spark, panel)).first()["severity"] == "ok"


def test_nan_is_missing(spark):
    path = scratch_path(spark, "nan")
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, x double").write.parquet(path)
    assert scan.scan_panel(spark, path).where("x is null").count() == 1


def test_seeds_give_unrelated_samples(spark):
    """Two samples of a fifth overlap in about a fifth, and one seed always gives the same sample."""
    df = spark.range(5000).withColumnRenamed("id", "key")
    a, b, again = ({r["key"] for r in sample_rows(df, 1000, "key", seed).collect()} for seed in (42, 43, 42))
    assert a == again and 150 < len(a & b) < 250


def test_shared_folder_is_needed_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_dir(Cluster())
