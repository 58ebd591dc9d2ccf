import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.catalog.common import stored_panel
from tickloom.functions import scalar
from tickloom.session import scratch_path
from tickloom.sources import generate, scan, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_columns_and_partitions_reach_the_scan(spark, folder):
    path = stored_panel(spark, folder)
    text = plan(scan.scan_date_range(spark, path, (400, 900), ["symbol_id", "feature_00"]))
    assert "GreaterThanOrEqual(date_id,400)" in text and "LessThanOrEqual(date_id,900)" in text
    assert "l_orderkey" not in text.split("ReadSchema")[1]
    text = plan(scan.scan_partitions(spark, path, [1, 3]))
    assert "partition_id" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_missing_path(spark):
    with pytest.raises(AnalysisException):
        scan.scan_date_range(spark, "/tmp/no-such-table.parquet")


def test_cap_is_repeatable(spark, folder):
    path = stored_panel(spark, folder)
    order = [*S.KEYS, "l_orderkey", "l_partkey", "feature_00"]
    a, b = (scan.scan_date_range(spark, path, None, order, 100, order) for _ in range(2))
    assert a.count() == 100 and a.exceptAll(b).isEmpty()


def test_schema_is_enforced(spark, panel):
    path = scratch_path(spark, "typed")
    panel.select(*S.KEYS, "weight").write.parquet(path)
    assert scan.scan_panel(spark, path, ["weight"]).schema["weight"].dataType.simpleString() == "float"


def test_generator(spark):
    df = generate.generate_panel(spark, 6, 4, 5, seed=3, features=3)
    assert df.count() == 120 and df.select(*S.KEYS).distinct().count() == 120
    again = generate.generate_panel(spark, 6, 4, 5, seed=3, features=3, partitions=3)
    assert df.exceptAll(again).isEmpty()
    pdf = df.toPandas().sort_values(["symbol_id", "date_id", "time_id"])
    for r in ("responder_0", "responder_6"):
        want = pdf.groupby("symbol_id")[r].shift(1)
        got = pdf[f"{r}_lag_1"]
        assert (want.isna() == got.isna()).all() and (want - got).abs().max() == 0
    big = generate.generate_panel(spark, 50, 10, 20, features=1)
    row = big.agg(
        F.avg(F.col("feature_00").isNull().cast("int")).alias("gap"), F.stddev("feature_00").alias("sd"),
        F.avg("weight").alias("w"), F.stddev("responder_6").alias("r"),
    ).first()
    assert 0.04 < row["gap"] < 0.06 and 0.97 < row["sd"] < 1.03
    assert 0.95 < row["w"] < 1.05 and 0.0097 < row["r"] < 0.0103


def test_hot_date_is_written_by_rebalance(spark, panel):
    path = scratch_path(spark, "hot")
    sinks.write_parquet(panel, path, ["date_id"], ["time_id"])
    assert spark.read.parquet(path).count() == panel.count()


def test_markdown(spark):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert sinks.markdown_table(df) == "| a | b |\n| --- | --- |\n| 1 | 2.5 |"


def test_scalars(spark):
    assert scalar.dynamic_min_leaf(816349, 816349) == 800
    assert scalar.dynamic_min_leaf(100, 816349) == 100
    assert scalar.scaled_alpha(5e6, 50, 100) == 2.5e6
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "date_id int, weight double")
    assert [r[0] for r in scalar.with_time_decay(df).select("decayed_weight").collect()] == [1.0, 2.0]
    with pytest.raises(ValueError, match="nope"):
        scalar.project_features(df, ["nope"], "weight", None)


def test_write_splits_a_hot_value_whatever_the_input_tasks(spark, panel, monkeypatch):
    path, day = scratch_path(spark, "ranges"), F.lit(3).alias("date_id")
    hot = panel.select(day, "time_id", "symbol_id", "feature_00").coalesce(1)
    monkeypatch.setattr(sinks, "WRITE_BYTES", sinks.sizing.estimated_bytes(hot) // 4)
    sinks.write_parquet(hot, path, ["date_id"], ["time_id"], derived={"row_id": F.concat_ws("-", "time_id", "symbol_id")})
    got = spark.read.parquet(path)
    ends = got.groupBy(F.input_file_name()).agg(F.min("time_id").alias("lo"), F.max("time_id").alias("hi")).orderBy("lo").collect()
    assert len(ends) >= 4 and all(a["hi"] <= b["lo"] for a, b in zip(ends, ends[1:]))
    assert got.drop("row_id").exceptAll(hot.select(*[c for c in got.columns if c != "row_id"])).isEmpty() and got.count() == panel.count()
    assert got.where(F.col("row_id") != F.concat_ws("-", "time_id", "symbol_id")).isEmpty()


def test_many_partition_values_make_ranges_not_directories(spark, panel, monkeypatch):
    monkeypatch.setattr(sinks, "DIRECTORIES", 15)
    df = panel.select("date_id", "time_id", "symbol_id", "feature_00")
    for column, directories in (("symbol_id", 15), ("date_id", 0)):
        path = scratch_path(spark, "values")
        sinks.write_parquet(df, path, [column], ["time_id"])
        got = spark.read.parquet(path)
        assert sum(f"/{column}=" in f for f in got.inputFiles()) == (directories and len(got.inputFiles()))
        assert got.select(*df.columns).exceptAll(df).isEmpty() and got.count() == df.count()
