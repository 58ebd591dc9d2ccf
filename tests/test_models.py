import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.catalog import models as catalog_models
from tickloom.functions.scalar import clipped
from tickloom.operators import blend, joins, splits
from tickloom.plans import models

FEATURES = ["feature_00", "feature_01", "feature_02"]
FAST = {"n_estimators": 3, "learning_rate": 0.3, "max_depth": 2, "min_data_in_leaf": 5, "random_state": 1}


@pytest.fixture(scope="module")
def learnable(panel):
    signal = F.coalesce(F.col("feature_00"), F.lit(0.0)) * 0.5 + F.col("responder_6")
    return panel.withColumn("responder_6", signal).withColumn("row_id", F.xxhash64("date_id", "time_id", "symbol_id")).persist()


@pytest.fixture(scope="module")
def folds(learnable):
    return splits.purged_kfold(learnable, 4, 1, 1, min_train_dates=3)


def test_ridge_equals_closed_form(learnable):
    alpha = 300.0
    model = models.ridge_grid(learnable, FEATURES, [alpha])[0]
    pdf = learnable.select(*FEATURES, "responder_6", "weight").toPandas().astype(float)
    x = pdf[FEATURES].fillna(pdf[FEATURES].median())
    x = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
    y, w = pdf["responder_6"].to_numpy(), pdf["weight"].to_numpy()
    xc, yc = x - np.average(x, axis=0, weights=w), y - np.average(y, weights=w)
    want = np.linalg.solve((xc * w[:, None]).T @ xc + alpha * np.eye(3), (xc * w[:, None]).T @ yc)
    assert np.allclose(model.coefficients, want, atol=1e-6)


def test_alpha_grid_picks_the_best(learnable):
    train, val = learnable.where("date_id < 12"), learnable.where("date_id >= 14")
    best, records = models.ridge_alpha_grid(train, val, FEATURES, [1.0, 1e6])
    assert records[0]["val_r2"] > records[1]["val_r2"]
    assert best.coefficients[0] == pytest.approx(max(best.coefficients))


def test_cross_validation(learnable, folds):
    cv = models.cv_train(learnable, folds, FEATURES, FAST)
    numbers = models.fold_numbers(folds)
    assert len(cv.models) == len(numbers) == cv.fold_metrics.count()
    val_dates = folds.where("role = 'val'").select("date_id").distinct()
    covered = learnable.join(val_dates, "date_id", "left_semi")
    assert cv.oof.count() == covered.count()
    assert cv.oof.select("date_id", "time_id", "symbol_id").distinct().count() == covered.count()
    top = cv.importance.orderBy(F.desc("importance")).first()
    assert top["feature"] == "feature_00"
    assert cv.fold_metrics.agg(F.min("weighted_r2")).first()[0] > 0.3
    mean = models.fold_average(cv.models, learnable).count()
    assert mean == learnable.count()


def test_early_stopping_ends_before_the_limit(learnable):
    train, val = learnable.where("date_id < 12"), learnable.where("date_id >= 14")
    params = {**FAST, "learning_rate": 1.0, "max_depth": 5}
    done = models.gbt_holdout(train, val, FEATURES, params, early_stop=True, rounds=30)
    assert 1 <= done.record["best_iteration"] < 30 and done.record["val_r2"] > 0.5


def test_parameter_names():
    got = models.tree_params(models.PRESETS["leafwise"])
    assert got["maxDepth"] == 7 and got["stepSize"] == 0.05 and got["minInstancesPerNode"] == 50
    assert models.tree_params(models.FINAL_PARAMS)["featureSubsetStrategy"] == "0.6"
    assert models.tree_params(models.PRESETS["symmetric"])["maxIter"] == 1000
    assert models.tree_params(models.FINAL_PARAMS)["featureSubsetStrategy"] != "all"


def test_grid_points_respect_depth():
    points = models.grid_points(models.GRIDS[0])
    assert all(p["num_leaves"] < 2 ** p["max_depth"] for p in points)
    assert len(points) == 3 * (1 + 3 + 4)


def test_grid_search_goes_on_from_the_best():
    def trial(p):
        return {"val_r2": -abs(p["a"] - 2) - abs(p.get("b", 0) - 5)}

    best, records = models.grid_search(trial, {"a": 0}, [{"a": [1, 2, 3]}, {"b": [4, 5]}])
    assert (best["a"], best["b"]) == (2, 5) and len(records) == 5


def test_random_search_stops_poor_trials():
    search = models.RandomSearch(models.SPACES["depthwise"], 30, seed=1)
    best = search.run(range(3), lambda p, fold: -p["max_depth"] + 0.01 * fold)
    assert len(search.records) == 30
    assert any(r["stopped"] for r in search.records) and best["max_depth"] == 3
    again = models.RandomSearch(models.SPACES["depthwise"], 30, seed=1)
    again.run(range(3), lambda p, fold: -p["max_depth"] + 0.01 * fold)
    assert again.records == search.records


def test_missing_values_are_flagged(learnable):
    medians = models.fit_medians(learnable, ["feature_00", "responder_0"])
    assert list(medians) == ["feature_00"]
    assert models.vector_names(["feature_00", "responder_0"], medians) == ["feature_00", "responder_0", "feature_00_missing"]


def test_blend_search_finds_the_good_model(spark, learnable):
    df = learnable.withColumns(
        {"good": F.col("responder_6") * 0.7 + F.randn(1) * 0.05, "bad": F.randn(2), "flat": F.lit(0.01)}
    ).persist()
    weights = blend.blend_weight_search(df, ["good", "bad", "flat"])
    assert sum(weights) == pytest.approx(1) and weights[0] > 0.8

    def score(ws):
        return blend.score_blends(blend.blend_sums(df, ["good", "bad", "flat"]), [ws]).first()["score"]

    assert score(weights) >= max(score(w) for w in ([1, 0, 0], [1 / 3] * 3, [0.9, 0.05, 0.05]))


def test_align_drops_incomplete_keys(spark):
    a = spark.createDataFrame([(0, 0, 1, 1.0), (0, 0, 2, None)], "date_id int, time_id int, symbol_id int, oof_prediction double")
    b = spark.createDataFrame([(0, 0, 2, 4.0), (0, 0, 3, 3.0)], a.schema)
    assert [tuple(r) for r in joins.align_models({"a": a, "b": b}).collect()] == [(0, 0, 2, None, 4.0)]


def test_isotonic_is_monotone_and_flat_outside(spark):
    rows = [(float(x), y) for x, y in zip([1, 2, 3, 4, 5], [1.0, 3.0, 2.0, 4.0, 3.5])]
    fit_on = spark.createDataFrame(rows, "prediction double, responder_6 double")
    probe = spark.createDataFrame([(0.0,), (2.0,), (3.0,), (4.5,), (9.0,)], "prediction double")
    out = [r["calibrated"] for r in blend.isotonic(probe, fit_on, "responder_6", "prediction").orderBy("prediction").collect()]
    assert out == pytest.approx([1.0, 2.5, 2.5, 3.75, 3.75])


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (9.0,), (-9.0,), (1.0,)], "p double")
    assert [r[0] for r in df.select(clipped(F.col("p"))).collect()] == [None, 5.0, -5.0, 1.0]


def test_unknown_symbol_has_no_one(spark):
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([(1,), (2,), (2,)], "symbol_id int")
    new = spark.createDataFrame([(1,), (9,)], "symbol_id int")
    out = models.onehot_symbol(train).transform(new).select("symbol_id", vector_to_array("symbol_vector").alias("v"))
    assert {r["symbol_id"]: sum(r["v"]) for r in out.collect()} == {1: 1.0, 9: 0.0}


def test_ridge_from_sums_equals_direct_solution(spark):
    """Every penalty from one pass of sums equals the weighted ridge solved on the rows themselves."""
    import numpy as np

    from tickloom.plans import models as m

    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a, b = 1000 + rng.normal(0, 3), rng.normal(0, 1)
        rows.append((None if i % 9 == 0 else float(a), float(b), float(2 * a - b + rng.normal()), float(i % 4)))
    df = spark.createDataFrame(rows, "f0 double, f1 double, y double, w double")
    alphas = [0.0, 0.1, 1.0, 10.0, 100.0, 1e3, 1e4, 1e5, 1e6, 1e7]
    fitted = m.ridge_grid(df, ["f0", "f1"], alphas, target="y", weight="w")
    x = np.array([[r[0], r[1]] for r in rows], dtype=float)
    x[np.isnan(x[:, 0]), 0] = fitted[0].medians[0]
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    y, w = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    zc, yc = z - (w @ z) / w.sum(), y - (w @ y) / w.sum()
    for alpha, model in zip(alphas, fitted):
        want = np.linalg.solve((zc * w[:, None]).T @ zc + alpha * np.eye(2), (zc * w[:, None]).T @ yc)
        assert np.allclose(model.coefficients, want, rtol=1e-9, atol=1e-9)
        got = np.array([r[0] for r in model.predict(df, "p").select("p").collect()])
        assert np.allclose(got, (w @ y) / w.sum() + zc @ want, rtol=1e-9, atol=1e-9)


def test_medians_are_taken_once_per_fold(learnable, monkeypatch):
    folds = splits.purged_kfold(learnable, 2, 1, 1, min_train_dates=2)
    calls, plain = [], models.fit_medians
    monkeypatch.setattr(models, "fit_medians", lambda *a: calls.append(a) or plain(*a))
    score = models.fold_score(learnable, folds, FEATURES)
    numbers = models.fold_numbers(folds)
    first = [score({**FAST, "max_depth": 2}, k) for k in numbers]
    assert [score({**FAST, "max_depth": 2}, k) for k in numbers] == first and len(calls) == len(numbers) > 0


def test_sampled_sides_are_written_once(learnable, monkeypatch):
    calls, plain = [], models.written
    monkeypatch.setattr(models, "written", lambda df, name: calls.append((name, df.columns)) or plain(df, name))
    train, val = learnable.where("date_id < 15"), learnable.where("date_id >= 15")
    done = models.gbt_holdout(train, val, FEATURES, FAST, train_fraction=0.5, key="symbol_id")
    assert [n for n, _ in calls] == ["train"] and "responder_3" not in calls[0][1]
    assert 0 < done.record["train_rows"] < train.count()


def test_tasks_of_a_fit_read_little(spark, learnable, monkeypatch):
    seen, plain, name = [], models.regressor, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)

    class Spy:
        def __init__(self, *args):
            self.model = plain(*args)

        def fit(self, table):
            seen.append(int(spark.conf.get(name).rstrip("b")))
            return self.model.fit(table)

    monkeypatch.setattr(models, "regressor", Spy)
    models.fit(learnable, FEATURES, FAST)
    spark.conf.set(name, 1 << 20)
    try:
        models.fit(learnable, FEATURES, FAST)
    finally:
        spark.conf.set(name, before)
    assert seen == [16 << 20, 1 << 20] and spark.conf.get(name) == before


def _partitioned(spark):
    """Partitions -1 to 3, of which 2 has no target, and rows without a partition."""
    rows = [
        (v, 10 * (v or 0) + i % 5, i % 3, i, float(i % 7), None if v == 2 else (i % 7) * 0.01 + (i % 2) * 0.001, 1.0 + i % 2)
        for v, n in ((-1, 40), (0, 50), (1, 60), (2, 30), (3, 70), (None, 20))
        for i in range(n)
    ]
    names = "partition_id int, date_id int, time_id int, symbol_id int, feature_00 double, responder_6 double, weight double"
    return spark.createDataFrame(rows, names)


def test_backtest_validates_every_partition_after_the_first(spark):
    df = _partitioned(spark)
    trees = models.partition_backtest(df, None, None, ["feature_00"], FAST, reference_rows=100, floor_min_leaf=1)
    assert [(r["val_partition"], r["train_rows"], r["val_rows"]) for r in trees] == [(0, 40, 50), (1, 90, 60), (3, 150, 70)]
    assert [r["best_iteration"] for r in trees] == [3, 3, 3] and [r["min_data_in_leaf"] for r in trees] == [3, 5, 6]
    linear = models.ridge_backtest(df, None, None, ["feature_00"], 1.0, 100)
    assert [(r["val_partition"], r["train_rows"]) for r in linear] == [(0, 40), (1, 90), (3, 150)]
    assert [r["val_partition"] for r in models.ridge_backtest(df, 1, 2, ["feature_00"], 1.0, 100)] == [1]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_backtest_query_runs_the_full_sizes(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "panel"), []
    extra = {"time_id": F.col("symbol_id") % 4, "feature_01": F.col("feature_00") * 0.5 + F.col("symbol_id") % 3, "prediction": F.lit(0.0)}
    _partitioned(spark).withColumns(extra).where("partition_id < 2").write.partitionBy("partition_id").parquet(path)
    monkeypatch.setattr(catalog_models, "stored_panel", lambda *a: path)

    def holdout(train, val, features, params, **options):
        seen.append((val.first()["partition_id"], train.count(), params))
        return models.Holdout(None, {"train_rows": train.count(), "val_r2": 0.0})

    monkeypatch.setattr(models, "gbt_holdout", holdout)
    out = catalog_models.backtest_records(spark, "").collect()
    assert sorted((r["model"], r["val_partition"]) for r in out) == [("ridge", 0), ("ridge", 1), ("trees", 0), ("trees", 1)]
    assert sorted(s[:2] for s in seen) == [(0, 40), (1, 90)]
    sizes = ("n_estimators", "max_depth", "num_leaves", "learning_rate", "feature_fraction")
    assert all(p[k] == models.FINAL_PARAMS[k] for _, _, p in seen for k in sizes)


def test_search_query_runs_all_trials_of_every_set_up(spark, monkeypatch):
    df = spark.range(900).selectExpr("cast(id div 2 as int) as date_id", "cast(id as double) as responder_6", "1.0d as weight")
    asked = []

    def fold_score(df, folds, features):
        return lambda params, fold: asked.append((fold, params)) or params["learning_rate"] + fold

    monkeypatch.setattr(catalog_models, "_panel", lambda *a: df)
    monkeypatch.setattr(models, "fold_score", fold_score)
    records = catalog_models.random_search(spark, "").collect()
    assert {m: sum(r["model"] == m for r in records) for m in models.SPACES} == dict.fromkeys(models.SPACES, 100)
    assert len(asked) == 2 * 3 * 100 and {f for f, _ in asked} == {1, 2}
    assert all(p["n_estimators"] == 500 for _, p in asked)
    depths = [r["depth"] for r in records if r["model"] == "symmetric"]
    assert (min(depths), max(depths)) == (4, 10)


def test_trials_side_by_side_give_the_same_records(spark, learnable):
    asked = []

    def score(params, fold):
        asked.append(fold)
        return -params["max_depth"] + 0.01 * fold

    found = []
    for like in (None, learnable):
        search = models.RandomSearch(models.SPACES["depthwise"], 30, seed=1)
        found.append((search.run(range(4), score, like), search.records, sorted(asked)))
        asked.clear()
    assert found[0] == found[1] and any(r["stopped"] for r in found[0][1]) and len(found[0][2]) < 4 * 30


def test_search_boosts_while_the_loss_falls(spark, monkeypatch):
    """Also if the target is so small that Spark's own tolerance would end boosting at once."""
    rounds, plain = [], models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **k: rounds.append(plain(*a, **k)) or rounds[-1])
    df = spark.range(1200).selectExpr(
        "cast(id div 20 as int) as date_id", "cast(id % 20 as double) as feature_00", "sin(id % 20) * 0.02 as responder_6", "1.0d as weight"
    )
    folds = splits.purged_kfold(df, 2, 1, 1, min_train_dates=2)
    score = models.fold_score(df, folds, ["feature_00"])
    params = {"n_estimators": 12, "learning_rate": 0.1, "max_depth": 2}
    assert all(score(params, k) is not None for k in models.fold_numbers(folds))
    assert [m.rounds for m in rounds] == [12]
