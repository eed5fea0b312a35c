import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import evaluation, ordering, training
from cohortkit.session import scratch_path
from cohortkit.sources import readers, writers


def _predictions(spark, rows):
    return evaluation.classify(spark.createDataFrame(rows, "patient_id int, y_true int, y_prob double"))


def test_metrics_of_a_known_confusion_matrix(spark):
    cells = [(0, 0.1, 227), (0, 0.9, 23), (1, 0.2, 22), (1, 0.5, 228)]
    rows = [(0, t, p) for t, p, n in cells for _ in range(n)]
    m = evaluation.classification_metrics(_predictions(spark, rows)).first()
    assert m["accuracy"] == 0.91
    assert m["precision"] == pytest.approx(0.9083665338645418)
    assert m["recall"] == pytest.approx(0.912)
    assert m["f1"] == pytest.approx(0.9101796407185628)
    counts = {(r["y_true"], r["y_pred"]): r["n"] for r in evaluation.confusion_matrix(_predictions(spark, rows)).collect()}
    assert counts == {(0, 0): 227, (0, 1): 23, (1, 0): 22, (1, 1): 228}


@pytest.mark.parametrize("buckets", [1, 8])
def test_curves_and_area_with_ties(spark, monkeypatch, buckets):
    original = ordering.running
    monkeypatch.setattr(evaluation, "running", lambda *a, **k: original(*a, **{**k, "buckets": buckets}))
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 300)
    p = np.round(np.clip(y * 0.3 + rng.random(300) * 0.7, 0, 1), 2)
    df = _predictions(spark, [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))])
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert evaluation.roc_auc(df).first()["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)))
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluation.roc_curve(df).collect()}
    assert len(points) == len(set(p)) + 1 and points[float("inf")] == (0.0, 0.0)
    for s in set(p):
        assert points[s] == pytest.approx(((neg >= s).mean(), (pos >= s).mean()))
    curve = {r["threshold"]: (r["recall"], r["precision"]) for r in evaluation.pr_curve(df).collect()}
    assert curve[float("inf")] == (0.0, 1.0)
    assert curve[min(p)] == pytest.approx((1.0, y.mean()))


def test_undefined_metrics(spark):
    m = evaluation.classification_metrics(_predictions(spark, [(1, 0, 0.1), (2, 0, 0.2)])).first()
    assert (m["precision"], m["recall"], m["f1"], m["roc_auc"]) == (0.0, 0.0, 0.0, None)


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 400)
    rows = [(i, float(y[i] + rng.normal() * 0.6), float(rng.normal()), int(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "patient_id bigint, bmi double, age double, diabetes int")
    grid = training.Grid(inverse_penalties=(0.1, 10.0), trees=(5,), depths=(None, 3))
    return df, training.train_best(df, ["bmi", "age"], grid=grid)


def test_best_model_is_the_better_one_on_held_out_rows(spark, trained):
    df, result = trained
    by_name = {c["model_name"]: c["roc_auc"] for c in result.comparisons}
    assert set(by_name) == {"logistic_regression", "random_forest"}
    assert result.metadata["best_score"] == max(by_name.values()) > 0.8
    predicted = result.predictions
    assert predicted.count() == 80
    assert {r["model_name"] for r in predicted.select("model_name").distinct().collect()} == {result.metadata["model_name"]}
    truth = {r["patient_id"]: r["diabetes"] for r in df.collect()}
    assert all(truth[r["patient_id"]] == r["y_true"] for r in predicted.collect())


def test_model_metadata_and_predictions_round_trip(spark, trained):
    df, result = trained
    path = scratch_path(spark, "model")
    training.save_model(spark, result, path)
    model, metadata = training.load_model(spark, path)
    assert metadata["feature_names"] == ["bmi", "age"] and metadata["n_features"] == 2
    again = training.score(model, df, metadata["feature_names"])
    direct = training.score(result.model, df, ["bmi", "age"])
    gap = again.join(direct.withColumnRenamed("y_prob", "other"), "patient_id").agg(F.max(F.abs(F.col("y_prob") - F.col("other"))))
    assert gap.first()[0] == 0
    with pytest.raises(ValueError, match="missing columns"):
        training.score(model, df.drop("age"), metadata["feature_names"])
    writers.save_predictions(result.predictions, f"{path}/predictions")
    assert readers.load_predictions(spark, f"{path}/predictions").count() == 80
    with pytest.raises(ValueError, match="y_pred"):
        writers.save_predictions(result.predictions.drop("y_pred"), f"{path}/bad")


def test_settings_of_one_depth_share_their_trees():
    settings = [{"numTrees": t, "maxDepth": d} for t in (200, 100) for d in (30, 10)]
    parts, consists = training.search_parts(settings)
    assert sorted((p["numTrees"], p["maxDepth"], p["block"]) for p in parts) == [(100, d, b) for d in (10, 30) for b in (0, 1)]
    for i, setting in enumerate(settings):
        assert sum(parts[k]["numTrees"] for k in consists[i]) == setting["numTrees"]
        assert {parts[k]["maxDepth"] for k in consists[i]} == {setting["maxDepth"]}
    assert training.search_parts([{"C": 1.0}, {"C": 2.0}]) == ([{"C": 1.0}, {"C": 2.0}], {0: [0], 1: [1]})


def test_a_search_over_shared_trees_finds_the_signal(spark, trained):
    df, _ = trained
    grid = training.Grid(trees=(4, 10), depths=(2, 4))
    result = training.train_best(df, ["bmi", "age"], grid=grid, candidates=("random_forest",), part_rows=150)
    assert result.comparisons[0]["cv_roc_auc"] > 0.85 and result.comparisons[0]["roc_auc"] > 0.85
    assert result.metadata["best_params"]["numTrees"] in (4, 10)


def test_metadata_checks():
    good = {k: 1 for k in training.METADATA_KEYS} | {"feature_names": ["a"], "metrics": {"roc_auc": 1}}
    training.validate_metadata(good)
    for broken in ({"n_features": 2}, {"metrics": {}}):
        with pytest.raises(ValueError):
            training.validate_metadata({**good, **broken})
    with pytest.raises(ValueError, match="model_name"):
        training.validate_metadata({k: v for k, v in good.items() if k != "model_name"})
