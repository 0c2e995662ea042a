import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.catalog.base import NUMBERS
from siftwork.catalog.models import scaled_orders
from siftwork.operators.classify import DEFAULTS, GRIDS, Classifier
from siftwork.operators.fourier import FourierFeatures
from siftwork.operators.train import TrainedModel, grid_points, grid_search

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def orders(spark):
    df = scaled_orders(spark, SF).withColumn(
        "xor", F.when((F.col("avg_qty") > 0) != (F.col("c_acctbal") > 0), "y").otherwise("n")
    )
    parts = {s: df.where(F.col("split_group") == s).drop("split_group").cache() for s in ("train", "val")}
    return parts["train"], parts["val"]


def score(orders, model, label="grade", **params):
    train, val = orders
    trained = TrainedModel(Classifier(model, NUMBERS, label, "code", **params))
    trained.train(train, folds=0)
    return trained, trained.evaluate(val, "validation")["f1_macro"]


@pytest.fixture(scope="module")
def logistic(orders):
    return score(orders, "logistic_regression")


def test_trees_beat_the_linear_model_on_thresholds(orders, logistic):
    _, forest = score(orders, "random_forest", n_estimators=40, max_depth=10)
    _, boosted = score(orders, "xgboost", n_estimators=10, max_depth=4, learning_rate=0.3)
    assert forest >= 0.90 and boosted >= 0.85
    assert min(forest, boosted) > logistic[1]


def test_fourier_features_learn_what_lines_cannot(orders):
    _, linear = score(orders, "logistic_regression", "xor")
    _, kernel = score(orders, "svm", "xor", components=200, max_iter=40)
    assert kernel >= 0.85 > linear


def test_logistic_matches_newton_steps(spark):
    """Two classes: compare with Newton steps on C·sum(loss) + |w|²/2."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 2))
    y = (x @ [1.5, -1.0] + draw.logistic(size=300) > 0).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), "ny"[int(t)]) for i, ((a, b), t) in enumerate(zip(x, y))], "code int, a double, b double, y string")
    model = Classifier("logistic_regression", ["a", "b"], "y", class_weight=None, C=0.1).fit(df)
    got = np.array([r["probability"][1] for r in model.transform(df).orderBy("code").collect()])
    w, ones = np.zeros(3), np.c_[x, np.ones(300)]
    ridge = np.diag([1 / 0.1, 1 / 0.1, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-ones @ w))
        w -= np.linalg.solve(ones.T @ (ones * (p * (1 - p))[:, None]) + ridge, ones.T @ (p - y) + ridge @ w)
    np.testing.assert_allclose(got, 1 / (1 + np.exp(-ones @ w)), atol=2e-3)


def test_fourier_products_approximate_the_kernel(spark):
    from pyspark.ml.linalg import Vectors

    x = np.random.default_rng(1).normal(size=(20, 3))
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["i", "__features"])
    model = FourierFeatures(size=4000, gamma=0.3).fit(df)
    z = np.array([r["__fourier"].toArray() for r in model.transform(df).orderBy("i").collect()])
    kernel = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.08


def test_record_save_and_load(spark, orders, logistic, tmp_path):
    train, val = orders
    trained, f1 = logistic
    path = str(tmp_path / "run")
    trained.history["val_metrics"] = trained.evaluate(val, "validation")
    trained.save(path, spark)
    again = TrainedModel.load(path, spark)
    assert again.history["val_metrics"] == trained.history["val_metrics"]
    assert again.evaluate(val)["f1_macro"] == pytest.approx(f1)
    assert again.history["test_metrics"] and trained.history["test_metrics"] == {}
    columns = ["code", "prediction"]
    assert again.predict(val).select(columns).exceptAll(trained.predict(val).select(columns)).count() == 0
    first = again.predict(val).select("probability").first()["probability"]
    assert len(first) == 5 and sum(first) == pytest.approx(1.0)
    assert again.matrix(val).count() == 5 and again.report(val).count() == 8
    with pytest.raises(FileNotFoundError):
        TrainedModel.load(str(tmp_path / "nothing"), spark)


def test_untrained_and_unknown(spark):
    with pytest.raises(ValueError, match="before using it"):
        TrainedModel(Classifier("svm")).predict(spark.range(1))
    with pytest.raises(ValueError, match="before using it"):
        TrainedModel(Classifier("svm")).save("/tmp/never", spark)
    with pytest.raises(ValueError, match="unknown model"):
        Classifier("perceptron")
    with pytest.raises(ValueError, match="unknown parameters"):
        Classifier("knn", depth=3)


def test_folds_and_gap(spark, orders):
    train, val = orders
    trained = TrainedModel(Classifier("logistic_regression", NUMBERS, "grade", "code", max_iter=20))
    trained.train(train, val, folds=3)
    cv = trained.history["cv_scores"]
    assert cv["folds"] == 3 and cv["mean"] == pytest.approx(np.mean(cv["scores"])) and cv["std"] == pytest.approx(np.std(cv["scores"]))
    assert trained.history["training_time"] > 0
    assert trained.gap()[1] is False


def test_grid_search(spark, orders):
    train = orders[0].limit(2000).cache()
    found = grid_search(train, Classifier("logistic_regression", None, "grade", exclude=["xor"], max_iter=15), {"C": [1e-4, 1.0]}, "code", 2)
    assert found.best_params == {"C": 1.0} and len(found.table) == 2
    assert found.best_score == pytest.approx(max(s for _, s in found.table))
    assert "__fold" not in str(found.fitted.stages[0].values) and "code" not in found.fitted.stages[0].values["columns"]


def test_grids_are_complete():
    assert {m: len(grid_points(g)) for m, g in GRIDS.items()} == {
        "logistic_regression": 4, "knn": 30, "svm": 6, "random_forest": 108, "xgboost": 54
    }
    for model, grid in GRIDS.items():
        assert set(grid) <= set(DEFAULTS[model])
