import pytest
from pyspark.sql import functions as F

from siftwork.operators.classify import Classifier
from siftwork.operators.metrics import evaluate
from siftwork.operators.split import assign_folds
from siftwork.operators.staged import STAGES, families, staged_predictions, staged_scores
from siftwork.operators.train import grid_points, grid_search
from siftwork.sources.shared import stage

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Two thresholds and noise: three classes, ties between equal rows, cells that are missing nowhere."""
    df = spark.range(900).select(
        "id",
        F.round(F.rand(1) * 4, 1).alias("a"),
        F.round(F.rand(2) * 4, 1).alias("b"),
        F.round(F.rand(3), 1).alias("c"),
        F.rand(4).alias("noise"),
    )
    label = F.when(F.col("noise") < 0.1, "z").when(F.col("a") > 2, "x").when(F.col("b") > 2, "y").otherwise("z")
    return stage(df.withColumn("label", label).drop("noise"))


def held_out(rows):
    return rows.where("id % 3 > 0"), rows.where("id % 3 = 0")


def separately(estimator, points, train, held):
    """A fit of its own for every point."""
    models = [estimator.with_params(**p).fit(train) for p in points]
    return [evaluate(m.transform(held), "label", "prediction").first()["f1_macro"] for m in models]


def test_families():
    points = grid_points({"n_neighbors": [5, 10], "weights": ["uniform", "distance"], "metric": ["euclidean", "manhattan"]})
    assert [len(f) for f in families("knn", points)] == [4, 4]
    points = grid_points({"n_estimators": [10, 20], "max_depth": [3, 6]})
    found = families("xgboost", points)
    assert sorted(map(len, found)) == [2, 2] and sorted(sum(found, [])) == [0, 1, 2, 3]
    assert families("logistic_regression", [{"C": 1.0}, {"C": 2.0}]) == [[0], [1]]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_one_list_of_neighbours_answers_all_points(rows, metric):
    train, held = held_out(rows)
    points = grid_points({"n_neighbors": [1, 4, 9], "weights": ["uniform", "distance"], "metric": [metric]})
    estimator = Classifier("knn", FEATURES, "label", "id")
    assert staged_scores(estimator, points, train, held) == pytest.approx(separately(estimator, points, train, held), rel=1e-12)


def test_margins_on_the_way_are_those_of_fewer_rounds(rows):
    train, held = held_out(rows)
    points = [{"n_estimators": n, "max_depth": 2} for n in (4, 1, 2)]
    estimator = Classifier("xgboost", FEATURES, "label", "id")
    assert staged_scores(estimator, points, train, held) == pytest.approx(separately(estimator, points, train, held), rel=1e-12)


def test_forests_grow_by_slices(rows):
    """The smallest forest is the separate one; larger ones lie as close to theirs as other seeds do."""
    train, held = held_out(rows)
    points = [{"n_estimators": n, "max_depth": 6} for n in (60, 20)]
    estimator = Classifier("random_forest", FEATURES, "label", "id")
    large, small = staged_scores(estimator, points, train, held)
    alone_large, alone_small = separately(estimator, points, train, held)
    assert small == pytest.approx(alone_small, rel=1e-12)
    assert large == pytest.approx(alone_large, abs=0.03)


def test_rows_keep_their_columns(rows):
    train, held = held_out(rows)
    for model, points in {
        "knn": [{"n_neighbors": 3}, {"n_neighbors": 5}],
        "random_forest": [{"n_estimators": 2}, {"n_estimators": 3}],
        "logistic_regression": [{"C": 1.0}],
    }.items():
        out = staged_predictions(Classifier(model, FEATURES, "label", "id"), points, train, held)
        assert out.columns == [*held.columns, STAGES]
        assert out.where(F.size(STAGES) != len(points)).count() == 0 and out.count() == held.count()
    with pytest.raises(ValueError, match="share no fit"):
        staged_predictions(Classifier("logistic_regression", FEATURES, "label"), [{"C": 1.0}, {"C": 2.0}], train, held)


def test_search_equals_separate_fits_and_fits_less(rows, monkeypatch):
    fits = []
    plain = Classifier._fit
    monkeypatch.setattr(Classifier, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    grid = {"n_neighbors": [2, 7], "weights": ["uniform", "distance"], "metric": ["minkowski", "euclidean", "manhattan"]}
    estimator = Classifier("knn", FEATURES, "label", "id")
    found = grid_search(rows, estimator, grid, "id", folds=3)
    # Two families, three folds, and the best on all rows.
    assert len(fits) == 2 * 3 + 1 and len(found.table) == 12
    folded = stage(assign_folds(rows, "label", "id", 3, out="f"))
    for params, mean in found.table[::5]:
        alone = [
            separately(estimator, [params], folded.where(F.col("f") != i).drop("f"), folded.where(F.col("f") == i).drop("f"))[0]
            for i in range(3)
        ]
        assert mean == pytest.approx(sum(alone) / 3)
    assert found.best_params == max(found.table, key=lambda t: t[1])[0]
