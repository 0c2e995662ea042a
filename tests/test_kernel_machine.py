"""The kernel machine against Spark's linear machine on the stored features."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.linalg import Vectors

from siftwork.operators import classify, kernel_machine as km
from siftwork.operators.nystroem import NystroemFeatures


@pytest.mark.parametrize("classes", [2, 3])
def test_reaches_the_value_of_the_linear_machine(spark, classes):
    """Same objective, solved on features that are made anew in each pass; not worse than Spark's by a thousandth."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (0 if classes == 2 else (x[:, 0] > 1.0).astype(int))
    w = 1.0 + (y == 1)
    df = spark.createDataFrame([(i, Vectors.dense(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w))], ["i", "__features", "y", "w"]).repartition(3)
    features = NystroemFeatures(size=60, gamma=0.5).fit(df)
    z = np.array([r["__kernel"].toArray() for r in sorted(features.transform(df).collect(), key=lambda r: r["i"])])
    model = km.fit_machines(df, "y", "w", classes, features, 1e-3, 100)
    rows = sorted(model.transform(df).collect(), key=lambda r: r["i"])
    margins = np.array([r["rawPrediction"].toArray() for r in rows])
    assert [r["prediction"] for r in rows] == margins.argmax(axis=1).tolist()
    rest = OneVsRest(classifier=LinearSVC(maxIter=100, regParam=1e-3, standardization=False, weightCol="w"), featuresCol="__kernel", labelCol="y", weightCol="w")
    theirs = rest.fit(features.transform(df)).models

    def value(c, beta, margin):
        side = np.where(y == c, 1.0, -1.0)
        return (w * np.maximum(0, 1 - side * margin)).sum() / w.sum() + 1e-3 / 2 * beta @ beta

    for c in range(classes):
        beta = np.linalg.lstsq(z, margins[:, c] - model.values["free"][c], rcond=None)[0]
        other = theirs[c].coefficients.toArray()
        assert value(c, beta, margins[:, c]) <= value(c, other, z @ other + theirs[c].intercept) * 1.001


def test_no_features_are_written(spark, monkeypatch):
    """What is staged while the kernel machine learns is no wider than the rows themselves."""
    names, kept = [], classify.stage
    monkeypatch.setattr(classify, "stage", lambda df, name="staged": names.append((name, df.columns)) or kept(df, name))
    rng = np.random.default_rng(8)
    data = [(i, float(a), float(b), "ny"[int(a * b > 0)]) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(data, "code int, a double, b double, y string")
    model = classify.Classifier("svm", ["a", "b"], "y", "code", components=40, max_iter=30).fit(df)
    assert not any(classify.KERNEL in columns for _, columns in names)
    scored = model.transform(df)
    assert classify.KERNEL not in scored.columns and scored.where("prediction = y").count() > 270
    assert model.transform(df.where("code < 0")).collect() == []
