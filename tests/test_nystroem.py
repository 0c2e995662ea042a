import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from siftwork.operators.nystroem import NystroemFeatures, NystroemModel, kernel


def table(spark, x, parts=3):
    return spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["i", "__features"]).repartition(parts)


def mapped(model, df):
    rows = sorted(model.transform(df).collect(), key=lambda r: r["i"])
    return np.array([r["__kernel"].toArray() for r in rows])


def test_products_approximate_the_kernel(spark):
    x = np.random.default_rng(1).normal(size=(400, 3))
    z = mapped(NystroemFeatures(size=150, gamma=0.1).fit(table(spark, x)), table(spark, x))
    assert np.abs(z @ z.T - kernel(x, x, 0.1)).max() < 5e-3


def test_landmarks_are_exact_and_all_rows_give_the_kernel(spark):
    x = np.random.default_rng(2).normal(size=(60, 2))
    model = NystroemFeatures(size=500, gamma=0.7).fit(table(spark, x))
    assert len(model.values["landmarks"]) == 60
    z = mapped(model, table(spark, x))
    np.testing.assert_allclose(z @ z.T, kernel(x, x, 0.7), atol=1e-6)


def test_leverage_finds_what_is_rare(spark):
    """A few rows far from a dense cloud: drawn nearly always, for nothing else spans them."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(scale=0.05, size=(3000, 2)), np.array([[9.0, 9.0], [-9.0, 9.0], [9.0, -9.0]])])
    model = NystroemFeatures(size=40, gamma=1.0).fit(table(spark, x))
    z = mapped(model, table(spark, x))
    assert np.abs((z[-3:] ** 2).sum(axis=1) - 1).max() < 1e-6


def test_partitions_copies_and_reload(spark, tmp_path):
    x = np.random.default_rng(4).normal(size=(80, 2))
    copies = np.concatenate([x] + [x[:1]] * 400)
    one, two = (NystroemFeatures(size=30).fit(table(spark, copies, n)) for n in (1, 7))
    assert one.values["landmarks"] == two.values["landmarks"] and len({tuple(r) for r in one.values["landmarks"]}) == 30
    one.write().save(str(tmp_path / "m"))
    assert NystroemModel.load(str(tmp_path / "m")).values == one.values
    with pytest.raises(ValueError, match="no rows"):
        NystroemFeatures(gamma=1.0).fit(table(spark, x).where("i < 0"))


def test_products_with_other_points(spark):
    """Dot products come without the features: a number per other point leaves the task."""
    x = np.random.default_rng(5).normal(size=(90, 3))
    df = table(spark, x)
    model = NystroemFeatures(size=40, gamma=0.4).fit(df)
    z = mapped(model, df)
    found = model.products(df, x[:7], "products")
    assert found.columns == [*df.columns, "products"]
    got = np.array([r["products"] for r in sorted(found.collect(), key=lambda r: r["i"])])
    np.testing.assert_allclose(got, z @ z[:7].T, atol=1e-8)
    assert model.products(df.where("i < 0"), x[:7], "products").collect() == []
