import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.operators import quantiles
from siftwork.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def numbers(spark):
    """Skewed numbers, a column where one value holds a third of the rows, and missing cells."""
    df = spark.range(20000).select(
        "id",
        F.pow(F.rand(7) * 10, 4).alias("skewed"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.round(F.rand(8) * 20, 1)).alias("hot"),
        F.when(F.col("id") % 4 == 0, F.rand(9)).alias("gaps"),
        F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("g"),
    )
    return df.cache()


def expected(pdf, column):
    values = pdf[column].dropna()
    return np.quantile(values, PROBS)


@pytest.mark.parametrize("path", ["one pass", "refined", "refined many times"])
def test_matches_sorted_quantiles(spark, numbers, monkeypatch, path):
    if path != "one pass":
        monkeypatch.setattr(quantiles, "SMALL_ROWS", 0)
    if path == "refined many times":
        monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 50)
        monkeypatch.setattr(quantiles, "GRID", 10)
        monkeypatch.setattr(quantiles, "MAX_COLLECTED_VALUES", 60)
    columns = ["skewed", "hot", "gaps"]
    pdf = numbers.toPandas()
    got = exact_quantiles(numbers, columns, PROBS)[()]
    for c in columns:
        np.testing.assert_allclose(got[c], expected(pdf, c), rtol=1e-12)
    grouped = exact_quantiles(numbers, columns, PROBS, by=["g"])
    assert set(grouped) == {(None,), ("0",), ("1",), ("2",)}
    for (g,), found in grouped.items():
        part = pdf[pdf.g.isna()] if g is None else pdf[pdf.g == g]
        for c in columns:
            np.testing.assert_allclose(found[c], expected(part, c), rtol=1e-12)


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_empty_constant_and_single(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL_ROWS", small)
    df = spark.createDataFrame([(None, 2.0), (None, 2.0), (None, 2.0)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.25, 0.5])[()]
    assert got == {"a": [None, None], "b": [2.0, 2.0]}
    one = spark.createDataFrame([(3,)], "a int")
    assert exact_quantiles(one, ["a"], [0.0, 0.5, 1.0])[()] == {"a": [3.0, 3.0, 3.0]}


def test_too_many_groups_is_refused(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_GROUPS", 5)
    with pytest.raises(ValueError, match="groups"):
        exact_quantiles(spark.range(100), ["id"], [0.5], by=["id"])
