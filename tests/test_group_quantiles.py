import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.operators import group_quantiles as module
from siftwork.operators.explore import box_stats
from siftwork.operators.group_quantiles import group_quantiles, joined_by_group
from siftwork.sources.shared import stage

PROBS = [0.0, 0.25, 0.5, 0.999]
COLUMNS = ["skewed", "hot", "gaps"]
PATHS = {
    "percentile": {},
    "brackets": {"GROUP_ROWS": 500},
    "many passes": {"GROUP_ROWS": 300, "ACCURACY": 50, "GRID": 20, "GROUP_VALUES": 1, "LEAST_VALUES": 20},
    "shuffled": {"GROUP_ROWS": 500, "FEW_GROUPS": 3, "HOT_GROUPS": 10},
}


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the rows in one group, a null key, groups of a few rows; hot values and missing cells."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 150).cast("string")).alias("g"),
        F.pow(F.rand(7) * 10, 4).alias("skewed"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.round(F.rand(8) * 20, 1)).alias("hot"),
        F.when((F.col("id") % 4 == 0) & (F.col("id") % 150 != 8), F.rand(9)).alias("gaps"),
    )
    return stage(df)


def patched(monkeypatch, path):
    for name, value in PATHS[path].items():
        monkeypatch.setattr(module, name, value)


@pytest.mark.parametrize("path", PATHS)
def test_matches_sorted_quantiles(numbers, monkeypatch, path):
    patched(monkeypatch, path)
    pdf = numbers.toPandas()
    got = {r["g"]: r for r in group_quantiles(numbers, COLUMNS, PROBS, ["g"]).collect()}
    parts = dict(list(pdf.groupby("g")))
    parts[None] = pdf[pdf.g.isna()]
    assert set(got) == set(parts)
    for g, part in parts.items():
        assert got[g]["__n"] == len(part)
        for i, c in enumerate(COLUMNS):
            values = part[c].dropna()
            if len(values):
                np.testing.assert_allclose(got[g][f"__q{i}"], np.quantile(values, PROBS), rtol=1e-12)
            else:
                assert got[g][f"__q{i}"] == [None] * len(PROBS)


@pytest.mark.parametrize("path", ["percentile", "shuffled"])
def test_box_stats_of_groups(numbers, monkeypatch, path):
    patched(monkeypatch, path)
    pdf = numbers.toPandas()
    for r in box_stats(numbers, ["skewed"], "g").collect():
        v = (pdf[pdf.g.isna()] if r["g"] is None else pdf[pdf.g == r["g"]]).skewed
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        want = [q1, q2, q3, inside.min(), inside.max(), len(v) - len(inside)]
        np.testing.assert_allclose([r[c] for c in ("q1", "median", "q3", "whisker_low", "whisker_high", "outliers")], want, rtol=1e-12)


@pytest.mark.parametrize("rows", [0, 100])
def test_empty_tables_and_constants(spark, monkeypatch, rows):
    monkeypatch.setattr(module, "GROUP_ROWS", 10)
    df = spark.range(rows).select(F.lit(1).alias("g h"), F.lit(2.0).alias("x.y"), F.lit(None).cast("double").alias("z"))
    got = group_quantiles(df, ["x.y", "z"], [0.5, 0.9], ["g h"]).collect()
    assert [tuple(r) for r in got] == ([(1, 100, [2.0, 2.0], [None, None])] if rows else [])
    assert box_stats(df, ["x.y"], "g h").count() == min(rows, 1)


def test_joins_keep_every_row_once(spark, numbers, monkeypatch):
    patched(monkeypatch, "shuffled")
    sizes = numbers.groupBy("g").agg(F.count(F.lit(1)).alias("__n"))
    got = joined_by_group(numbers, ["g"], sizes)
    assert got.count() == 6000
    assert got.select("g", "__n").distinct().exceptAll(sizes).count() == 0
