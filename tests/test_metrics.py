import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.operators.compare import accuracy_long, best_run, efficiency, fold_scores, gap_table
from siftwork.operators.explore import (
    box_stats,
    flag_distribution,
    histogram,
    kernel_density,
    spearman,
    top_categories_by_class,
)
from siftwork.operators import explore
from siftwork.operators.metrics import (
    balanced_weights,
    classification_metrics,
    classification_report,
    confusion_counts,
    confusion_matrix,
    evaluate,
    generalisation_gap,
)

PAIRS = [("a", "a"), ("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("b", "d")]


@pytest.fixture(scope="module")
def judged(spark):
    return spark.createDataFrame(PAIRS, "y string, p string")


def by_hand():
    classes = sorted({x for pair in PAIRS for x in pair})
    scores = []
    for c in classes:
        tp = sum(y == p == c for y, p in PAIRS)
        support, said = sum(y == c for y, _ in PAIRS), sum(p == c for _, p in PAIRS)
        scores.append(
            (c, tp / said if said else 0, tp / support if support else 0, 2 * tp / (said + support), support)
        )
    return scores


def test_metrics_against_hand_count(judged):
    got, scores = evaluate(judged, "y", "p").collect()[0], by_hand()
    assert math.isclose(got["accuracy"], 0.5)
    for i, name in enumerate(("precision", "recall", "f1"), 1):
        assert math.isclose(got[f"{name}_macro"], sum(s[i] for s in scores) / 4)
        assert math.isclose(got[f"{name}_weighted"], sum(s[i] * s[4] for s in scores) / 6)
    assert math.isclose(got["recall_weighted"], got["accuracy"])


def test_never_predicted_and_never_seen(judged):
    rows = {r["name"]: r for r in classification_report(confusion_counts(judged, "y", "p")).collect()}
    assert rows["c"]["precision"] == 0 and rows["d"]["recall"] == 0 and rows["d"]["support"] == 0
    assert rows["accuracy"]["support"] == 6 and rows["accuracy"]["precision"] is None


def test_confusion_keeps_absent_classes(judged):
    rows = confusion_matrix(confusion_counts(judged, "y", "p"), list("abcde")).collect()
    assert [r["actual"] for r in rows] == list("abcde")
    assert [tuple(r)[1:] for r in rows] == [(2, 1, 0, 0, 0), (0, 1, 0, 1, 0), (0, 1, 0, 0, 0), (0,) * 5, (0,) * 5]


def test_grouped_metrics(spark):
    df = spark.createDataFrame([("m", y, p) for y, p in PAIRS] + [("n", "a", "a")], "g string, y string, p string")
    got = {r["g"]: r for r in classification_metrics(confusion_counts(df, "y", "p", ["g"]), ["g"]).collect()}
    assert math.isclose(got["m"]["f1_macro"], sum(s[3] for s in by_hand()) / 4)
    assert got["n"]["f1_macro"] == 1.0


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "y string")
    got = {r["y"]: r["class_weight"] for r in balanced_weights(df, "y").collect()}
    assert got == {"a": 4 / 6, "b": 2.0, None: None}


def test_gap(spark):
    df = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.9, 0.86)], "m string, t double, v double")
    assert [r["overfit"] for r in generalisation_gap(df, "t", "v").orderBy("m").collect()] == [True, False]


def test_run_tables(spark):
    rows = [("x", 0.9, 0.7, 0.5, [0.1, 0.2], 2.0), ("y", 0.8, 0.75, 0.9, None, 0.0), ("z", None, None, None, [], 1.0)]
    schema = "model string, train_accuracy double, val_accuracy double, f1_macro double, cv_scores array<double>, training_time double"
    runs = spark.createDataFrame(rows, schema)
    assert [(r["model"], r["fold"]) for r in fold_scores(runs).collect()] == [("x", 1), ("x", 2)]
    assert [r["model"] for r in gap_table(runs).collect()] == ["x", "y", "z"]
    assert [r["f1_per_second"] for r in efficiency(runs).collect()] == [0.25, None, None]
    assert best_run(runs, ["model"]).collect()[0][0] == "y"
    assert {r["dataset"] for r in accuracy_long(runs).collect()} == {"Train", "Validation"}


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in values] + [(None, 7.0)], "g string, v double")
    got = {r["g"]: r for r in box_stats(df, ["v"], "g").collect()}
    assert (got["g"]["q1"], got["g"]["median"], got["g"]["q3"]) == (2.0, 3.0, 4.0)
    assert (got["g"]["whisker_low"], got["g"]["whisker_high"], got["g"]["outliers"]) == (1.0, 4.0, 1)
    assert got[None]["median"] == 7.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 9, 10]] + [(None,)], "v double")
    assert [r["rows"] for r in histogram(df, "v", 5).orderBy("bin").collect()] == [3, 0, 0, 0, 2]
    assert sum(r["rows"] for r in histogram(df.where("v = 9"), "v", 5).collect()) == 1
    assert histogram(df.where("v is null"), "v").count() == 0


def test_density_integrates_to_most_of_one(spark):
    df = spark.range(2000).select(F.randn(3).alias("v"))
    rows = kernel_density(df, "v", 100).orderBy("point").collect()
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.97 < sum(r["density"] for r in rows) * step < 1.01


def test_density_equals_the_whole_sum(spark):
    """Hot values, missing ones, a gap wider than the reach and a value far away."""
    values = [float(i % 50) / 7 for i in range(3000)] + [2.0] * 500 + [400.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    x = np.array(values)
    width = x.std(ddof=1) * len(x) ** -0.2
    rows = kernel_density(df, "v", 60).orderBy("point").collect()
    assert [r["point"] for r in rows] == list(range(60))
    for r in rows:
        whole = np.exp(-0.5 * ((x - r["x"]) / width) ** 2).sum() / (len(x) * width * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(whole, rel=1e-9, abs=1e-17)


@pytest.mark.parametrize("bucket_rows", [200_000, 50])
def test_spearman_matches_ranks(spark, monkeypatch, bucket_rows):
    """Ties, one value on half of the rows, and different missing cells per column."""
    monkeypatch.setattr(explore, "RANK_BUCKET_ROWS", bucket_rows)
    df = spark.range(3000).select(
        "id",
        F.round(F.rand(1) * 40).alias("ties"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.rand(2)).alias("hot"),
        F.when(F.rand(3) > 0.3, F.rand(4) + F.col("id") / 3000).alias("gaps"),
        F.when(F.rand(5) > 0.2, F.col("id").cast("double")).alias("holes"),
        F.lit(1.0).alias("same"),
    ).cache()
    pdf = df.toPandas()
    got = {(r["column_a"], r["column_b"]): r["rho"] for r in spearman(df, ["ties", "hot", "gaps", "holes", "same"]).collect()}
    assert len(got) == 10
    for (a, b), rho in got.items():
        if "same" in (a, b):
            assert rho is None
        else:
            both = pdf[[a, b]].dropna().rank()
            assert math.isclose(rho, both[a].corr(both[b]), abs_tol=1e-9)


def test_flags_and_top_categories(spark):
    df = spark.createDataFrame([(1, "x", "a"), (1, "y", "a"), (1, "x", "b"), (1, None, "b")], "f int, c string, y string")
    assert [tuple(r) for r in flag_distribution(df, ["f"]).collect()] == [("f", 0, 0), ("f", 1, 4)]
    assert [tuple(r) for r in top_categories_by_class(df, "c", "y", ["a", "b"], 1).collect()] == [("x", 1, 1, 2)]
