"""Predictions of many grid points from few fits.

Points that differ only in what a model can answer afterwards form a family:

* nearest neighbours: one list of the most neighbours holds all shorter ones, and both weightings vote on it;
* boosting: the margins after 100 rounds lie on the way to those after 300;
* forests: trees are independent, so the forest of 300 is that of 200 and a hundred more, their votes added up.

Everything else is a family of one. Held-out rows are read once per family: each gets an array with the class predicted
at every point, and only confusion counts per point leave the tasks.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions.columns import col
from siftwork.operators.classify import RAW, Classifier, classes_of
from siftwork.operators.metrics import classification_metrics, confusion_counts

# What one fit answers for all its values.
SHARED = {"knn": ("n_neighbors", "weights"), "xgboost": ("n_estimators",), "random_forest": ("n_estimators",)}
# Seeds of the slices of a forest lie this far apart, so that their rows are drawn independently in every partition.
SEED_STEP = 1_000_003
CODES, VOTES, STAGES, POINT = "__codes", "__votes", "__stages", "__point"


def families(model: str, points: Sequence[dict]) -> list[list[int]]:
    """Positions of the points that share a fit, in order of their first point."""
    shared = SHARED.get(model, ())
    found: dict[str, list[int]] = {}
    for i, point in enumerate(points):
        rest = {k: v for k, v in point.items() if k not in shared}
        found.setdefault(json.dumps(rest, sort_keys=True), []).append(i)
    return list(found.values())


def staged_predictions(estimator: Classifier, points: Sequence[dict], train: DataFrame, held: DataFrame) -> DataFrame:
    """``held`` with ``__stages``: the classes predicted at the points of one family after fitting on ``train``."""
    model = estimator.option("model")
    full = [{**estimator.option("params"), **p} for p in points]
    if len(points) == 1 or model not in SHARED:
        scored = [estimator.with_params(**p).fit(train) for p in points]
        if len(scored) > 1:
            raise ValueError(f"points of {model} share no fit")
        return scored[0].transform(held).withColumn(STAGES, F.array("prediction")).drop("prediction", "probability")
    if model == "random_forest":
        return _forests(estimator, full, train, held)
    if model == "knn":
        fitted = estimator.with_params(**{**full[0], "n_neighbors": max(p["n_neighbors"] for p in full)}).fit(train)
    else:
        fitted = estimator.with_params(**{**full[0], "n_estimators": max(p["n_estimators"] for p in full)}).fit(train)
    *before, core, _ = fitted.stages
    ready = held
    for stage in before:
        ready = stage.transform(ready)
    if model == "knn":
        coded = core.staged(ready, [(p["n_neighbors"], p["weights"]) for p in full], CODES)
    else:
        coded = core.staged(ready, [p["n_estimators"] for p in full], CODES)
    return _named(coded, classes_of(fitted), held.columns)


def _named(coded: DataFrame, classes: Sequence, kept: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in classes])
    stages = F.transform(CODES, lambda c: F.try_element_at(names, c + 1)).alias(STAGES)
    return coded.select(*[col(c) for c in kept], stages)


def _forests(estimator: Classifier, full: Sequence[dict], train: DataFrame, held: DataFrame) -> DataFrame:
    """Votes of slices of trees, added up: the first slice is the smallest forest, each further one what the next adds."""
    sizes = sorted({p["n_estimators"] for p in full})
    options = json.loads(estimator.getOrDefault("options"))
    scored, total, at = held, None, {}
    for number, (low, high) in enumerate(zip([0, *sizes], sizes)):
        params = {**options["params"], **full[0], "n_estimators": high - low}
        seeded = {**options, "params": params, "seed": options["seed"] + number * SEED_STEP}
        fitted = estimator.copy({estimator.options: json.dumps(seeded)}).fit(train)
        *before, core, _ = fitted.stages
        ready = scored
        for stage in before:
            ready = stage.transform(ready)
        raw = vector_to_array(F.col(RAW))
        votes = raw if total is None else F.zip_with(F.col(total), raw, lambda a, b: a + b)
        total = at[high] = f"{VOTES}_{high}"
        earlier = [c for c in at.values() if c != total]
        scored = core.transform(ready).select(*[col(c) for c in held.columns], *earlier, votes.alias(total))
    codes = F.transform(F.array(*[F.col(at[p["n_estimators"]]) for p in full]), first_largest)
    return _named(scored.withColumn(CODES, codes), classes_of(fitted), held.columns)


def first_largest(scores: Column) -> Column:
    """Position of the largest of an array, the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def staged_scores(estimator: Classifier, points: Sequence[dict], train: DataFrame, held: DataFrame) -> list[float]:
    """Macro F1 on the held-out rows at every point of a family."""
    label = estimator.option("label")
    staged = staged_predictions(estimator, points, train, held)
    long = staged.select(col(label).alias("actual"), F.posexplode(STAGES).alias(POINT, "predicted"))
    scores = classification_metrics(confusion_counts(long, "actual", "predicted", [POINT]), [POINT])
    found = {r[POINT]: r["f1_macro"] for r in scores.select(POINT, "f1_macro").collect()}
    # No held-out row, no score.
    return [found.get(i, 0.0) for i in range(len(points))]
