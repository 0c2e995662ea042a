"""Training with stratified folds, evaluation, tuning, and the record of a run."""

from __future__ import annotations

import itertools
import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from multiprocessing.pool import ThreadPool

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from siftwork.functions.columns import col, numeric_columns
from siftwork.operators.classify import MAX_TREE_DEPTH, NAMES, Classifier, classes_of
from siftwork.operators.metrics import GAP_LIMIT, classification_report, confusion_counts, confusion_matrix, evaluate
from siftwork.operators.split import assign_folds
from siftwork.operators.staged import families, staged_scores
from siftwork.sources.documents import write_document
from siftwork.sources.shared import stage

HISTORY_SCHEMA = (
    "model_name string, hyperparameters map<string,string>, "
    "training_history struct<train_metrics: map<string,double>, val_metrics: map<string,double>, "
    "test_metrics: map<string,double>, cv_scores: struct<scores: array<double>, mean: double, std: double, "
    "folds: bigint>, training_time: double, created_at: string, last_trained: string>, classes array<string>"
)


def scores_of(df: DataFrame, label: str, prediction: str = "prediction") -> dict[str, float]:
    return evaluate(df, label, prediction).collect()[0].asDict()


@dataclass
class TrainedModel:
    """A classifier, its fitted form and what happened in training."""

    estimator: Classifier
    fitted: PipelineModel | None = None
    history: dict = field(
        default_factory=lambda: {
            "train_metrics": {},
            "val_metrics": {},
            "test_metrics": {},
            "cv_scores": {},
            "training_time": None,
            "created_at": datetime.now().isoformat(),
            "last_trained": None,
        }
    )

    @property
    def name(self) -> str:
        return NAMES[self.estimator.option("model")]

    def _ready(self) -> PipelineModel:
        if self.fitted is None:
            raise ValueError(f"train {self.name} before using it")
        return self.fitted

    def train(self, train: DataFrame, val: DataFrame | None = None, folds: int = 5, key: str | None = None) -> dict:
        """Fold accuracy (a fresh model each), then one fit on everything; returns the train metrics.

        The time covers folds, the final fit and scoring the training rows.
        """
        label = self.estimator.option("label")
        key = key or self.estimator.option("key")
        started = time.monotonic()
        if folds > 1:
            if key is None:
                raise ValueError("folds need a key column")
            held = stage(assign_folds(train, label, key, folds, out="__fold"), "folds")
            accuracy = []
            for f in range(folds):
                # The fold column must not be taken for a feature.
                part = self.estimator.fit(held.where(F.col("__fold") != f).drop("__fold"))
                scored = part.transform(held.where(F.col("__fold") == f).drop("__fold"))
                accuracy.append(scores_of(scored, label)["accuracy"])
            self.history["cv_scores"] = {
                "scores": accuracy,
                "mean": float(np.mean(accuracy)),
                "std": float(np.std(accuracy)),
                "folds": folds,
            }
            train = held.drop("__fold")
        self.fitted = self.estimator.fit(train)
        metrics = {"accuracy": scores_of(self.fitted.transform(train), label)["accuracy"]}
        self.history["train_metrics"] = metrics
        self.history["training_time"] = time.monotonic() - started
        self.history["last_trained"] = datetime.now().isoformat()
        if val is not None:
            self.history["val_metrics"] = self.evaluate(val, "validation")
        return metrics

    def predict(self, df: DataFrame) -> DataFrame:
        return self._ready().transform(df)

    def evaluate(self, df: DataFrame, dataset: str = "test") -> dict[str, float]:
        metrics = scores_of(self.predict(df), self.estimator.option("label"))
        if dataset == "test":
            self.history["test_metrics"] = metrics
        return metrics

    def counts(self, df: DataFrame) -> DataFrame:
        return confusion_counts(self.predict(df), self.estimator.option("label"), "prediction")

    def report(self, df: DataFrame) -> DataFrame:
        return classification_report(self.counts(df))

    def matrix(self, df: DataFrame) -> DataFrame:
        return confusion_matrix(self.counts(df), classes_of(self._ready()))

    def gap(self) -> tuple[float, bool]:
        """Train minus validation accuracy, and whether it suggests overfitting."""
        gap = self.history["train_metrics"].get("accuracy", 0) - self.history["val_metrics"].get("accuracy", 0)
        return gap, gap > GAP_LIMIT

    def document(self, spark: SparkSession) -> DataFrame:
        """The run record as one nested row."""
        cv = self.history["cv_scores"] or None
        params = {k: json.dumps(v) for k, v in self.estimator.option("params").items()}
        history = {**self.history, "cv_scores": cv}
        classes = [str(c) for c in classes_of(self._ready())]
        return spark.createDataFrame([Row(self.name, params, history, classes)], HISTORY_SCHEMA)

    def save(self, path: str, spark: SparkSession) -> None:
        """Model under ``path/model``, estimator beside it, run record under ``path/run_metadata``."""
        self._ready().write().overwrite().save(f"{path}/model")
        self.estimator.write().overwrite().save(f"{path}/estimator")
        write_document(self.document(spark), f"{path}/run_metadata")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "TrainedModel":
        try:
            record = spark.read.schema(HISTORY_SCHEMA).json(f"{path}/run_metadata").collect()
        except AnalysisException as missing:
            raise FileNotFoundError(f"Model not found: {path}") from missing
        try:
            estimator, fitted = Classifier.load(f"{path}/estimator"), PipelineModel.load(f"{path}/model")
        except Py4JJavaError as missing:
            raise FileNotFoundError(f"Model not found: {path}") from missing
        return cls(estimator, fitted, record[0]["training_history"].asDict(recursive=True))


class MacroF1(Evaluator):
    """Macro F1 as a tuning score, for Spark's own tuners."""

    def __init__(self, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        return scores_of(dataset, self.label, self.prediction)["f1_macro"]

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class SearchResult:
    model: str
    best_score: float
    best_params: dict
    folds: int
    table: list[tuple[dict, float]]
    fitted: PipelineModel

    def document(self, spark: SparkSession) -> DataFrame:
        row = (
            self.model,
            self.best_score,
            {k: json.dumps(v) for k, v in self.best_params.items()},
            self.folds,
            datetime.now().isoformat(),
        )
        schema = "model string, best_score double, best_params map<string,string>, cv_folds int, timestamp string"
        return spark.createDataFrame([row], schema)


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination, parameter names in order; the first of equal scores wins."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def effective(model: str, params: Mapping) -> tuple:
    """What of a grid point reaches the model; points with the same answer are one fit."""
    seen = dict(params)
    if model == "knn" and seen.get("metric") == "minkowski" and seen.get("p", 2) == 2:
        seen["metric"] = "euclidean"
    if model == "random_forest":
        seen.pop("min_samples_split", None)
        if "max_depth" in seen:
            seen["max_depth"] = min(seen["max_depth"] or MAX_TREE_DEPTH, MAX_TREE_DEPTH)
    return tuple(sorted((k, repr(v)) for k, v in seen.items()))


def grid_search(
    df: DataFrame, estimator: Classifier, grid: Mapping[str, Sequence], key: str, folds: int = 5, parallelism: int = 2
) -> SearchResult:
    """Mean macro F1 over stratified folds for every grid point; refits the best on all rows.

    Points that differ only in what the model ignores, or says in two ways, share their score. Points that one fit can
    answer (``families``) share the fit: a fold costs one fit and one reading of its rows per family.
    """
    label = estimator.option("label")
    points = grid_points(grid)
    kinds = [effective(estimator.option("model"), p) for p in points]
    different = [points[kinds.index(k)] for k in dict.fromkeys(kinds)]
    groups = families(estimator.option("model"), different)
    features = estimator.option("features")
    held = stage(assign_folds(df, label, key, folds, out="__fold"), "tuning")
    if features is None:
        # Fix the features now, so that the fold column is never one of them.
        features = numeric_columns(df, exclude=[*estimator.option("exclude"), label, key])
        options = json.loads(estimator.getOrDefault("options"))
        estimator = estimator.copy({estimator.options: json.dumps({**options, "features": features})})

    def scored(work: tuple[int, list[int]]) -> list[float]:
        fold, group = work
        train, rest = (held.where(c).drop("__fold") for c in (F.col("__fold") != fold, F.col("__fold") == fold))
        return staged_scores(estimator, [different[i] for i in group], train, rest)

    work = [(fold, group) for group in groups for fold in range(folds)]
    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(scored), work, chunksize=1)
    per_fold: dict[int, list[float]] = {}
    for (_, group), values in zip(work, found):
        for i, value in zip(group, values):
            per_fold.setdefault(i, []).append(value)
    score = {k: float(np.mean(per_fold[i])) for i, k in enumerate(dict.fromkeys(kinds))}
    means = [score[k] for k in kinds]
    # Sums over classes come in any order; equal scores shall stay equal.
    best = int(np.argmax(np.round(means, 12)))
    fitted = estimator.with_params(**points[best]).fit(held.drop("__fold"))
    return SearchResult(estimator.option("model"), means[best], points[best], folds, list(zip(points, means)), fitted)
