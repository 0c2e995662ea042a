"""Multi-class classifiers on Spark ML, all behind one Estimator.

Each fitted model is a PipelineModel that takes the feature columns and adds
``prediction`` (the class name) and ``probability`` (array over sorted classes).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siftwork.functions import presets
from siftwork.functions.columns import col, numeric_columns
from siftwork.operators.boosting import SoftmaxBooster
from siftwork.operators.encode import LabelCoder
from siftwork.operators.kernel_machine import fit_machines
from siftwork.operators.metrics import balanced_weights
from siftwork.operators.neighbours import KNNClassifier
from siftwork.operators.nystroem import NystroemFeatures
from siftwork.operators.reduce import VECTOR, FeatureVector
from siftwork.operators.state import FittedStage, OptionEstimator
from siftwork.sources.shared import stage

LABEL, WEIGHT, RAW = "__label", "__weight", "rawPrediction"
KNN_INPUT = BOOST_INPUT = "__array"
KERNEL = "__kernel"
MAX_TREE_DEPTH = 30

# Default hyperparameters per model.
DEFAULTS = {
    "logistic_regression": {"C": 1.0, "solver": "lbfgs", "max_iter": 1000, "class_weight": "balanced"},
    "knn": {"n_neighbors": 15, "weights": "distance", "metric": "minkowski", "p": 2},
    "svm": {"C": 10.0, "kernel": "rbf", "gamma": "scale", "class_weight": "balanced", "max_iter": 100, "components": 300},
    "random_forest": {
        "n_estimators": 300,
        "max_depth": 30,
        "min_samples_split": 2,
        "min_samples_leaf": 2,
        "max_features": "sqrt",
        "class_weight": "balanced",
    },
    "xgboost": {
        "n_estimators": 100,
        "max_depth": 6,
        "learning_rate": 0.1,
        "subsample": 0.8,
        "colsample_bytree": 0.8,
        "reg_alpha": 0.1,
        "reg_lambda": 1.0,
        "min_child_weight": 1,
    },
}

# Display name per model.
NAMES = {
    "logistic_regression": "LogisticRegression",
    "knn": "KNN",
    "svm": "SVM",
    "random_forest": "RandomForest",
    "xgboost": "XGBoost",
}

# Tuning grids.
GRIDS = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0], "solver": ["lbfgs"], "class_weight": ["balanced"]},
    "knn": {
        "n_neighbors": [5, 10, 15, 20, 30],
        "weights": ["uniform", "distance"],
        "metric": ["minkowski", "euclidean", "manhattan"],
    },
    "svm": {"C": [0.1, 1.0, 10.0], "kernel": ["rbf"], "gamma": ["scale", "auto"]},
    "random_forest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [10, 20, 30, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
    "xgboost": {
        "n_estimators": [100, 200, 300],
        "max_depth": [3, 6, 10],
        "learning_rate": [0.01, 0.1, 0.2],
        "subsample": [0.8, 1.0],
    },
}


class Classifier(OptionEstimator):
    """Fits one of the named models on a table that holds features and label together.

    Without ``features`` every numeric column is used except the key, the label
    and the metadata. ``key`` is needed by the nearest-neighbour model only.
    """

    def __init__(
        self,
        model: str = "logistic_regression",
        features: Sequence[str] | None = None,
        label: str = presets.TARGET,
        key: str | None = None,
        exclude: Sequence[str] | None = None,
        seed: int = 42,
        **params,
    ):
        super().__init__()
        if model not in DEFAULTS:
            raise ValueError(f"unknown model {model!r}; one of {sorted(DEFAULTS)}")
        unknown = set(params) - set(DEFAULTS[model])
        if unknown:
            raise ValueError(f"unknown parameters for {model}: {sorted(unknown)}")
        self.set_options(
            model=model,
            features=None if features is None else list(features),
            label=label,
            key=key,
            exclude=list(presets.METADATA_COLUMNS if exclude is None else exclude),
            seed=seed,
            params={**DEFAULTS[model], **params},
        )

    def with_params(self, **params) -> "Classifier":
        """A copy with some hyperparameters replaced."""
        return self.copy({self.options: self.options_json(**params)})

    def options_json(self, **params) -> str:
        options = json.loads(self.getOrDefault("options"))
        options["params"] = {**options["params"], **params}
        return json.dumps(options)

    def _fit(self, df: DataFrame) -> PipelineModel:
        label, key, params = self.option("label"), self.option("key"), self.option("params")
        features = self.option("features")
        if features is None:
            features = numeric_columns(df, exclude=[*self.option("exclude"), label, *([key] if key else [])])
        coder = LabelCoder(label, LABEL).fit(df)
        vectors = FeatureVector().with_state(columns=features)
        kept = [c for c in (key,) if c is not None]
        train = vectors.transform(coder.transform(df)).select(VECTOR, LABEL, *[col(c) for c in kept])
        train = train.where(F.col(LABEL).isNotNull())
        build = getattr(self, f"_fit_{self.option('model')}")
        stages = build(train, params, coder.classes)
        return PipelineModel([vectors, *stages, ClassDecoder().with_state(classes=coder.classes)])

    def _weighted(self, train: DataFrame, params: dict) -> tuple[DataFrame, dict]:
        if params.get("class_weight") == "balanced":
            return balanced_weights(train, LABEL, WEIGHT), {"weightCol": WEIGHT}
        return train, {}

    def _fit_logistic_regression(self, train, params, classes) -> list:
        weighted, extra = self._weighted(train, params)
        # Balanced weights sum to the row count, so the penalty is the same either way.
        model = LogisticRegression(
            featuresCol=VECTOR,
            labelCol=LABEL,
            # The softmax form of two classes would halve the penalty.
            family="binomial" if len(classes) == 2 else "multinomial",
            maxIter=params["max_iter"],
            regParam=1.0 / (params["C"] * train.count()),
            elasticNetParam=0.0,
            standardization=False,
            **extra,
        )
        return [model.fit(weighted)]

    def _fit_random_forest(self, train, params, classes) -> list:
        weighted, extra = self._weighted(train, params)
        model = RandomForestClassifier(
            featuresCol=VECTOR,
            labelCol=LABEL,
            numTrees=params["n_estimators"],
            maxDepth=min(params["max_depth"] or MAX_TREE_DEPTH, MAX_TREE_DEPTH),
            minInstancesPerNode=params["min_samples_leaf"],
            featureSubsetStrategy=str(params["max_features"]),
            seed=self.option("seed"),
            **extra,
        )
        return [model.fit(weighted)]

    def _fit_xgboost(self, train, params, classes) -> list:
        booster = SoftmaxBooster(BOOST_INPUT, LABEL, len(classes), key=self.option("key"), seed=self.option("seed"), **params)
        arrays = VectorArray().with_state(input=VECTOR, output=BOOST_INPUT)
        return [arrays, booster.fit(arrays.transform(train))]

    def _fit_svm(self, train, params, classes) -> list:
        if params["kernel"] != "rbf":
            raise ValueError("only the rbf kernel is approximated")
        train = stage(train, "kernel-train")
        features = NystroemFeatures(VECTOR, KERNEL, params["components"], params["gamma"], self.option("seed")).fit(train)
        weighted, extra = self._weighted(train, params)
        penalty = 1.0 / (params["C"] * train.count())
        machine = fit_machines(weighted, LABEL, extra.get("weightCol"), len(classes), features, penalty, params["max_iter"])
        margins = stage(machine.transform(train).select(vector_to_array(F.col(RAW)).alias("margins"), LABEL), "margins")
        slopes, offsets = platt_scales(margins, len(classes))
        return [machine, MarginProbability().with_state(slopes=slopes, offsets=offsets)]

    def _fit_knn(self, train, params, classes) -> list:
        key = self.option("key")
        if key is None:
            raise ValueError("the nearest-neighbour model needs a key column")
        neighbours = KNNClassifier(
            KNN_INPUT,
            LABEL,
            key,
            params["n_neighbors"],
            params["weights"],
            params["metric"],
            params["p"],
            n_classes=len(classes),
        )
        arrays = VectorArray().with_state(input=VECTOR, output=KNN_INPUT)
        return [arrays, neighbours.fit(arrays.transform(train))]


def platt_scales(margins: DataFrame, k: int) -> tuple[list[float], list[float]]:
    """Per class, a one-variable logistic fit of 'is this class' on its margin."""
    slopes, offsets = [], []
    for c in range(k):
        one = margins.select(
            array_to_vector(F.array(F.col("margins")[c])).alias("m"),
            (F.col(LABEL) == c).cast("double").alias("y"),
        )
        fitted = LogisticRegression(featuresCol="m", labelCol="y", standardization=False).fit(one)
        slopes.append(float(fitted.coefficients[0]))
        offsets.append(float(fitted.intercept))
    return slopes, offsets


class VectorArray(FittedStage):
    """Vector column to array column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        return df.withColumn(v["output"], vector_to_array(F.col(v["input"])))


class MarginProbability(FittedStage):
    """Normalised sigmoids of one-versus-rest margins. The prediction stays the largest margin."""

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        raw = vector_to_array(F.col(RAW))
        shares = F.array(
            *[
                F.lit(1.0) / (1 + F.exp(-(raw[i] * F.lit(a) + F.lit(b))))
                for i, (a, b) in enumerate(zip(v["slopes"], v["offsets"]))
            ]
        )
        held = df.withColumn("__shares", shares)
        total = F.aggregate("__shares", F.lit(0.0), lambda a, b: a + b)
        return held.withColumn("probability", F.transform("__shares", lambda s: s / total)).drop("__shares")


class ClassDecoder(FittedStage):
    """Class code to class name, probabilities to an array, helper columns away."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = F.array(*[F.lit(c) for c in self.values["classes"]])
        decoded = F.try_element_at(names, F.col("prediction").cast("int") + 1)
        out = df.withColumn("prediction", decoded)
        if not isinstance(df.schema["probability"].dataType, T.ArrayType):
            out = out.withColumn("probability", vector_to_array("probability"))
        return out.drop(VECTOR, KERNEL, KNN_INPUT, RAW)


def classes_of(model: PipelineModel) -> list:
    return model.stages[-1].values["classes"]


def probability_of(model: PipelineModel, name) -> Column:
    """Probability column of one class."""
    return F.col("probability")[classes_of(model).index(name)]
