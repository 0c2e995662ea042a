"""Random Fourier features: an explicit map whose dot products approximate the RBF kernel."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from siftwork.operators.state import FittedStage, OptionEstimator

register_pickle_by_value(sys.modules[__name__])


def gamma_scale(df: DataFrame, vector: str, width: int) -> float:
    """1 / (features · variance over all cells): the features' own variances and the spread of their means."""
    summary = df.select(Summarizer.metrics("count", "mean", "variance").summary(F.col(vector)).alias("s")).first()["s"]
    n = summary["count"]
    within = float(summary["variance"].toArray().mean()) * (n - 1) / n if n > 1 else 0.0
    variance = within + float(summary["mean"].toArray().var())
    return 1.0 / (width * variance) if variance > 0 else 1.0


class FourierFeatures(OptionEstimator):
    """z(x) = sqrt(2/D) · cos(Wx + b) with W drawn from N(0, 2·gamma), seeded.

    ``gamma`` is a number, ``scale`` or ``auto`` (1 / features).
    """

    def __init__(
        self,
        input: str = "__features",
        output: str = "__fourier",
        size: int = 300,
        gamma: float | str = "scale",
        seed: int = 42,
    ):
        super().__init__()
        self.set_options(input=input, output=output, size=size, gamma=gamma, seed=seed)

    def _fit(self, df: DataFrame) -> "FourierModel":
        source, gamma = self.option("input"), self.option("gamma")
        width = df.select(F.size(vector_to_array(F.col(source))).alias("n")).first()["n"]
        if gamma == "scale":
            gamma = gamma_scale(df, source, width)
        elif gamma == "auto":
            gamma = 1.0 / width
        return FourierModel().with_state(
            input=source,
            output=self.option("output"),
            size=self.option("size"),
            width=width,
            gamma=float(gamma),
            seed=self.option("seed"),
        )


class FourierModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        draw = np.random.default_rng(v["seed"])
        weights = draw.normal(0.0, np.sqrt(2 * v["gamma"]), size=(v["width"], v["size"]))
        phases = draw.uniform(0.0, 2 * np.pi, size=v["size"])
        factor = np.sqrt(2.0 / v["size"])

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(factor * np.cos(np.stack(x.to_list()) @ weights + phases)))

        project = project.asNondeterministic()  # evaluate once, wherever the result is used
        return df.withColumn(v["output"], array_to_vector(project(vector_to_array(F.col(v["input"])))))
