"""Nyström features: a map learnt from the data whose dot products approximate the RBF kernel.

Landmarks are drawn by ridge leverage.  A pilot sample (the rows with the smallest hashes) tells how badly each row is
spanned by it; rows are then drawn with chances in that proportion, so regions the pilot missed are covered.  With K the
kernel between the landmarks, a row's features are its kernel values with them times the inverse square root of K, taken
through K's eigenvalues; directions without weight are left out.  Only landmarks come to the driver, a bounded number.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.operators.fourier import gamma_scale
from siftwork.operators.state import FittedStage, OptionEstimator
from siftwork.sources.shared import stage

register_pickle_by_value(sys.modules[__name__])

LEAST_EIGENVALUE = 1e-10


def kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    # One array all the way: tasks spend most of their time here.
    near = x @ (y.T * (2.0 * gamma))
    near -= gamma * (x * x).sum(axis=1)[:, None]
    near -= gamma * (y * y).sum(axis=1)[None, :]
    return np.exp(np.minimum(near, 0.0, out=near), out=near)


def projection(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """Inverse square root of the landmarks' kernel, on the directions that carry weight."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
    kept = values > LEAST_EIGENVALUE * values.max()
    return vectors[:, kept] / np.sqrt(values[kept])


def ridge(pilot: np.ndarray, gamma: float, n: int, size: int) -> float:
    """The mean weight of the directions that ``size`` / 2 landmarks leave out, scaled to all rows."""
    values = np.sort(np.linalg.eigvalsh(kernel(pilot, pilot, gamma)))[::-1] * (n / len(pilot))
    half = max(1, min(size // 2, len(values) - 1))
    return max(float(np.maximum(values[half:], 0).sum()) / half, 1e-9 * n)


class NystroemFeatures(OptionEstimator):
    """``size`` landmarks at most; ``gamma`` is a number, ``scale`` or ``auto`` (1 / features). Rows that are equal are one."""

    def __init__(
        self, input: str = "__features", output: str = "__kernel", size: int = 300, gamma: float | str = "scale", seed: int = 42
    ):
        super().__init__()
        self.set_options(input=input, output=output, size=size, gamma=gamma, seed=seed)

    def _fit(self, df: DataFrame) -> "NystroemModel":
        source, size, gamma, seed = (self.option(n) for n in ("input", "size", "gamma", "seed"))
        rows = stage(df.select(F.col(source).alias("v")), "kernel-rows")
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array("v")))).first()
        if not n:
            raise ValueError("no rows to learn from")
        gamma = gamma_scale(rows, "v", width) if gamma == "scale" else 1.0 / width if gamma == "auto" else float(gamma)
        rows = rows.select(vector_to_array("v").alias("x"))
        pilot = first_rows(rows, F.xxhash64(F.lit(seed), "x"), size)
        inverse = np.linalg.inv(kernel(pilot, pilot, gamma) + np.eye(len(pilot)) * (weight := ridge(pilot, gamma, n, size)) * len(pilot) / n)

        @F.pandas_udf("double")
        def leverage(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            near = kernel(np.stack(x.to_list()), pilot, gamma)
            # Not cut off at 1: rows that the pilot doesn't span at all come first.
            return pd.Series(np.maximum((1.0 - ((near @ inverse) * near).sum(axis=1)) / weight, 1e-12))

        # The smallest of exponential times with these rates: a sample without replacement by weight.
        chance = (F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "x"), 11) + F.lit(0.5)) * F.lit(2.0**-53)
        landmarks = first_rows(rows, -F.log(chance) / leverage("x"), size)
        return NystroemModel().with_state(
            input=source, output=self.option("output"), gamma=gamma, landmarks=landmarks.tolist(), projection=projection(landmarks, gamma).tolist()
        )


def first_rows(rows: DataFrame, order: Column, size: int) -> np.ndarray:
    """The first ``size`` distinct rows by ``order``; equal rows have equal places in it."""
    placed = rows.select(order.alias("at"), "x")
    found = placed.orderBy("at", "x").limit(2 * size).collect()
    once = dict.fromkeys((r["at"], tuple(r["x"])) for r in found)
    if len(once) < size and len(found) == 2 * size:
        once = dict.fromkeys((r["at"], tuple(r["x"])) for r in placed.distinct().orderBy("at", "x").limit(size).collect())
    return np.array([x for _, x in list(once)[:size]], float)


class NystroemModel(FittedStage):
    def _arrays(self) -> tuple[np.ndarray, np.ndarray, float]:
        v = self.values
        return np.array(v["landmarks"]), np.array(v["projection"]), v["gamma"]

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        landmarks, matrix, gamma = self._arrays()
        held = df.sparkSession.sparkContext.broadcast((landmarks, matrix))

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            landmarks, matrix = held.value
            return pd.Series(list(kernel(np.stack(x.to_list()), landmarks, gamma) @ matrix))

        project = project.asNondeterministic()  # evaluate once, wherever the result is used
        return df.withColumn(v["output"], array_to_vector(project(vector_to_array(F.col(v["input"])))))

    def products(self, df: DataFrame, others: np.ndarray, out: str) -> DataFrame:
        """``df`` with the dot products of every row's features with those of some other points; features stay in their task."""
        landmarks, matrix, gamma = self._arrays()
        held = df.sparkSession.sparkContext.broadcast((landmarks, matrix, (kernel(np.asarray(others, float), landmarks, gamma) @ matrix).T))

        @F.pandas_udf("array<double>")
        def multiply(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            landmarks, matrix, points = held.value
            return pd.Series(list(kernel(np.stack(x.to_list()), landmarks, gamma) @ matrix @ points))

        multiply = multiply.asNondeterministic()
        return df.withColumn(out, multiply(vector_to_array(F.col(self.values["input"]))))
