"""Kernel machine over Nyström features that are never stored.

A row's features are as many numbers as there are landmarks, fifty times the row itself, so a pass computes its kernel
values anew, a chunk at a time.  With features K·M, weights b and hinge loss, margins are K·(M·b) and the gradient is
Mᵀ·(Kᵀ·slopes): a pass needs the kernel values only, and a sum of landmarks by classes leaves every partition.  The
machines of all classes descend side by side (L-BFGS, line search by weak Wolfe conditions) and share each pass.
"""

from __future__ import annotations

import sys
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from siftwork.operators.nystroem import NystroemModel, kernel
from siftwork.operators.state import FittedStage
from siftwork.sources.shared import stage

register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS = 512
TOLERANCE = 1e-6
REMEMBERED, WATCHED, TRIALS = 10, 10, 25
BLOCKS = "x binary, label binary, weight binary"


def descent(x: np.ndarray, iterations: int) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS: yields the points at which it needs a value and a gradient, returns the point it ends at."""
    value, slope = yield x
    values, pairs = [value], []
    for _ in range(iterations):
        d, seen = -slope, []
        for s, y, rho in reversed(pairs):
            seen.append(a := rho * (s @ d))
            d = d - a * y
        if pairs:
            s, y, _ = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(pairs, reversed(seen)):
            d = d + s * (a - rho * (y @ d))
        fall = d @ slope
        if fall >= 0:
            break
        low, high, step = 0.0, np.inf, 1.0 if pairs else min(1.0, 1.0 / np.linalg.norm(slope))
        best = None
        for _ in range(TRIALS):
            at, tried = x + step * d, step
            there, rise = yield at
            if there > value + 1e-4 * tried * fall:
                high = tried
            else:
                best = (at, there, rise)
                if rise @ d >= 0.9 * fall:
                    break
                low = tried
            step = (low + high) / 2 if high < np.inf else 2 * low
        if best is None:
            break
        s, y = best[0] - x, best[2] - slope
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-REMEMBERED:]
        x, value, slope = best
        values.append(value)
        if len(values) > WATCHED and values[-1 - WATCHED] - value <= TOLERANCE * max(abs(value), 1e-12):
            break
    return x


def packed(rows: DataFrame) -> DataFrame:
    """Rows ``x``, ``y`` and ``w`` as blocks, each the bytes of three arrays."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in frames:
            if len(some):
                x = np.stack([np.asarray(v, float) for v in some["x"]])
                label, weight = some["y"].to_numpy(np.int32), some["w"].to_numpy(float)
                yield pd.DataFrame({"x": [x.tobytes()], "label": [label.tobytes()], "weight": [weight.tobytes()]})

    return rows.mapInPandas(pack, BLOCKS)


def fit_machines(train: DataFrame, label: str, weight: str | None, classes: int, features: NystroemModel, penalty: float, iterations: int) -> "KernelMachineModel":
    """One machine per class against the rest: mean weighted hinge loss + penalty / 2 · |weights|², intercept free."""
    v = features.values
    landmarks, matrix, gamma = np.array(v["landmarks"]), np.array(v["projection"]), v["gamma"]
    rows = train.select(
        vector_to_array(F.col(v["input"])).alias("x"),
        F.col(label).cast("int").alias("y"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
    )
    blocks = stage(packed(rows), "kernel-blocks").rdd.map(lambda r: tuple(map(bytes, r))).persist(StorageLevel.MEMORY_AND_DISK)
    held = blocks.context.broadcast(landmarks)
    total = blocks.map(lambda b: float(np.frombuffer(b[2]).sum())).sum()
    # The two machines of two classes are each other's mirror image.
    fitted = [1] if classes == 2 else list(range(classes))

    def evaluated(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        names = sorted(points)
        weights = np.array([points[c] for c in names]).T
        outer, free = matrix @ weights[:-1], weights[-1]

        def sums(some: Iterator[tuple]) -> Iterator[tuple]:
            centres = held.value
            loss, slopes, lift = np.zeros(len(names)), np.zeros((len(centres), len(names))), np.zeros(len(names))
            for x, y, w in some:
                y, w = np.frombuffer(y, np.int32), np.frombuffer(w)
                x = np.frombuffer(x).reshape(len(y), -1)
                for k in range(0, len(y), CHUNK_ROWS):
                    part = slice(k, k + CHUNK_ROWS)
                    near = kernel(x[part], centres, gamma)
                    side = np.where(y[part, None] == np.array(names), 1.0, -1.0)
                    short = 1.0 - side * (near @ outer + free)
                    inside = w[part, None] * (short > 0)
                    loss += (inside * short).sum(axis=0)
                    slopes -= near.T @ (inside * side)
                    lift -= (inside * side).sum(axis=0)
            yield loss, slopes, lift

        loss, slopes, lift = (sum(parts) / total for parts in zip(*blocks.mapPartitions(sums).collect()))
        inner = weights[:-1]
        values = loss + penalty / 2 * (inner * inner).sum(axis=0)
        gradients = np.vstack([matrix.T @ slopes + penalty * inner, lift])
        return {c: (values[i], gradients[:, i]) for i, c in enumerate(names)}

    runs = {c: descent(np.zeros(matrix.shape[1] + 1), iterations) for c in fitted}
    asked, found = {c: next(run) for c, run in runs.items()}, {}
    while asked:
        answers, asked = evaluated(asked), {}
        for c, answer in answers.items():
            try:
                asked[c] = runs[c].send(answer)
            except StopIteration as end:
                found[c] = end.value
    blocks.unpersist()
    if classes == 2:
        found[0] = -found[1]
    weights = np.array([found[c] for c in range(classes)]).T
    return KernelMachineModel().with_state(
        input=v["input"], gamma=gamma, landmarks=v["landmarks"], weights=(matrix @ weights[:-1]).tolist(), free=weights[-1].tolist()
    )


class KernelMachineModel(FittedStage):
    """Adds ``rawPrediction`` (a margin per class) and ``prediction`` (the class code of the largest)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        held = df.sparkSession.sparkContext.broadcast((np.array(v["landmarks"]), np.array(v["weights"]), np.array(v["free"])))
        gamma = v["gamma"]

        @F.pandas_udf("array<double>")
        def margins(x: pd.Series) -> pd.Series:
            centres, weights, free = held.value
            out = []
            for k in range(0, len(x), CHUNK_ROWS):
                part = np.stack(x.iloc[k : k + CHUNK_ROWS].to_list())
                out += list(kernel(part, centres, gamma) @ weights + free)
            return pd.Series(out, dtype=object)

        margins = margins.asNondeterministic()  # evaluate once, wherever the result is used
        scored = df.withColumn("__margins", margins(vector_to_array(F.col(v["input"]))))
        best = F.array_position("__margins", F.array_max("__margins")) - 1
        scored = scored.withColumn("prediction", best.cast("double"))
        return scored.withColumn("rawPrediction", array_to_vector("__margins")).drop("__margins")
