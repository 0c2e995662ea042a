"""Exact k nearest neighbours as a Spark join.

A set of points of a checked size is broadcast and searched in place.  A larger
one is cut into Voronoi cells around sampled pivots; the triangle inequality
tells which cells can hold a neighbour of a row, and only those are joined, by
an equi-join on the cell.  Cells are split into blocks of bounded size and busy
blocks are replicated, so no task ever holds a whole hot cell.  Every block
emits k candidates per row, never the pairs it looked at.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siftwork.functions.columns import col
from siftwork.operators.split import sample_exact
from siftwork.operators.state import FittedStage, OptionEstimator
from siftwork.sources.shared import shared_path, stage

# Task functions travel with the job, so executors need no installed copy of this package.
register_pickle_by_value(sys.modules[__name__])

BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 20_000
MAX_PIVOTS = 1_024
ASKING = "__asking"
TILE_ROWS, TILE_POINTS = 256, 2_048
DENSE = 4  # a span is searched whole where a row needs at least this part of its points


def _powers(metric: str, p: float) -> float:
    return {"minkowski": float(p), "euclidean": 2.0, "manhattan": 1.0}[metric]


def distances(rows: np.ndarray, points: np.ndarray, p: float) -> np.ndarray:
    """Minkowski distances of every row to every point, from plain differences (an exact hit is exactly 0)."""
    total = np.zeros((len(rows), len(points)))
    for j in range(rows.shape[1]):
        gap = np.abs(rows[:, j, None] - points[None, :, j])
        total += gap * gap if p == 2 else gap if p == 1 else gap**p
    return np.sqrt(total) if p == 2 else total if p == 1 else total ** (1 / p)


def listed_distances(rows: np.ndarray, points: np.ndarray, p: float) -> np.ndarray:
    """Distance of every row to its own list of points: (n, d) against (n, m, d)."""
    gap = np.abs(points - rows[:, None, :])
    if p == 2:
        return np.sqrt((gap * gap).sum(axis=2))
    return gap.sum(axis=2) if p == 1 else (gap**p).sum(axis=2) ** (1 / p)


class Rough:
    """Lower bounds of the distances to a set of points, by the quickest arithmetic that tells most points apart.

    ``tile`` gives values per row and point; a point within ``gap`` of a row never has a value above ``limit``.

    * Squared distances: single precision, one matrix product.  What it may be off by grows with the point's own size,
      and is taken off there, so that a far point blurs no other.
    * Sums of differences: whole numbers of 15 bits on a grid over the points' range; rows beyond it are moved to its
      edge, which takes the same from all distances.  Where the grid is too coarse: single precision.
    * All else, and what is not finite or beyond single precision: plain differences in double precision.
    """

    def __init__(self, points: np.ndarray, p: float):
        self.points, self.p, self.kind = points, p, "plain"
        n, d = points.shape
        if p not in (1, 2) or not n or not d or d > 10_000 or not all(np.isfinite(points[s]).all() for s in self.parts(n)):
            return
        self.low, self.high = points.min(axis=0), points.max(axis=0)
        some = points[:: max(1, n // 10_000)]
        self.centre = np.median(some, axis=0)
        away = np.abs(some - self.centre).sum(axis=1).mean()
        self.error = 2.4e-7 * (d + 8)
        if not 1e-100 < away < 1e100:
            return
        if p == 1:
            self.step = float((self.high - self.low).sum()) / (32_000 - 2 * d) if d < 8_000 else math.inf
            if 0 < self.step * d <= 0.05 * away:
                self.kind, self.held = "grid", np.empty((d, n), np.int16)
                for s in self.parts(n):
                    self.held[:, s] = np.rint((points[s] - self.low) / self.step).T
                return
        self.scale = away
        if max(np.abs(self.low - self.centre).max(), np.abs(self.high - self.centre).max()) > 1e12 * away:
            return
        self.kind, self.held = "single", np.empty((d + 1, n), np.float32)
        for s in self.parts(n):
            x = (points[s] - self.centre) / away
            if p == 2:
                self.held[:d, s], self.held[d, s] = -2 * x.T, (x * x).sum(axis=1) * (1 - self.error)
            else:
                self.held[:d, s], self.held[d, s] = x.T, -np.abs(x).sum(axis=1) * self.error

    @staticmethod
    def parts(n: int) -> Iterator[slice]:
        return (slice(s, s + TILE_POINTS) for s in range(0, n, TILE_POINTS))

    def rows(self, part: np.ndarray) -> "RoughRows":
        return RoughRows(self, part)


class RoughRows:
    """A few asking rows, made ready for the arithmetic of a ``Rough``."""

    def __init__(self, rough: Rough, part: np.ndarray):
        self.rough, self.part, self.kind = rough, part, rough.kind
        if self.kind == "grid" and np.isfinite(part).all():
            inside = np.clip(part, rough.low, rough.high)
            self.outside = np.abs(part - inside).sum(axis=1)
            # What double precision may round in distances of this size, in steps.
            self.rounding = 4e-15 * (part.shape[1] + 4) * (self.outside / rough.step + 32_000)
            self.ready = np.rint((inside - rough.low) / rough.step).astype(np.int16)
        elif self.kind == "single":
            x = (part - rough.centre) / rough.scale
            # Beside a row this far off, all points look alike in single precision.
            if not np.abs(x).max(initial=0) < 1e3:
                self.kind = "plain"
                return
            self.size = (x * x).sum(axis=1) if rough.p == 2 else np.abs(x).sum(axis=1)
            self.ready = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
        else:
            self.kind = "plain"

    def tile(self, start: int, stop: int) -> np.ndarray:
        r = self.rough
        if self.kind == "plain":
            return distances(self.part, r.points[start:stop], r.p)
        held = r.held[:, start:stop]
        if self.kind == "single" and r.p == 2:
            return self.ready @ held
        d = r.points.shape[1]
        total = np.zeros((len(self.part), held.shape[1]), held.dtype)
        if self.kind == "single":
            total += held[d]
        gap = np.empty_like(total)
        for j in range(d):
            np.subtract(self.ready[:, j, None], held[j], out=gap)
            np.abs(gap, out=gap)
            np.add(total, gap, out=total)
        return total

    def limit(self, gap: np.ndarray) -> np.ndarray:
        r = self.rough
        with np.errstate(over="ignore", invalid="ignore"):
            if self.kind == "plain":
                return gap * (1 + 1e-11)
            if self.kind == "grid":
                return np.clip((gap - self.outside) / r.step + self.rounding + r.points.shape[1] + 2, -1, 32_767).astype(np.int16)
            gap = gap / r.scale * (1 + 1e-11)
            whole = gap * gap - self.size if r.p == 2 else gap
            return (whole + r.error * self.size + 1e-6 * np.abs(whole) + 1e-30).astype(np.float32)

    def first(self, tile: np.ndarray, k: int) -> np.ndarray:
        """A limit that leaves in the k nearest of a tile, when no distance is known yet."""
        edge = np.partition(tile, k - 1, axis=1)[:, k - 1].astype(float)
        if self.kind == "plain":
            return edge * (1 + 1e-11)
        if self.kind == "grid":
            return edge + 2 * self.rough.points.shape[1] + 4 + 2 * self.rounding
        return edge + self.rough.error * (12 * self.size + 6 * np.abs(edge)) + 1e-30


class Nearest:
    """The ``k`` nearest points of some rows so far: by exact distance, then by position (points are sorted by id)."""

    def __init__(self, part: np.ndarray, points: np.ndarray, k: int, p: float):
        self.part, self.points, self.k, self.p = part, points, k, p
        self.row, self.at, self.gap = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, row: np.ndarray, at: np.ndarray) -> None:
        self.found.append((row, at))
        self.waiting += len(row)

    def settle(self) -> None:
        """Measures what was added, and forgets what is too far."""
        row, at = (np.concatenate(x) for x in zip(*self.found)) if self.found else (self.row[:0], self.at[:0])
        self.found, self.waiting = [], 0
        for s in range(0, len(row), 64 * TILE_ROWS):
            r, c = row[s : s + 64 * TILE_ROWS], at[s : s + 64 * TILE_ROWS]
            exact = [listed_distances(self.part[r[i : i + TILE_POINTS]], self.points[c[i : i + TILE_POINTS], None], self.p)[:, 0] for i in range(0, len(r), TILE_POINTS)]
            r, c, g = np.concatenate([self.row, r]), np.concatenate([self.at, c]), np.concatenate([self.gap, *exact])
            order = np.lexsort((c, g, r))
            r, c, g = r[order], c[order], g[order]
            kept = np.arange(len(r)) - np.searchsorted(r, r) < self.k
            self.row, self.at, self.gap = r[kept], c[kept], g[kept]

    def reach(self) -> np.ndarray:
        """Distance of each row's k-th."""
        return self.gap.reshape(len(self.part), self.k)[:, -1]


def _nearest(part: np.ndarray, rough: Rough, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and positions of the k nearest points of each row."""
    points, asking = rough.points, rough.rows(part)
    best = Nearest(part, points, k, rough.p)
    first = min(len(points), max(TILE_POINTS, k))
    tile = asking.tile(0, first)
    best.add(*np.nonzero(~(tile > asking.first(tile, k)[:, None])))
    best.settle()
    limit = asking.limit(best.reach())[:, None]
    for start in range(first, len(points), TILE_POINTS):
        tile = asking.tile(start, start + TILE_POINTS)
        row, at = np.divmod(np.flatnonzero(~(tile > limit)), tile.shape[1])
        best.add(row, at + start)
        if best.waiting > 16 * TILE_ROWS:
            best.settle()
            limit = asking.limit(best.reach())[:, None]
    best.settle()
    return best.gap.reshape(len(part), k), best.at.reshape(len(part), k)


def search(rows: np.ndarray, points: np.ndarray, ids: np.ndarray, codes: np.ndarray, k: int, p: float) -> pd.DataFrame:
    """Per row the k nearest points, ordered by distance then id. A tile of rows by points is held at a time."""
    if (ids[1:] < ids[:-1]).any():
        by_id = np.argsort(ids)
        points, ids, codes = points[by_id], ids[by_id], codes[by_id]
    k = min(k, len(points))
    rough = Rough(points, p)
    found = {"distances": [], "ids": [], "codes": []}
    for start in range(0, len(rows), TILE_ROWS):
        exact, best = _nearest(rows[start : start + TILE_ROWS], rough, k)
        found["distances"].extend(exact)
        found["ids"].extend(ids[best].tolist())
        found["codes"].extend(codes[best])
    return pd.DataFrame(found)


def _key(df: DataFrame, key: str) -> Column:
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    return col(key).cast("bigint" if whole else "string")


def _names(series: pd.Series) -> np.ndarray:
    """Row keys as an array that sorts: numbers as they are, texts as fixed-width strings."""
    return series.to_numpy(dtype=str) if series.dtype == object or str(series.dtype) == "str" else series.to_numpy()


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=float) for x in series]) if len(series) else np.zeros((0, 1))


def _parts(series: pd.Series) -> Iterator[np.ndarray]:
    """A batch's rows, as many at a time as a tile has."""
    for start in range(0, len(series), TILE_ROWS):
        yield _matrix(series.iloc[start : start + TILE_ROWS])


def spans_of(pivots: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """Per cell the number of its span: cells that lie together and hold about ``rows`` points."""
    away = pivots - pivots.mean(axis=0)
    along = np.argsort(away @ np.linalg.svd(away, full_matrices=False)[2][0], kind="stable")
    before = np.cumsum(count[along]) - count[along]
    span = np.empty(len(count), np.int64)
    span[along] = np.unique(before // rows, return_inverse=True)[1]
    return span


class KNNClassifier(OptionEstimator):
    """k nearest neighbours over an ``array<double>`` feature column with an integer class code.

    ``key`` (a whole number or a text) names the points and breaks distance ties. Rows that ask need none.
    """

    def __init__(
        self,
        features: str = "features",
        label: str = "label",
        key: str = "id",
        n_neighbors: int = 15,
        weights: str = "distance",
        metric: str = "minkowski",
        p: float = 2,
        n_classes: int | None = None,
        broadcast_bytes: int = BROADCAST_BYTES,
        block_rows: int = BLOCK_ROWS,
    ):
        super().__init__()
        if weights not in ("uniform", "distance"):
            raise ValueError("weights must be 'uniform' or 'distance'")
        if _powers(metric, p) < 1:
            raise ValueError("p must be at least 1")
        self.set_options(
            features=features,
            label=label,
            key=key,
            k=n_neighbors,
            weights=weights,
            p=_powers(metric, p),
            n_classes=n_classes,
            broadcast_bytes=broadcast_bytes,
            block_rows=block_rows,
        )

    def _fit(self, df: DataFrame) -> "KNNModel":
        points = df.select(
            _key(df, self.option("key")).alias("id"),
            col(self.option("label")).cast("int").alias("code"),
            col(self.option("features")).cast("array<double>").alias("x"),
        )
        spark = df.sparkSession
        path = shared_path(spark, "points")
        points.write.parquet(path)
        points = spark.read.parquet(path)
        named = F.length(F.col("id").cast("string")) * 4 if dict(points.dtypes)["id"] == "string" else F.lit(8)
        held = F.sum(F.size("x").cast("long") * 8 + F.coalesce(named, F.lit(0)) + 4)
        n, top, size = points.agg(F.count(F.lit(1)), F.max("code"), held).collect()[0]
        if not n:
            raise ValueError("no rows to learn from")
        n_classes = self.option("n_classes") or top + 1
        base = dict(
            path=path,
            n=n,
            k=self.option("k"),
            p=self.option("p"),
            weights=self.option("weights"),
            n_classes=n_classes,
            features=self.option("features"),
            key=self.option("key"),
            key_type=dict(points.dtypes)["id"],
            block_rows=self.option("block_rows"),
        )
        if size <= self.option("broadcast_bytes"):
            return KNNModel().with_state(**base, cells=None)
        return KNNModel().with_state(**base, **self._build_cells(points, n, base["p"]))

    def _build_cells(self, points: DataFrame, n: int, p: float) -> dict:
        """Nearest pivot of every point, and per cell its size, radius and closest distances."""
        wanted = max(2, min(MAX_PIVOTS, math.isqrt(n)))
        pivots = [list(r["x"]) for r in sample_exact(points, "id", wanted).select("x").collect()]
        held = points.sparkSession.sparkContext.broadcast(np.array(pivots))

        @F.pandas_udf("struct<cell int, reach double>")
        def nearest_pivot(x: pd.Series) -> pd.DataFrame:
            cells, reach = [], []
            for part in _parts(x):
                gaps = distances(part, held.value, p)
                cells.append(gaps.argmin(axis=1).astype("int32"))
                reach.append(gaps.min(axis=1))
            if not cells:
                return pd.DataFrame({"cell": np.zeros(0, "int32"), "reach": np.zeros(0)})
            return pd.DataFrame({"cell": np.concatenate(cells), "reach": np.concatenate(reach)})

        placed = points.withColumn("place", nearest_pivot("x")).select("id", "code", "x", "place.cell", "place.reach")
        path = shared_path(points.sparkSession, "cells")
        placed.write.parquet(path)
        placed = points.sparkSession.read.parquet(path)
        sizes = placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("reach").alias("least"), F.max("reach").alias("most")
        )
        cells = [[r["cell"], r["n"], r["least"], r["most"]] for r in sizes.collect()]
        return {"cells": cells, "pivots": pivots, "cell_path": path}


class KNNModel(FittedStage):
    """Adds ``prediction`` (class code) and ``probability`` (array over the classes)."""

    def tables(self) -> dict[str, str]:
        v = self.values
        return {"points": v["path"]} if v["cells"] is None else {"cells": v["cell_path"]}

    def with_tables(self, folders: dict[str, str]) -> "KNNModel":
        places = {"points": "path", "cells": "cell_path"}
        return self.with_state(**{**self.values, **{places[name]: folder for name, folder in folders.items()}})

    def _transform(self, df: DataFrame) -> DataFrame:
        found = self.neighbours(df)
        scores = self._vote(F.col("__near"))
        voted = found.withColumn("__scores", scores)
        total = F.aggregate("__scores", F.lit(0.0), lambda a, b: a + b)
        best = F.array_position("__scores", F.array_max("__scores")) - 1
        return (
            voted.withColumn("probability", F.transform("__scores", lambda s: s / total))
            .withColumn("prediction", best.cast("double"))
            .drop("__scores", "__near")
        )

    def staged(self, df: DataFrame, kinds: Sequence[tuple[int, str]], out: str) -> DataFrame:
        """``df`` with an array of the class codes that every (k, weights) predicts, k up to the model's own."""
        if max(k for k, _ in kinds) > self.values["k"]:
            raise ValueError("the model looks for fewer neighbours")
        near = F.col("__near")
        votes = [KNNModel().with_state(**{**self.values, "weights": w})._vote(F.slice(near, 1, k)) for k, w in kinds]
        best = F.transform(F.array(*votes), lambda s: (F.array_position(s, F.array_max(s)) - 1).cast("int"))
        return self.neighbours(df).withColumn(out, best).drop("__near")

    def _vote(self, near: Column) -> Column:
        """Summed weights per class; neighbours at distance 0 outvote all others."""
        exact = near[0]["distances"] == 0  # nearest first

        def weight(m: Column) -> Column:
            if self.values["weights"] == "uniform":
                return F.lit(1.0)
            inverse = F.coalesce(F.try_divide(F.lit(1.0), m["distances"]), F.lit(1.0))
            return F.when(exact, (m["distances"] == 0).cast("double")).otherwise(inverse)

        def votes(c: int) -> Column:
            mine = F.filter(near, lambda m: m["codes"] == c)
            return F.aggregate(mine, F.lit(0.0), lambda a, m: a + weight(m))

        return F.array(*[votes(c) for c in range(self.values["n_classes"])])

    def neighbours(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__near``: the k nearest points as (distances, ids, codes), nearest first.

        Against a broadcast this is a projection (and works on streams); against cells it is a join
        whose first half is written to the shared folder.
        """
        return self._by_broadcast(df) if self.values["cells"] is None else self._by_cells(df)

    def _candidates(self) -> str:
        return f"distances array<double>, ids array<{self.values['key_type']}>, codes array<int>"

    def _by_broadcast(self, df: DataFrame) -> DataFrame:
        v = self.values
        k, p = v["k"], v["p"]
        # fit() checked that all points fit into the broadcast limit.
        points = df.sparkSession.read.parquet(v["path"]).select("id", "code", "x").toArrow().sort_by("id")
        cells = points["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        held = df.sparkSession.sparkContext.broadcast(
            (cells.reshape(len(points), -1), _names(points["id"].to_pandas()), points["code"].to_numpy().astype("int32"))
        )

        @F.pandas_udf(f"struct<{self._candidates()}>")
        def look(x: pd.Series) -> pd.DataFrame:
            m, ids, codes = held.value
            return search(_matrix(x), m, ids, codes, k, p)

        # Marked so that the optimizer neither repeats the search nor moves it below a filter it feeds.
        look = look.asNondeterministic()
        found = df.withColumn("__found", look(col(v["features"]).cast("array<double>")))
        zipped = F.arrays_zip("__found.distances", "__found.ids", "__found.codes")
        return found.withColumn("__near", zipped).drop("__found")

    def _by_cells(self, df: DataFrame) -> DataFrame:
        """Two joins: the nearest cells give each row a k-th distance, which then rules out other cells.

        In many dimensions few are ruled out.  A row then goes to spans of cells, not to each cell, so what moves is the
        rows times the points by ``block_rows``.
        """
        v = self.values
        k, p, spark = v["k"], v["p"], df.sparkSession
        cells = sorted(v["cells"])
        number = np.array([c[0] for c in cells], dtype="int32")
        count = np.array([c[1] for c in cells])
        least, most = np.array([c[2] for c in cells]), np.array([c[3] for c in cells])
        pivots = np.array(v["pivots"])[number]
        held = spark.sparkContext.broadcast((pivots, number, count, least, most))

        @F.pandas_udf("array<int>")
        def nearest_cells(x: pd.Series) -> pd.Series:
            """The nearest cells that together hold k points."""
            centre, names, sizes, _, _ = held.value
            out = []
            for part in _parts(x):
                order = np.argsort(distances(part, centre, p), axis=1)
                needed = (np.cumsum(sizes[order], axis=1) < k).sum(axis=1) + 1
                out += [names[o[:n]] for o, n in zip(order, needed)]
            return pd.Series(out, dtype=object)

        span = spans_of(pivots, count, v["block_rows"])
        inside = np.where(span[:, None] == np.arange(span.max() + 1)[None, :], count[:, None], 0)

        @F.pandas_udf("array<int>")
        def reached(x: pd.Series, limit: pd.Series) -> pd.Series:
            """Cells that may hold a point within the limit; a span of cells that is needed for the most part is one place (-1 - span)."""
            centre, names, _, low, high = held.value
            edges, out = limit.to_numpy(), []
            for part in _parts(x):
                gaps = distances(part, centre, p)
                # A point lies within its cell's radius, beyond its inner radius, and nearer to its own pivot.
                lower = np.maximum(gaps - high[None, :], low[None, :] - gaps)
                lower = np.maximum(lower, (gaps - gaps.min(axis=1, keepdims=True)) / 2)
                mine = slice(len(out), len(out) + len(part))
                visit = lower <= edges[mine, None] * (1 + 1e-9) + 1e-12
                whole = visit @ inside * DENSE >= inside.sum(axis=0)
                visit &= ~whole[:, span]
                out += [np.concatenate([names[c], -1 - np.flatnonzero(w).astype("int32")]) for c, w in zip(visit, whole)]
            return pd.Series(out, dtype=object)

        # Every asking row has a number of its own, fixed by writing it; keys may be repeated or missing.
        df = stage(df.withColumn(ASKING, F.monotonically_increasing_id()), "asking-rows")
        asking = df.select(F.col(ASKING).alias("q"), col(v["features"]).cast("array<double>").alias("x"))
        asking = stage(asking.withColumn("seen", nearest_cells("x")), "asking")
        whole = {-1 - int(i): int(count[span == i].sum()) for i in range(span.max() + 1)}
        places = {int(c): {int(c): int(n), -1 - int(i): whole[-1 - int(i)]} for c, n, i in zip(number, count, span)}
        near = self._search_places(asking.select("q", "x", F.col("seen").alias("places")), places)
        limit = F.array_max(F.slice(F.array_sort(F.flatten(F.collect_list("distances"))), 1, k))
        limits = near.groupBy("q").agg(limit.alias("limit"), F.sum(F.size("distances")).alias("n"))
        # Fewer than k points in reach means that there are no more: any distance will do.
        limits = limits.select("q", F.when(F.col("n") >= k, F.col("limit")).otherwise(float("inf")).alias("limit"))
        bounded = asking.join(limits, "q")
        # A row travels once per place, so its places are written as a list.
        reach = stage(bounded.select("q", "x", reached.asNondeterministic()("x", "limit").alias("places")), "reach")
        candidates = self._search_places(reach, places)
        every = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("distances", "ids", "codes"))))
        merged = candidates.groupBy("q").agg(F.slice(every, 1, k).alias("__near"))
        return df.join(merged, F.col(ASKING) == F.col("q"), "left").drop("q", ASKING)

    def _search_places(self, asking: DataFrame, places: dict[int, dict[int, int]]) -> DataFrame:
        """For every (q, x) and each of its places the k nearest points of each block of that place.

        ``places`` names for every cell the places that hold it, with the number of their points.
        """
        v = self.values
        k, p, rows = v["k"], v["p"], v["block_rows"]
        visits = asking.select("q", "x", F.explode("places").alias("place"))
        # One row per place, at most twice MAX_PIVOTS.
        load = {r["place"]: r["count"] for r in visits.groupBy("place").count().collect()}
        shape = [(c, u, -(-n // rows), -(-load[u] // rows)) for c, held in places.items() for u, n in held.items() if u in load]
        plan = F.broadcast(asking.sparkSession.createDataFrame(shape, "cell int, place int, blocks bigint, copies bigint"))
        once = F.broadcast(asking.sparkSession.createDataFrame(list({x[1:] for x in shape}), "place int, blocks bigint, copies bigint"))
        zero = F.lit(0).cast("bigint")
        every_copy = F.explode(F.sequence(zero, F.col("copies") - 1)).alias("copy")
        every_block = F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block")
        points = asking.sparkSession.read.parquet(v["cell_path"]).join(plan, "cell")
        right = points.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).select(
            "place", "block", every_copy, "id", "code", "x"
        )
        left = visits.join(once, "place").withColumn("copy", F.pmod(F.xxhash64("q"), F.col("copies"))).select(
            "place", every_block, "copy", "q", "x"
        )

        def within_block(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            if not len(asking) or not len(block):
                return pd.DataFrame({"q": [], "distances": [], "ids": [], "codes": []})
            codes = block["code"].to_numpy(dtype="int32")
            found = search(_matrix(asking["x"]), _matrix(block["x"]), _names(block["id"]), codes, k, p)
            found.insert(0, "q", asking["q"].to_numpy())
            return found

        keys = ["place", "block", "copy"]
        schema = f"q {dict(visits.dtypes)['q']}, {self._candidates()}"
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(within_block, schema)
