"""Quality rules with robust multivariate outliers.

Each document gets a vector of transformed statistics: word length, marks per word, repeated lines, repeated words, size.
For every language and source a minimum-covariance-determinant estimate is found by concentration steps, run for all
groups at once: distances from the present centre, the nearest ``share`` of each group, their mean and covariance, and so
on until determinants and centres settle or ``steps`` are done.  Two starts are run side by side and the one with the smaller determinant is taken.
The covariance is then scaled so that the median distance fits the chi-square law, and a document is rejected where its
squared Mahalanobis distance exceeds the law's ``confidence`` quantile.

The steps move sums and histograms per group, never rows, so a group may hold any share of the table.  Ratios are shrunk
for short texts, and every statistic has a least spread: otherwise one that is nearly constant among good documents
would reject all that differ a little.  Groups below ``least_rows`` are pooled by language, and what is still too small
in one last pool; a pool that stays below ``least_rows`` has no estimate and rejects nothing by distance.

Null texts have no words and fail the base rules.  Null languages or sources form groups of their own.  Ties and
repeated rows weigh as often as they occur.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.llm.common import find_words, slices, text_of, word_ids
from siftwork.sources.shared import stage

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
# Least standard deviation of each transformed statistic.
FLOORS = {"v0": 0.10, "v1": 0.12, "v2": 0.12, "v3": 0.08, "v4": 1.5}
SIZE = len(FLOORS)
BINS_PER_UNIT = 64
SETTLED = 1e-9  # change of a log determinant or of a centre
POOLS_SENT = 20_000  # rows of about 400 bytes


def repeated_words(ids: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text."""
    n, texts = len(ids), len(offsets) - 1
    out = np.zeros(texts, np.int64)
    if n < window:
        return out
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    starts = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    # Pairs of numbers are renamed to dense numbers, so equal names mean equal windows.
    name = ids[starts].astype(np.int64)
    for k in range(1, window):
        name = np.unique(name * (int(ids.max()) + 1) + ids[starts + k], return_inverse=True)[1]
    name = np.unique(name * texts + owner[starts], return_inverse=True)[1]
    twice = starts[np.bincount(name)[name] > 1]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    np.add.at(out, owner[covered], 1)
    return out


def text_statistics(texts: list[str]) -> pd.DataFrame:
    """The counts of ``STATISTICS`` for a batch of texts."""
    lists = [find_words(x) for x in texts]
    ids, offsets, _ = word_ids(lists)
    lines, repeats = [], []
    for text in texts:
        filled = [x for x in text.split("\n") if x.strip(SEPARATORS)]
        lines.append(len(filled))
        repeats.append(len(filled) - len(set(filled)))
    return pd.DataFrame(
        {
            "n_words": np.diff(offsets),
            "word_chars": [len(x) - sum(map(x.count, SEPARATORS)) for x in texts],
            "n_symbols": [sum(map(x.count, SYMBOLS)) for x in texts],
            "n_dup_lines": repeats,
            "n_repeat_words": repeated_words(ids, offsets),
            "n_lines": lines,
        }
    )


def statistics(df: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """One row per document: id, lang, source, counts, and whether the base rules fail."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "body"):
            counts = text_statistics(frame["body"].tolist())
            yield pd.concat([frame[["id", "lang", "source"]].reset_index(drop=True), counts], axis=1)

    rows = df.select(
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{source}`").cast("string").alias("source"),
        text_of(text).alias("body"),
    )
    kind = df.schema[key].dataType.simpleString()
    out = rows.mapInPandas(count, f"id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in STATISTICS))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def transformed() -> dict[str, Column]:
    """Statistics brought to even spreads; ratios shrunk by twenty words or five lines."""
    words, chars, marks, dup, rep, lines = (F.col(c).cast("double") for c in STATISTICS)
    return {
        "v0": F.log((chars + 100.0) / (words + 20.0)),
        "v1": F.sqrt(marks / (words + 20.0)),
        "v2": F.sqrt(dup / (lines + 5.0)),
        "v3": rep / (words + 20.0),
        "v4": F.log1p(words),
    }


def chi_square_quantile(share: float, degrees: int) -> float:
    """Wilson and Hilferty's approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(share)
    return degrees * (1 - 2 / (9 * degrees) + z * math.sqrt(2 / (9 * degrees))) ** 3


def _moments() -> list[Column]:
    v = [F.col(c) for c in FLOORS]
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x) for x in v]).alias("s1"),
        F.array(*[F.sum(v[i] * v[j]) for i in range(SIZE) for j in range(SIZE)]).alias("s2"),
    ]


def _with_inverse(sums: DataFrame) -> DataFrame:
    """Per group: mean, the triangle that turns differences into distances, and the log determinant."""
    floor = np.diag(np.array(list(FLOORS.values())) ** 2)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            means, triangles, sizes = [], [], []
            for n, s1, s2 in zip(frame["n"], frame["s1"], frame["s2"]):
                mean = np.asarray(s1) / n
                cov = np.asarray(s2).reshape(SIZE, SIZE) / n - np.outer(mean, mean)
                # Raise the spread along every direction in which it is below the least one.
                unit = np.sqrt(floor.diagonal())
                values, axes = np.linalg.eigh(cov / np.outer(unit, unit))
                values = np.maximum(values, 1.0)
                cov = (axes * values) @ axes.T * np.outer(unit, unit)
                means.append(mean)
                triangles.append(np.linalg.inv(np.linalg.cholesky(cov)).ravel())
                sizes.append(float(np.linalg.slogdet(cov)[1]))
            yield pd.DataFrame({"pool": frame["pool"], "start": frame["start"], "mean": means, "triangle": triangles, "logdet": sizes})

    return sums.mapInPandas(solve, "pool string, start int, mean array<double>, triangle array<double>, logdet double")


def _distance() -> Column:
    """Squared Mahalanobis distance from the columns ``mean`` and ``triangle``."""
    gap = [F.col(c) - F.col("mean")[i] for i, c in enumerate(FLOORS)]
    rows = [reduce(Column.__add__, [F.col("triangle")[i * SIZE + j] * gap[j] for j in range(i + 1)]) for i in range(SIZE)]
    return reduce(Column.__add__, [r * r for r in rows])


def _bin(distance: Column) -> Column:
    """Place of a distance on a fine logarithmic scale."""
    return F.floor(F.log1p(distance) * BINS_PER_UNIT).cast("int")


def _bin_at(rows: DataFrame, share: float) -> DataFrame:
    """Per group: the first bin up to which at least ``share`` of the rows lie."""
    from pyspark.sql import Window

    counts = rows.groupBy("pool", "start", "bin").count()
    ahead = Window.partitionBy("pool", "start").orderBy("bin")
    total = Window.partitionBy("pool", "start")
    reached = counts.withColumn("upto", F.sum("count").over(ahead)).withColumn("all", F.sum("count").over(total))
    return reached.where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy("pool", "start").agg(F.min("bin").alias("edge"))


def per_pool(small: DataFrame, rows: int) -> DataFrame:
    """A table with a row or two per pool, to be joined with documents: sent to all tasks if it has few rows.

    A pool may hold a third of all documents, which then stay where they are.  Beyond the bound Spark joins by shuffle.
    """
    return F.broadcast(small) if rows <= POOLS_SENT else small


def estimates(vectors: DataFrame, pool_count: int, *, share: float = 0.75, steps: int = 5) -> DataFrame:
    """Robust estimates per ``pool``: mean, triangle, logdet, and ``scale`` for squared distances.

    A step that changes no determinant and no centre (where all spreads are the least ones, determinants stand still
    before the centres do) is the last one; ``steps`` bounds their number.
    """

    def sent(small: DataFrame) -> DataFrame:
        return per_pool(small, pool_count)

    starts = F.explode(F.array(F.lit(0), F.lit(1))).alias("start")
    both = vectors.select("pool", *FLOORS, starts)
    # Start 0: all rows.  Start 1: the rows nearest to the coordinates' medians, by their quartile spreads.
    middles = vectors.groupBy("pool").agg(
        F.array(*[F.percentile_approx(c, 0.5, 1000) for c in FLOORS]).alias("middle"),
        F.array(
            *[
                F.greatest(F.lit(low), (F.percentile_approx(c, 0.75, 1000) - F.percentile_approx(c, 0.25, 1000)) / 1.349)
                for c, low in FLOORS.items()
            ]
        ).alias("width"),
    )
    gap = [(F.col(c) - F.col("middle")[i]) / F.col("width")[i] for i, c in enumerate(FLOORS)]
    near = both.join(sent(middles), "pool").withColumn(
        "within", (F.col("start") == 0) | (reduce(Column.__add__, [g * g for g in gap]) <= chi_square_quantile(0.5, SIZE))
    )
    present = stage(_with_inverse(near.where("within").groupBy("pool", "start").agg(*_moments())), "mcd")
    for _ in range(steps):
        placed = both.join(sent(present), ["pool", "start"]).withColumn("bin", _bin(_distance()))
        nearest = placed.join(sent(_bin_at(placed, share)), ["pool", "start"]).where("bin <= edge")
        before, present = present, stage(_with_inverse(nearest.groupBy("pool", "start").agg(*_moments())), "mcd")
        old = before.select("pool", "start", F.col("logdet").alias("old"), F.col("mean").alias("centre"))
        moved = F.exists(F.zip_with("mean", "centre", lambda x, y: F.abs(x - y)), lambda x: x > SETTLED)
        if present.join(old, ["pool", "start"]).where(moved | (F.abs(F.col("logdet") - F.col("old")) > SETTLED)).isEmpty():
            break
    best = present.groupBy("pool").agg(F.min(F.struct("logdet", "start", "mean", "triangle")).alias("b")).select("pool", "b.*")
    placed = vectors.join(sent(best), "pool").withColumn("bin", _bin(_distance()))
    median = F.exp((F.col("edge") + 1.0) / BINS_PER_UNIT) - 1.0
    scale = F.greatest(F.lit(1.0), median / chi_square_quantile(0.5, SIZE))
    return best.join(_bin_at(placed, 0.5).select("pool", scale.alias("scale")), "pool")


def pools(rows: DataFrame, least_rows: int) -> DataFrame:
    """(lang, source) to the pool whose estimate serves it."""
    counts = rows.groupBy("lang", "source").count()
    alone = F.col("count") >= least_rows
    language = counts.where(~alone).groupBy(F.col("lang").alias("of")).agg(F.sum("count").alias("together"))
    joined = counts.join(language, F.col("lang").eqNullSafe(F.col("of")) & ~alone, "left")
    own = F.to_json(F.struct(F.lit("group").alias("k"), "lang", "source"))
    shared = F.to_json(F.struct(F.lit("language").alias("k"), "lang"))
    name = F.when(alone, own).when(F.col("together") >= least_rows, shared).otherwise(F.lit("rest"))
    return joined.select("lang", "source", name.alias("pool"))


def judge(
    df: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_rows: int = 100,
    share: float = 0.75,
    steps: int = 5,
    confidence: float = 0.999,
) -> DataFrame:
    """Per document: counts, ``base_failed``, ``distance2`` (null without an estimate), and ``kept``.

    The estimates are made from documents that pass the base rules.
    """
    rows = stage(statistics(df, key, text, lang, source), "quality")
    groups = stage(pools(rows.where(~F.col("base_failed")), least_rows), "pools")
    group_count, pool_count = groups.agg(F.count(F.lit(1)), F.countDistinct("pool")).first()
    same = F.col("g.lang").eqNullSafe(F.col("r.lang")) & F.col("g.source").eqNullSafe(F.col("r.source"))
    placed = rows.withColumns(transformed()).alias("r").join(per_pool(groups, group_count).alias("g"), same, "left").select("r.*", "g.pool")
    vectors = placed.where(~F.col("base_failed")).select("pool", *FLOORS)
    small = vectors.where("pool = 'rest'").limit(least_rows).count() < least_rows
    if small:
        vectors = vectors.where("pool <> 'rest'")
    found = stage(estimates(vectors, pool_count, share=share, steps=steps), "estimates")
    out = placed.join(per_pool(found, pool_count), "pool", "left").withColumn("distance2", _distance() / F.col("scale"))
    near = F.coalesce(F.col("distance2") <= chi_square_quantile(confidence, SIZE), F.lit(True))
    return out.select(
        F.col("id").alias(key), *STATISTICS[:5], "base_failed", (~F.col("base_failed") & near).alias("kept"), "distance2"
    )
