"""Mixing to target weights with soft membership.

A classifier trained on the labelled documents gives every document posterior probabilities of the domains.  Documents
then get non-negative rates such that the expected tokens of each domain, the sum of rate, tokens and posterior, match
the targets as closely as least squares allows; a small ridge holds the rates near one, so documents of the same kind
get the same rate.  The rates are found by projected gradient steps.  A step needs one number per domain from the whole
table, which Spark sums; the rates themselves stay in the table.

Without given targets the domains' present shares are flattened by the power ``flatten``.  Tokens are words.

The classifier is a softmax regression on hashed words, trained with NumPy on at most ``max_labelled`` labelled documents,
those with the smallest hashes of their ids, and ``least_each`` of every domain that has fewer among these, so each labelled
domain is learned, however rare.  Null texts have no words: they get the posterior of an empty text and weigh
nothing.  Labelled rows with a null domain or id are not learned from.  Without any labelled row there is one domain.
Rows with equal ids are judged each by its own text.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.llm.common import find_words, fresh, slices, text_of, word_hashes, word_ids
from siftwork.sources.shared import stage

BUCKETS = 2048
ENTRIES = 250_000  # shares taken up at once while fitting


def word_shares(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shares of the hashed words that texts have: offsets of each text, buckets in ascending order, shares."""
    ids, offsets, names = word_ids([find_words(x) for x in texts])
    bucket = (word_hashes([x.lower() for x in names]) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(texts)), counts)
    cells, times = np.unique(owner * BUCKETS + bucket[ids], return_counts=True)
    row, held = np.divmod(cells, BUCKETS)
    return np.searchsorted(row, np.arange(len(texts) + 1)), held, times / counts[row]


@dataclass(frozen=True)
class DomainModel:
    domains: list[str]
    weights: np.ndarray
    base: np.ndarray

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities per text and domain, and the numbers of words."""
        ids, offsets, names = word_ids([find_words(x) for x in texts])
        bucket = (word_hashes([x.lower() for x in names]) % np.uint64(BUCKETS)).astype(np.int64)
        counts = np.diff(offsets)
        z = np.tile(self.base, (len(texts), 1))
        filled = np.flatnonzero(counts)
        if len(filled):
            for k in range(len(self.domains)):
                sums = np.add.reduceat(self.weights[bucket, k][ids], offsets[:-1][filled])
                z[filled, k] += sums / counts[filled]
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True), counts


def softmax_fit(
    offsets: np.ndarray, buckets: np.ndarray, shares: np.ndarray, y: np.ndarray, classes: int, *, epochs: int = 200, rate: float = 0.5, decay: float = 1e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and base of a softmax regression, by Adam on all rows at once.

    Rows are given by the shares that are not 0, and taken up some at a time, so that little is held beside them.
    """
    theta = np.zeros((classes, BUCKETS + 1))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    rows = len(y)
    cuts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], ENTRIES)), [0, rows]))
    for step in range(1, epochs + 1):
        slope = decay * theta
        slope[:, -1] = 0.0
        for low, high in zip(cuts[:-1], cuts[1:]):
            some = slice(offsets[low], offsets[high])
            at, share, counts = buckets[some], shares[some], np.diff(offsets[low : high + 1])
            filled = np.flatnonzero(counts)
            begins = (offsets[low:high] - offsets[low])[filled]
            z = np.repeat(theta[:, -1:], high - low, axis=1)
            if len(filled):
                for k in range(classes):
                    z[k, filled] += np.add.reduceat(theta[k][at] * share, begins)
            p = np.exp(z - z.max(axis=0))
            p /= p.sum(axis=0)
            p[y[low:high], np.arange(high - low)] -= 1.0
            p /= rows
            for k in range(classes):
                slope[k, :-1] += np.bincount(at, np.repeat(p[k], counts) * share, minlength=BUCKETS)
            slope[:, -1] += p.sum(axis=1)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    return np.ascontiguousarray(theta[:, :-1].T), theta[:, -1].copy()


def fit_domains(df: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", domain: str = "lang", max_labelled: int = 4000, least_each: int = 16) -> DomainModel:
    """Trains on documents that ``labels`` covers; their ``domain`` column is what is to be told from the text.

    At most ``max_labelled`` documents, and ``least_each`` of each domain that these leave short.
    """

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "body", 1_000_000):
            offsets, buckets, shares = word_shares(frame["body"].tolist())
            parts = [[x.tobytes() for x in np.split(v, offsets[1:-1])] for v in (buckets.astype("<u2"), shares.astype("<f4"))]
            yield frame[["id", "print", "domain"]].assign(buckets=parts[0], shares=parts[1])

    rows = df.select(
        F.col(f"`{key}`").cast("string").alias("id"),
        F.xxhash64(text_of(text)).alias("print"),
        F.col(f"`{domain}`").cast("string").alias("domain"),
        text_of(text).alias("body"),
    ).where("id IS NOT NULL AND domain IS NOT NULL")
    covered = labels.select(F.col(f"`{key}`").cast("string").alias("id")).distinct()
    ranked = rows.select("id", "print", "domain").join(covered, "id", "left_semi").distinct()
    chosen = [tuple(r) for r in ranked.orderBy(F.xxhash64(F.lit("domains"), "id"), "id", "print", "domain").limit(max_labelled).collect()]
    chosen += rare_rows(ranked, chosen, least_each)
    if not chosen:
        return DomainModel(["all"], np.zeros((BUCKETS, 1)), np.zeros(1))
    few = F.broadcast(df.sparkSession.createDataFrame(chosen, "id string, print long, domain string"))
    found = rows.join(few, ["id", "print", "domain"]).mapInPandas(features, "id string, print long, domain string, buckets binary, shares binary")
    once = found.groupBy("id", "print", "domain").agg(F.min(F.struct("buckets", "shares")).alias("words")).collect()
    once = sorted(once, key=lambda r: (r["id"], r["print"], r["domain"]))
    domains = sorted({r["domain"] for r in once})
    y = np.array([domains.index(r["domain"]) for r in once])
    offsets = np.append(0, np.cumsum([len(r["words"]["buckets"]) // 2 for r in once]))
    buckets = np.frombuffer(b"".join(r["words"]["buckets"] for r in once), "<u2")
    shares = np.frombuffer(b"".join(r["words"]["shares"] for r in once), "<f4")
    del once
    weights, base = softmax_fit(offsets, buckets, shares, y, len(domains))
    return DomainModel(domains, weights, base)


def rare_rows(ranked: DataFrame, chosen: list[tuple], least_each: int) -> list[tuple]:
    """Up to ``least_each`` further rows of every domain with fewer than that among the chosen: the least hash of each of so many cells."""
    held = Counter(d for _, _, d in chosen)
    enough = [d for d, n in held.items() if n >= least_each]
    cell = F.pmod(F.xxhash64(F.lit("cells"), "id", "print"), F.lit(least_each))
    first = F.min(F.struct(F.xxhash64(F.lit("domains"), "id").alias("h"), "id", "print")).alias("first")
    short = ranked.where(~F.col("domain").isin(enough)) if enough else ranked
    found = short.groupBy("domain", cell.alias("cell")).agg(first).select("first.id", "first.print", "domain")
    return sorted(set(map(tuple, found.collect())) - set(chosen))


def memberships(df: DataFrame, model: DomainModel, key: str, text: str) -> DataFrame:
    """Per row: id, print of the text, words, posterior."""

    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "body"):
            p, counts = model.posteriors(frame["body"].tolist())
            yield frame[["id", "print"]].assign(n_words=counts, posterior=list(p))

    rows = df.select(F.col(f"`{key}`").alias("id"), F.xxhash64(text_of(text)).alias("print"), text_of(text).alias("body"))
    return rows.mapInPandas(predict, f"id {df.schema[key].dataType.simpleString()}, print long, n_words long, posterior array<double>")


def _dot(vector: np.ndarray) -> Column:
    return reduce(Column.__add__, [F.col("posterior")[k] * float(v) for k, v in enumerate(vector)])


def _likeliest() -> Column:
    """Place of the likeliest domain, from 1."""
    return F.array_position("posterior", F.array_max("posterior")).cast("int")


def _wanted(domains: list[str], targets: dict[str, float] | None) -> Column:
    """Whether the likeliest domain has a positive target."""
    if targets is None:
        return F.lit(True)
    return _likeliest().isin([k for k, d in enumerate(domains, 1) if targets.get(d, 0.0) > 0])


def fit_rates(
    rows: DataFrame, domains: list[str], targets: dict[str, float] | None, *, flatten: float = 0.7, ridge: float = 1e-6, steps: int = 30, restage: int = 10, bounded: bool = False
) -> tuple[DataFrame, dict[str, float], dict[str, float]]:
    """``rows`` with ``rate``; the targets, and the expected shares that the rates give.

    ``bounded``: no rate falls below what the most reduced domain needs, but for documents of domains with target 0.
    """
    size = len(domains)
    sums = rows.agg(
        F.sum(F.col("n_words").cast("double")).alias("n"),
        *[F.sum(F.col("n_words") * F.col("posterior")[k]).alias(f"s{k}") for k in range(size)],
        *[F.sum(F.col("n_words") * F.col("posterior")[i] * F.col("posterior")[j]).alias(f"m{i}_{j}") for i in range(size) for j in range(i, size)],
    ).first()
    total = sums["n"] or 0.0
    if not total:
        return rows.withColumn("rate", F.lit(1.0)), {d: 0.0 for d in domains}, {d: 0.0 for d in domains}
    shares = np.array([sums[f"s{k}"] for k in range(size)]) / total
    if targets is None:
        wanted = np.maximum(shares, 1e-12) ** flatten
    else:
        wanted = np.array([float(targets.get(d, 0.0)) for d in domains])
        unknown = sorted(d for d, w in targets.items() if w and d not in domains)
        if unknown or (wanted < 0).any() or not wanted.sum():
            raise ValueError(f"targets must be non-negative and name labelled domains; not labelled: {unknown}")
    wanted = wanted / wanted.sum()
    moment = np.array([[sums[f"m{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)]) / total
    # Gaps are measured in the metric in which every domain is as easy to move; the gradient is then at most 1 + ridge steep.
    metric = np.linalg.pinv(moment, rcond=1e-9, hermitian=True)
    step = 1.0 / (1.0 + ridge)
    least = F.lit(0.0)
    if bounded:
        least = F.when(_wanted(domains, targets), float(min(w / s for w, s in zip(wanted, shares) if w > 0 and s > 0))).otherwise(0.0)
    present, rate, got = rows.withColumn("rate", F.lit(1.0)), F.col("rate"), shares
    for turn in range(1, steps + 1):
        gap = metric @ (got - wanted)
        rate = F.greatest(least, rate * (1 - step * ridge) + (step * ridge) - _dot(step * gap))
        if turn % restage == 0:
            # Ten steps make one expression; then the rates are written, so that it stays short.
            present, rate = stage(present.withColumn("rate", rate), "rates"), F.col("rate")
        weight = F.col("n_words") * rate
        now = present.agg(*[F.sum(weight * F.col("posterior")[k]) for k in range(size)]).first()
        before, got = got, np.array([x or 0.0 for x in now]) / total
        if np.abs(got - before).max() < 1e-9:
            break
    return present.withColumn("rate", rate), dict(zip(domains, wanted.tolist())), dict(zip(domains, got.tolist()))


def mix(
    df: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    domain: str = "lang",
    targets: dict[str, float] | None = None,
    flatten: float = 0.7,
    most_copies: float = 8.0,
) -> DataFrame:
    """Per row: key, ``n_words``, ``domain`` (the likeliest), ``posterior``, ``rate``, ``copies``.

    Copies follow the rates, scaled so that the smallest rate gives one copy.  If the largest would then give more than
    ``most_copies``, the rates are fitted again with a bound from below, so that a few documents that lie between domains
    don't multiply all others; the copies then follow from the targets alone.  Every document has a copy at least, but for
    those of domains with target 0.  Whole copies are certain; the rest of a rate is decided by a hash of id and text.
    """
    model = fit_domains(df, labels, key=key, text=text, domain=domain)
    rows = stage(memberships(df, model, key, text), "memberships")
    serves = _wanted(model.domains, targets)

    def rated_by(bounded: bool) -> tuple[DataFrame, float | None, float | None]:
        out = stage(fit_rates(rows, model.domains, targets, flatten=flatten, bounded=bounded)[0], "rated")
        return out, *out.where("n_words > 0").where(serves).agg(F.min("rate"), F.max("rate")).first()

    rated, low, high = rated_by(False)
    if low is not None and high > most_copies * low:
        rated, low, _ = rated_by(True)
    wanted = F.round(F.col("rate") * (1.0 / low if low else 1.0), 9)
    chance = F.pmod(F.xxhash64(F.lit("mix"), "id", "print"), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor(wanted) + F.when(chance < wanted - F.floor(wanted), 1).otherwise(0)).cast("int")
    # Texts without words weigh nothing, whatever their rates.
    copies = F.when(serves, F.greatest(copies, F.lit(1))).otherwise(copies)
    names = F.array(*map(F.lit, model.domains))
    likeliest = F.element_at(names, _likeliest())
    return rated.select(F.col("id").alias(key), "n_words", likeliest.alias("domain"), "posterior", "rate", copies.alias("copies"), "print")


def mixed(df: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df``, each as often as its copies say, with all their columns."""
    mark, times, turn = fresh(df, "print", "copies", "turn")
    found = mix(df, labels, key=key, text=text, **options).select(F.col(key).alias("k"), "print", F.col("copies").alias(times)).distinct().alias("m")
    rows = df.withColumn(mark, F.xxhash64(text_of(text))).alias("d")
    same = F.col(f"d.`{key}`").eqNullSafe(F.col("m.k")) & (F.col(f"d.`{mark}`") == F.col("m.print"))
    out = rows.join(found, same).where(F.col(times) > 0).withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times))))
    return out.select(*[F.col(f"d.`{c}`") for c in df.columns])
