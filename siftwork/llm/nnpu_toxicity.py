"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; text whose label is not looked at is the rest.  With the class prior ``p``,
a document of the rest counts as negative and the positives are subtracted again:
``p * loss(positives, 1) + max(0, loss(unlabelled, 0) - p * loss(positives, 0))``.  Where the second term falls below
zero, the step goes the other way, which keeps a flexible model from explaining the unlabelled toxic text away.

The inputs are the words of a text and their beginnings (so that unseen forms of a known stem count), by presence,
hashed to 32 bits.  Inputs that are commoner among positives than in the rest enter a linear model trained with NumPy on
a bounded sample: ``max_positive`` and ``max_unlabelled`` documents, those with the smallest hashes of their ids.  Scores
are then computed for all documents where they lie; the model is a few thousand numbers.

Null texts count as empty and get the model's base score; without any positives, or without any other text, every score
is 0.  Null ids are never in the sample.  Repeated ids or rows are scored each by itself.  Of several labels for one id
the largest counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siftwork.llm.common import find_words, slices, text_of
from siftwork.sources.shared import stage

STEMS = (3, 4, 5, 6)
MARKS = ".,;:!?¿¡\"'()[]{}«»„“”‘’…-–—*#$%&|<>_/\\"
FOLDS, HELD_OUT = 5, 0
MEMORY = 300_000


def word_inputs(word: str) -> tuple[int, ...]:
    """Hashes of a word without surrounding marks and of its beginnings."""
    import xxhash

    word = word.strip(MARKS).lower()
    if not word:
        return ()
    parts = ["=" + word, *[word[:k] for k in STEMS if len(word) >= k]]
    return tuple(xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) for p in parts)


@dataclass(frozen=True)
class Model:
    """Weights by input hash, and the base."""

    inputs: np.ndarray
    weights: np.ndarray
    base: float

    def scores(self, texts: list[str], memory: dict[str, tuple[int, ...]]) -> list[float]:
        """Probability of toxicity per text; ``memory`` holds, for words met before, the places of their inputs."""
        place = {int(h): i for i, h in enumerate(self.inputs)}
        weights = self.weights.tolist()
        out = []
        for text in texts:
            found: set[int] = set()
            for word in set(find_words(text)):
                hits = memory.get(word)
                if hits is None:
                    if len(memory) >= MEMORY:
                        memory.clear()
                    hits = memory[word] = tuple(place[h] for h in word_inputs(word) if h in place)
                if hits:
                    found.update(hits)
            z = self.base + sum(weights[i] for i in sorted(found))
            out.append(1.0 / (1.0 + math.exp(-z)) if z >= 0 else math.exp(z) / (1.0 + math.exp(z)))
        return out


def nnpu_fit(
    positive: np.ndarray, rest: np.ndarray, prior: float, *, epochs: int = 400, rate: float = 0.03, decay: float = 2e-4, batch: int = 1024, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and base of a linear model by the non-negative risk, with Adam over mini-batches of both samples."""
    rng = np.random.default_rng(seed)
    size = positive.shape[1]
    theta = np.zeros(size + 1)
    theta[size] = math.log(prior / (1.0 - prior))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    blocks = max(1, math.ceil(len(rest) / batch))
    epochs = max(40, epochs // blocks)

    def risk(x: np.ndarray, label: int) -> tuple[float, np.ndarray]:
        """Mean logistic loss and its gradient."""
        z = x @ theta[:size] + theta[size]
        sign = 1.0 if label else -1.0
        loss = np.logaddexp(0.0, -sign * z)
        pull = -sign / (1.0 + np.exp(np.clip(sign * z, -60, 60)))
        return float(loss.mean()), np.append(pull @ x, pull.sum()) / len(x)

    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(positive)), rng.permutation(len(rest))
        for p, u in zip(np.array_split(order_p, blocks), np.array_split(order_u, blocks)):
            if not len(p) or not len(u):
                continue
            _, as_positive = risk(positive[p], 1)
            wrong, as_negative = risk(positive[p], 0)
            whole, unlabelled = risk(rest[u], 0)
            if whole - prior * wrong >= 0:
                slope = prior * as_positive + unlabelled - prior * as_negative
            else:
                slope = prior * as_negative - unlabelled
            slope[:size] += decay * theta[:size]
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope * slope
            theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[size])


def tallied(positive: DataFrame, rest: DataFrame, least_count: int = 4) -> list[tuple]:
    """Input, and how many positives and how many of the rest have it; of those that ``least_count`` positives have."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known, times = np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in frame["inputs"]] or [np.empty(0, "<u4")]), return_counts=True)
            yield pd.DataFrame({"input": known.astype(np.int64), "n": times})

    none = F.lit(0).cast("long")
    one, other = (x.select("inputs").mapInPandas(count, "input long, n long") for x in (positive, rest))
    both = one.select("input", F.col("n").alias("p"), none.alias("u")).unionByName(other.select("input", none.alias("p"), F.col("n").alias("u")))
    sums = both.groupBy("input").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    return [tuple(r) for r in sums.where(F.col("p") >= least_count).collect()]


def select_inputs(tallies: list[tuple], positives: int, others: int, most: int) -> np.ndarray:
    """Hashes that are commoner among positives than in the rest, the most telling first; ties by hash."""
    known, in_p, in_u = np.array(tallies, np.int64).reshape(-1, 3).T
    known = known.astype(np.uint32)
    p, u = in_p / positives, in_u / others
    mean = (in_p + in_u) / (positives + others)
    spread = np.sqrt(mean * (1 - mean) * (1 / positives + 1 / others)) + 1e-12
    z = (p - u) / spread
    good = np.flatnonzero(z > 4.0)
    return known[good[np.lexsort((known[good], -z[good]))][:most]]


def presence(sample: DataFrame, inputs: np.ndarray) -> np.ndarray:
    """Rows by inputs, 1 where a row has the input; a bit per input travels."""

    def bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [np.packbits(np.isin(inputs, np.frombuffer(x, "<u4"))).tobytes() for x in frame["inputs"]]
            yield frame[["rank", "id", "print"]].assign(bits=found)

    # The order is fixed, for the mini-batches depend on it.
    rows = sorted(map(tuple, sample.mapInPandas(bits, "rank long, id string, print long, bits binary").collect()))
    out = np.empty((len(rows), len(inputs)), np.uint8)
    for i, row in enumerate(rows):
        out[i] = np.unpackbits(np.frombuffer(row[3], np.uint8), count=len(inputs))
    return out


def fold_of(key: str):
    """crc32 of the id as text, by the number of folds; row held out where it is 0."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


def sampled(rows: DataFrame, wanted: DataFrame, most: int) -> DataFrame | None:
    """Inputs of the ``most`` of the ``wanted`` (id, print) with the smallest hashes, staged; None without any.

    Ids and fingerprints are ranked by themselves, so texts of rows that aren't chosen don't move.  Only ids come to the driver.
    """

    def inputs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "body"):
            sets = [np.unique(np.array([h for w in set(find_words(x)) for h in word_inputs(w)], "<u4")) for x in frame["body"]]
            yield pd.DataFrame({"rank": frame["rank"], "id": frame["id"], "print": frame["print"], "inputs": [s.tobytes() for s in sets]})

    ranked = wanted.select("id", "print", F.xxhash64(F.lit("nnpu"), "id").alias("rank")).distinct()
    chosen = [tuple(r) for r in ranked.orderBy("rank", "id", "print").limit(most).collect()]
    if not chosen:
        return None
    few = rows.sparkSession.createDataFrame(chosen, "id string, print long, rank long")
    found = rows.join(F.broadcast(few), ["id", "print"]).mapInPandas(inputs, "rank long, id string, print long, inputs binary")
    # Copies of a row count once.
    return stage(found.groupBy("rank", "id", "print").agg(F.min("inputs").alias("inputs")), "toxicity-sample")


def fit(
    df: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_positive: int = 4000,
    max_unlabelled: int = 12_000,
    max_inputs: int = 1024,
    prior: float | None = None,
) -> Model:
    """Trains on rows outside the held-out fold; of the labels only the positives and the prior are used.

    ``prior`` is by default the share of positives among the labelled rows outside the held-out fold.
    """
    marks = (
        labels.select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{label}`").cast("int").alias("mark"))
        .where(F.col("id").isNotNull() & F.col("mark").isNotNull() & (fold_of("id") != HELD_OUT))
        .groupBy("id")
        .agg(F.max("mark").alias("mark"))
    )
    if prior is None:
        prior = marks.agg(F.avg((F.col("mark") == 1).cast("double"))).first()[0] or 0.0
    empty = Model(np.empty(0, np.uint32), np.empty(0), -math.inf)
    if prior <= 0:
        return empty
    prior = min(max(prior, 1e-4), 0.9)
    rows = df.select(F.col(f"`{key}`").cast("string").alias("id"), F.xxhash64(text_of(text)).alias("print"), text_of(text).alias("body"))
    rows = rows.where(F.col("id").isNotNull() & (fold_of("id") != HELD_OUT))
    names = rows.select("id", "print")
    positive = sampled(rows, names.join(marks.where("mark = 1").select("id"), "id", "left_semi"), max_positive)
    rest = sampled(rows, names, max_unlabelled)
    if positive is None or rest is None:
        return empty
    inputs = select_inputs(tallied(positive, rest), positive.count(), rest.count(), max_inputs)
    if not len(inputs):
        return Model(np.empty(0, np.uint32), np.empty(0), math.log(prior / (1 - prior)))
    weights, base = nnpu_fit(presence(positive, inputs), presence(rest, inputs), prior)
    return Model(inputs, weights, base)


def score(df: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: key, whether it is held out, score, and 1 where the score reaches ``threshold``.  One pass, no shuffle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory: dict[str, tuple[int, ...]] = {}
        for frame in slices(frames, "body"):
            yield pd.DataFrame({"id": frame["id"], "score": model.scores(frame["body"].tolist(), memory)})

    rows = df.select(F.col(f"`{key}`").alias("id"), text_of(text).alias("body"))
    out = rows.mapInPandas(run, f"id {df.schema[key].dataType.simpleString()}, score double")
    return out.select(
        F.col("id").alias(key),
        F.coalesce(fold_of("id") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(df: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that the model doesn't reject, with all their columns."""

    def run(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory: dict[str, tuple[int, ...]] = {}
        for body in bodies:
            yield pd.Series(model.scores(body.tolist(), memory), dtype="float64")

    return df.where(F.pandas_udf(run, "double")(text_of(text)) < threshold)
