"""Gradient boosting with the softmax loss, grown level by level on binned features.

A round grows one tree per class.  Rows lie in blocks of binned features with their margins; a round draws its rows and
keeps their bins, gradients and Hessians.  A level is one Spark job: every partition sums gradients and Hessians by (class,
node, feature, bin), of two sibling nodes only for the one with fewer rows; the other's sums are what is left of their
parent's.  As long as the sums of all partitions are small they are added up on the driver, which saves a shuffle per
level; else a shuffle adds them up.  Sums too large for the driver stay where they are, for all nodes: the best split of
every node is found there, and only that, a row per node and feature, comes to the driver.  Leaf values carry an L1 and an
L2 penalty, rows are sampled per round by a hash of the row, features per tree.  Blocks are an RDD: hundreds of short jobs
on the same few arrays need no query plan each.

A row's leaf is found without walking down: each feature's bin names a set of leaves that it leaves possible, as bits, and
all features' sets together leave one (six levels at a time, a word of 64 leaves).

Gradients are rounded to 2**-24 (whole numbers of single precision) and added as whole numbers, so for given edges a model
depends neither on partitions nor on their order.  Edges that aren't given come from a mergeable sketch, each within a ten-thousandth of its rank.
Margins are kept with the blocks, each round's on top of the last, and written every few rounds, so a lost executor costs
a few rounds' additions and no more.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, functions as F

from siftwork.operators.state import FittedStage, OptionEstimator
from siftwork.sources.shared import shared_dir, stage

register_pickle_by_value(sys.modules[__name__])

UNIT = float(1 << 24)
BLOCK_ROWS = 32_768
TASK_ROWS, TASK_MOST = 8_192, 1 << 22
ROUNDS_BETWEEN_WRITES = 10
EDGE_ACCURACY = 10_000
GATHERED_BYTES = 32 * 1024 * 1024
LEAF = -1
WORD_LEVELS = 6
HELD = StorageLevel.MEMORY_AND_DISK_DESER  # arrays as bytes: compressing them at every level costs more than it saves


def binned(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin of every cell, features in rows: the number of edges below the value; missing values get the last bin."""
    out = np.empty((x.shape[1], len(x)), np.uint8)
    for j, cuts in enumerate(edges):
        out[j] = np.searchsorted(np.asarray(cuts, float), x[:, j], side="left")
    return out


class Router(NamedTuple):
    """The upper levels of a tree: per feature and bin the leaves that stay possible, and the node of every leaf's place."""

    masks: list[tuple[int, np.ndarray]]
    nodes: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    below: int


def router(tree: dict, depth: int, bins_of: int) -> Router:
    """For trees split on ``depth`` levels at most."""
    feature, cut = np.asarray(tree["feature"]), np.asarray(tree["bin"])
    levels = min(depth, WORD_LEVELS)
    kind = np.dtype(f"u{max(1, 2**levels // 8)}")
    masks: dict[int, np.ndarray] = {}
    nodes = np.zeros(2**levels, np.int64)
    for level in range(levels + 1):
        first, width = 2**level - 1, 2 ** (levels - level)
        for k in range(2**level):
            node, low = first + k, k * width
            if level and feature[(node - 1) // 2] == LEAF:
                continue
            nodes[low : low + width] = node
            if level == levels or feature[node] == LEAF:
                continue
            half = (1 << (width // 2)) - 1
            mask = masks.setdefault(int(feature[node]), np.full(bins_of, np.iinfo(kind).max, kind))
            mask[: cut[node] + 1] &= kind.type(np.iinfo(kind).max ^ (half << (low + width // 2)))
            mask[cut[node] + 1 :] &= kind.type(np.iinfo(kind).max ^ (half << low))
    return Router(sorted(masks.items()), nodes, feature, cut, depth - levels)


def reached(bins: np.ndarray, way: Router, table: np.ndarray) -> np.ndarray:
    """Per row ``table``'s entry for the node that it reaches; rows stop at leaves and at nodes that aren't split yet.

    ``bins`` should be of the type for places, ``np.intp``: NumPy's ``take`` is several times slower for others.
    """
    if not way.masks:
        return np.full(bins.shape[1], table[0])
    (j, mask), *rest = way.masks
    left = mask.take(bins[j])
    for j, mask in rest:
        left &= mask.take(bins[j])
    place = np.bitwise_count((left & -left) - left.dtype.type(1)).astype(np.intp)
    if not way.below:
        return table[way.nodes].take(place)
    node = way.nodes.take(place)
    for _ in range(way.below):
        inner = np.flatnonzero(way.feature[node] != LEAF)
        if not len(inner):
            break
        at = node[inner]
        node[inner] = 2 * at + 1 + (bins[way.feature[at], inner] > way.cut[at])
    return table[node]


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of row hashes and a salt."""
    h = h ^ np.array([(salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF], np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_value(g, h, alpha: float, l2: float):
    """Minimum of g*w + (h + l2)*w*w/2 + alpha*|w|."""
    return -shrunk(g, alpha) / (h + l2)


def best_splits(g: np.ndarray, h: np.ndarray, alpha: float, l2: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain and bin (rows up to it go left) of the best split of every node (a row of bins) by one feature; the first of equal ones."""
    if g.shape[1] < 2:
        return np.full(len(g), -np.inf), np.zeros(len(g), int)
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    all_g, all_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h

    def score(a, b):
        return shrunk(a, alpha) ** 2 / (b + l2)

    gain = score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)
    # A side without rows is no split, whatever the least weight.
    gain = np.where((left_h >= least) & (right_h >= least) & (left_h > 0) & (right_h > 0), gain, -np.inf)
    at = gain.argmax(axis=1)
    return gain[np.arange(len(g)), at], at


BLOCKS = "n int, bins binary, label binary, row binary, margins binary"


class SoftmaxBooster(OptionEstimator):
    """Boosted trees over an ``array<double>`` column and a class code from 0.

    ``edges`` (a list per feature, ascending) replaces the quantiles at which features are cut into at most ``max_bins``.
    A row's hash for sampling is that of ``key``, without one that of its features and label.
    """

    def __init__(
        self,
        features: str = "features",
        label: str = "label",
        n_classes: int = 2,
        n_estimators: int = 100,
        max_depth: int = 6,
        learning_rate: float = 0.1,
        subsample: float = 0.8,
        colsample_bytree: float = 0.8,
        reg_alpha: float = 0.1,
        reg_lambda: float = 1.0,
        min_child_weight: float = 1.0,
        max_bins: int = 64,
        edges: list[list[float]] | None = None,
        key: str | None = None,
        seed: int = 42,
    ):
        super().__init__()
        if not 2 <= max_bins <= 256:
            raise ValueError("max_bins must be between 2 and 256")
        if edges is not None and any(len(e) > 255 for e in edges):
            raise ValueError("a feature can have at most 255 edges")
        self.set_options(
            features=features, label=label, n_classes=n_classes, n_estimators=n_estimators, max_depth=max_depth, learning_rate=learning_rate,
            subsample=subsample, colsample_bytree=colsample_bytree, reg_alpha=reg_alpha, reg_lambda=reg_lambda,
            min_child_weight=min_child_weight, max_bins=max_bins, edges=edges, key=key, seed=seed,
        )

    def _edges(self, df: DataFrame, width: int) -> list[list[float]]:
        if self.option("edges") is not None:
            return self.option("edges")
        bins = self.option("max_bins")
        probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
        cells = [F.nanvl(F.col("x")[j], F.lit(None).cast("double")) for j in range(width)]
        found = df.agg(*[F.percentile_approx(c, probs, EDGE_ACCURACY).alias(f"q{j}") for j, c in enumerate(cells)]).first()
        return [sorted(set(found[f"q{j}"] or [])) for j in range(width)]

    def _fit(self, df: DataFrame) -> "SoftmaxModel":
        opt = {n: self.option(n) for n in ("n_classes", "n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "reg_alpha", "reg_lambda", "min_child_weight", "seed")}
        features, label, key = self.option("features"), self.option("label"), self.option("key")
        rows = df.select(
            F.col(features).cast("array<double>").alias("x"),
            F.col(label).cast("int").alias("y"),
            (F.xxhash64(F.col(f"`{key}`")) if key else F.xxhash64(F.col(features), F.col(label))).alias("row"),
        ).where("y IS NOT NULL")
        rows = stage(rows, "boosting-rows")
        width, n = rows.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
        if not width or width < 1:
            raise ValueError("no rows to learn from")
        edges = self._edges(rows, width)
        context = df.sparkSession.sparkContext
        # A task should have enough rows to be worth a job per level, and all of them as many: starting one takes as long as
        # a level of half a million rows.
        parts = min(-(-n // TASK_ROWS), max(context.defaultParallelism, n // TASK_MOST))
        spread = rows.repartition(parts) if n > parts * TASK_ROWS else rows.coalesce(parts)
        bins_of = max(map(len, edges)) + 1
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_dir(df.sparkSession))
        blocks = packed(spread, edges, opt["n_classes"]).rdd.map(lambda r: tuple(map(bytes_or_int, r))).persist(HELD)
        # Written as it is dealt; a table read again would be dealt by its size.
        blocks.checkpoint()
        blocks.count()
        held = [blocks]
        trees: list[list[dict]] = []
        draw = np.random.default_rng(opt["seed"])
        for number in range(opt["n_estimators"]):
            rows_drawn = drawn(blocks, opt, number).persist(HELD)
            trees.append(grown(rows_drawn, opt, width, bins_of, draw))
            rows_drawn.unpersist()
            if number + 1 == opt["n_estimators"]:
                break
            blocks = advanced(blocks, trees[-1], opt, bins_of).persist(HELD)
            # Margins stay in memory or on the executors' disks; what is written cuts what a lost one would repeat.
            if (number + 1) % ROUNDS_BETWEEN_WRITES == 0:
                blocks.checkpoint()
            held.append(blocks)
            # The round before last is behind everything that is held.
            if len(held) > 2:
                held.pop(0).unpersist()
        for rest in held:
            rest.unpersist()
        return SoftmaxModel().with_state(features=features, edges=edges, depth=opt["max_depth"], trees=trees, n_classes=opt["n_classes"])


def packed(rows: DataFrame, edges: list, classes: int) -> DataFrame:
    """Rows as blocks: bins by feature, labels, hashes and margins, each as the bytes of an array."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), BLOCK_ROWS):
                some = frame.iloc[k : k + BLOCK_ROWS]
                x = np.array([np.asarray(v, float) for v in some["x"]])
                yield pd.DataFrame(
                    {
                        "n": [len(some)],
                        "bins": [binned(x, edges).tobytes()],
                        "label": [some["y"].to_numpy(np.int32).tobytes()],
                        "row": [some["row"].to_numpy(np.int64).tobytes()],
                        "margins": [np.zeros((classes, len(some))).tobytes()],
                    }
                )

    return rows.mapInPandas(pack, BLOCKS)


def bytes_or_int(cell):
    return bytes(cell) if isinstance(cell, bytearray) else cell


def unpacked(block: tuple, opt: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels, row hashes and margins of a block."""
    n, bins, label, row, margins = block
    bins = np.frombuffer(bins, np.uint8).reshape(-1, n)
    margins = np.frombuffer(margins).reshape(opt["n_classes"], n)
    return bins, np.frombuffer(label, np.int32), np.frombuffer(row, np.int64).view(np.uint64), margins


def advanced(blocks: RDD, trees: list[dict], opt: dict, bins_of: int) -> RDD:
    """The blocks with the trees' values added to their margins."""
    ways = [(router(tree, opt["max_depth"], bins_of), np.asarray(tree["value"])) for tree in trees]

    def run(block: tuple) -> tuple:
        bins, _, _, margins = unpacked(block, opt)
        bins = bins.astype(np.intp)
        more = [reached(bins, *way) for way in ways]
        return (*block[:4], (margins + np.array(more)).tobytes())

    return blocks.map(run)


def drawn(blocks: RDD, opt: dict, number: int) -> RDD:
    """A round's rows: their number, bins, and per class gradients and Hessians as whole numbers of ``UNIT``."""

    def run(block: tuple) -> tuple:
        bins, label, row, margins = unpacked(block, opt)
        taken = np.flatnonzero(mixed(row, opt["seed"] * 1_000_003 + number) < np.uint64(min(opt["subsample"], 1.0) * (2**64 - 2048)))
        p, label = softmax(margins.take(taken, axis=1)), label[taken]
        g = p - (label == np.arange(len(p))[:, None])
        h = np.maximum(2.0 * p * (1.0 - p), 1e-16)
        # At most 2**24 each, which single precision holds.
        whole = [np.rint(x * UNIT).astype(np.float32).tobytes() for x in (g, h)]
        return (len(taken), bins.take(taken, axis=1).tobytes(), *whole)

    return blocks.map(run)


def sampled_features(opt: dict, width: int, draw: np.random.Generator) -> list[list[int]]:
    """The features that each class's tree of a round may use, at least one."""
    most = max(1, int(opt["colsample_bytree"] * width))
    return [sorted(draw.choice(width, most, replace=False).tolist()) for _ in range(opt["n_classes"])]


def histograms(rows: RDD, growing: list[dict], built: list[list[int]], allowed: list[list[int]], opt: dict, bins_of: int) -> RDD:
    """Sums of gradients and Hessians (built nodes, bins) by class and feature, one of each from every partition.

    Beside them the number of rows, of the partition's first block only: enough to tell the larger of two nodes.
    """
    ways = []
    for tree, nodes in zip(growing, built):
        place = np.full(len(tree["feature"]), -1, np.int16 if len(nodes) < 32768 else np.int64)
        place[nodes] = np.arange(len(nodes))
        ways.append((router(tree, depth_of(nodes), bins_of), place))

    def sums(some: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for count, (n, *arrays) in enumerate(block for block in some if block[0]):
            bins = np.frombuffer(arrays[0], np.uint8).reshape(-1, n).astype(np.intp)
            gradients, hessians = (np.frombuffer(x, np.float32).reshape(-1, n) for x in arrays[1:])
            for c, nodes in enumerate(built):
                if not nodes:
                    continue
                g, h, size = gradients[c], hessians[c], len(nodes) * bins_of
                root = nodes == [0]
                if not root:
                    at = reached(bins, *ways[c])
                    mine = np.flatnonzero(at >= 0)
                    g, h, start = g.take(mine), h.take(mine), at.take(mine).astype(np.intp) * bins_of
                g, h = g.astype(float), h.astype(float)
                for j in allowed[c]:
                    spot = bins[j] if root else bins[j].take(mine) + start
                    if (c, j) not in held:
                        held[c, j] = np.zeros((3, size), np.int64)
                    into = held[c, j]
                    into[0] += np.bincount(spot, g, size).astype(np.int64)
                    into[1] += np.bincount(spot, h, size).astype(np.int64)
                    if not count:
                        into[2] += np.bincount(spot, minlength=size)
        for key, both in held.items():
            yield key, both.reshape(3, -1, bins_of)

    return rows.mapPartitions(sums)


def depth_of(nodes: list[int]) -> int:
    """Level of the nodes, 0 for the root."""
    return (max(nodes, default=0) + 1).bit_length() - 1


def offers(key: tuple[int, int], both: np.ndarray, opened: list[list[int]], opt: dict) -> list[dict]:
    """The best split of every open node of a class by one feature, with the sums of its left side and of the node."""
    c, j = key
    g, h = both[:2] / UNIT
    gain, at = best_splits(g, h, opt["reg_alpha"], opt["reg_lambda"], opt["min_child_weight"])
    out = []
    for i in np.flatnonzero(both[1].any(axis=1)).tolist():
        left = slice(int(at[i]) + 1)
        sums = dict(lg=float(g[i, left].sum()), lh=float(h[i, left].sum()), g=float(g[i].sum()), h=float(h[i].sum()))
        # Whether the left side has at most half of the counted rows.
        few = bool(2 * both[2, i, left].sum() <= both[2, i].sum())
        out.append({"class": c, "node": opened[c][i], "gain": float(gain[i]), "minus": -j, "bin": int(at[i]), "few": few, **sums})
    return out


Sums = dict[tuple[int, int], np.ndarray]


def with_siblings(found: Sums, built: list[list[int]], opened: list[list[int]], before: list[list[int]], parents: Sums) -> Sums:
    """Sums of all open nodes, from those of one of each two siblings and those of their parents."""
    out = {}
    for key, sums in found.items():
        at, above = {node: i for i, node in enumerate(built[key[0]])}, {node: i for i, node in enumerate(before[key[0]])}

        def of(node: int) -> np.ndarray:
            if node in at:
                return sums[:, at[node]]
            return parents[key][:, above[(node - 1) // 2]] - sums[:, at[node + 1 if node % 2 else node - 1]]

        out[key] = np.stack([of(node) for node in opened[key[0]]], axis=1)
    return out


def all_offers(
    rows: RDD, growing: list[dict], opened: list[list[int]], lesser: list[list[int]], allowed: list[list[int]], opt: dict, bins_of: int,
    before: list[list[int]], parents: Sums | None,
) -> tuple[list[dict], Sums | None]:
    """A row per open node and feature, and the sums of the open nodes if the driver can hold them.

    Few and small histograms are added up here, more or larger ones in a shuffle first.
    """
    parts = rows.getNumPartitions()

    def size(nodes: list[list[int]]) -> int:
        return sum(len(some) * len(mine) for some, mine in zip(nodes, allowed)) * bins_of * 24

    pairs = sum(len(nodes) > 0 for nodes in opened) * len(allowed[0])
    if size(opened) > GATHERED_BYTES:
        added = histograms(rows, growing, opened, allowed, opt, bins_of).reduceByKey(np.add, min(parts, pairs))
        return added.flatMap(lambda kv: offers(*kv, opened, opt)).collect(), None
    built = opened if parents is None else lesser
    found = histograms(rows, growing, built, allowed, opt, bins_of)
    if parts * size(built) > GATHERED_BYTES:
        found = found.reduceByKey(np.add, min(parts, pairs))
    held: Sums = {}
    for key, sums in found.collect():
        held[key] = held.get(key, 0) + sums
    if parents is not None:
        held = with_siblings(held, built, opened, before, parents)
    return [offer for kv in held.items() for offer in offers(*kv, opened, opt)], held


def grown(rows: RDD, opt: dict, width: int, bins_of: int, draw: np.random.Generator) -> list[dict]:
    """One tree per class as heaps: children of node i are 2i+1 and 2i+2."""
    depth, classes = opt["max_depth"], opt["n_classes"]
    size = 2 ** (depth + 1) - 1
    trees = [{"feature": [LEAF] * size, "bin": [0] * size, "value": [0.0] * size} for _ in range(classes)]
    allowed = sampled_features(opt, width, draw)
    opened, lesser, before, sums = [[0] for _ in range(classes)], [], [], None
    for _ in range(depth):
        if not any(opened):
            break
        found, sums = all_offers(rows, trees, opened, lesser, allowed, opt, bins_of, before, sums)
        # Of equal gains the first feature.
        best = {(r["class"], r["node"]): r for r in sorted(found, key=lambda r: (r["gain"], r["minus"]))}
        before, opened, lesser = opened, [[] for _ in range(classes)], [[] for _ in range(classes)]
        for _, r in sorted(best.items()):
            tree, node = trees[r["class"]], r["node"]
            value = lambda g, h: float(opt["learning_rate"] * leaf_value(g, h, opt["reg_alpha"], opt["reg_lambda"]))
            tree["value"][node] = value(r["g"], r["h"])
            if r["gain"] <= 1e-6:
                continue
            tree["feature"][node], tree["bin"][node] = -r["minus"], r["bin"]
            tree["value"][2 * node + 1] = value(r["lg"], r["lh"])
            tree["value"][2 * node + 2] = value(r["g"] - r["lg"], r["h"] - r["lh"])
            opened[r["class"]] += [2 * node + 1, 2 * node + 2]
            lesser[r["class"]].append(2 * node + (1 if r["few"] else 2))
    return trees


class SoftmaxModel(FittedStage):
    """Adds ``prediction`` (class code) and ``probability`` (array over the classes)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        edges, classes = v["edges"], v["n_classes"]
        held = df.sparkSession.sparkContext.broadcast(compact(v["trees"], v["depth"], max(map(len, edges)) + 1))

        @F.pandas_udf("array<double>")
        def shares(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            bins = binned(np.array([np.asarray(r, float) for r in x]), edges).astype(np.intp)
            margins = np.zeros((classes, len(x)))
            for trees in held.value:
                for c, tree in enumerate(trees):
                    margins[c] += reached(bins, *tree)
            return pd.Series(list(softmax(margins).T))

        shares = shares.asNondeterministic()  # evaluate once, wherever the result is used
        scored = df.withColumn("probability", shares(F.col(v["features"]).cast("array<double>")))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double"))

    def staged(self, df: DataFrame, rounds: Sequence[int], out: str) -> DataFrame:
        """``df`` with an array of the class codes predicted after the given numbers of rounds, in one reading of the trees."""
        v = self.values
        edges, classes = v["edges"], v["n_classes"]
        held = df.sparkSession.sparkContext.broadcast(compact(v["trees"][: max(rounds)], v["depth"], max(map(len, edges)) + 1))

        @F.pandas_udf("array<int>")
        def codes(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            bins = binned(np.array([np.asarray(r, float) for r in x]), edges).astype(np.intp)
            margins = np.zeros((classes, len(x)))
            best = np.zeros((len(x), len(rounds)), np.int32)
            for done, trees in enumerate(held.value, 1):
                for c, tree in enumerate(trees):
                    margins[c] += reached(bins, *tree)
                for i, n in enumerate(rounds):
                    if n == done:
                        best[:, i] = softmax(margins).argmax(axis=0)
            return pd.Series(list(best))

        codes = codes.asNondeterministic()
        return df.withColumn(out, codes(F.col(v["features"]).cast("array<double>")))

    def rounds(self, n: int) -> "SoftmaxModel":
        """The model as it was after the first ``n`` rounds."""
        return SoftmaxModel().with_state(**{**self.values, "trees": self.values["trees"][:n]})


def compact(trees: list, depth: int, bins_of: int) -> list:
    return [[(router(tree, depth, bins_of), np.asarray(tree["value"])) for tree in row] for row in trees]
