"""Near-duplicate vectors by an epsilon grid order join.

A cosine of at least ``threshold`` means a distance of at most epsilon between unit vectors, and so a difference of at
most epsilon along every direction.  The vectors are turned to their principal directions, put into grid cells of side
epsilon along the leading ones, and sorted by cell.  The sorted sequence is cut into blocks, and blocks into intervals
of 16, these again, and so on.  Starting with the whole sequence against itself, pairs of intervals are split and those
whose boxes are more than epsilon apart are dropped, level by level; each level is one Spark join.  Block pairs that are
left are compared with NumPy, candidates in single precision with a margin, then each exactly in double precision.

Equal vectors form one class, so copies cost nothing.  A pair of blocks returns sums and a spanning forest of its links,
never the links themselves, so a dense group of near copies stays linear.

Vectors that are null, empty, zero or hold a null, NaN or infinite component link with nothing, not even with themselves
in another row.  Shorter vectors count as filled up with zeros.  Rows with equal ids are judged each by its own vector.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from siftwork.llm.components import connected
from siftwork.sources.shared import stage

BLOCK = 2048
FAN = 4  # an interval holds 2**FAN of the level below
GRID = 4
BOX = 16
MARGIN = 1e-5


def unit_rows(blob: list[bytes], size: int) -> np.ndarray:
    """Unit vectors from packed doubles or singles, filled up with zeros."""
    out = np.zeros((len(blob), size))
    for i, b in enumerate(blob):
        v = np.frombuffer(b[1:], "<f8" if b[:1] == b"8" else "<f4")
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def packed(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Per row: id, packed vector (null if it can't link), and the class it belongs to."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blobs = []
            for v in frame["vector"]:
                v = np.array([np.nan if x is None else x for x in v] if v is not None else [], np.float64)
                if not len(v) or not np.isfinite(v).all() or not v.any():
                    blobs.append(None)
                    continue
                v = np.trim_zeros(v, "b") + 0.0
                with np.errstate(over="ignore"):
                    single = v.astype("<f4")
                exact = np.array_equal(single, v)
                blobs.append(b"4" + single.tobytes() if exact else b"8" + v.astype("<f8").tobytes())
            yield pd.DataFrame({"id": frame["id"], "blob": blobs})

    # Doubles lose nothing; values that single precision can't hold must not become infinite on the way.
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    out = rows.mapInPandas(pack, f"id {df.schema[key].dataType.simpleString()}, blob binary")
    return out.withColumn("node", F.unhex(F.md5("blob")))


def principal_axes(classes: DataFrame, size: int) -> np.ndarray:
    """Directions of the unit vectors, the widest first, from sums over all of them."""

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size))
        for frame in frames:
            x = unit_rows(frame["blob"].tolist(), size)
            total[:size] += x.T @ x
            total[size] += x.sum(axis=0)
        yield pd.DataFrame({"place": np.arange(total.size, dtype=np.int64), "part": total.ravel()})

    sums = classes.select("blob").mapInPandas(products, "place long, part double").groupBy("place").agg(F.sum("part").alias("s"))
    total = np.zeros(size * (size + 1))
    for row in sums.collect():  # size * (size + 1) numbers, whatever the number of rows
        total[row.place] = row.s
    total = total.reshape(size + 1, size)
    n = max(1.0, float(np.trace(total[:size])))
    mean = total[size] / n
    _, axes = np.linalg.eigh(total[:size] / n - np.outer(mean, mean))
    return axes[:, ::-1]


def sequence(classes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """Classes in grid order: node, copies, blob, coordinates, and the number of the block they fall in."""
    size, kept = axes.shape[0], min(BOX, axes.shape[1])
    lead = axes[:, :kept]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            y = unit_rows(frame["blob"].tolist(), size) @ lead
            out = frame[["node", "copies", "blob"]].copy()
            for i in range(kept):
                out[f"y{i}"] = y[:, i]
            yield out

    names = [f"y{i}" for i in range(kept)]
    placed = classes.mapInPandas(place, "node binary, copies long, blob binary, " + ", ".join(f"{c} double" for c in names))
    cells = [F.floor(F.col(c) / epsilon) for c in names[:GRID]]
    order = [*cells, F.col("y0"), F.col("node")]
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = placed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # The identifier grows within a partition in the order of the rows, its upper bits number the partitions.
    ranked = stage(ranges.withColumn("rank", F.monotonically_increasing_id()), "sequence")
    within, part = F.col("rank").bitwiseAND((1 << 33) - 1), F.shiftright("rank", 33)
    sizes = ranked.groupBy(part.alias("part")).count()
    before = {r.part: r["count"] for r in sizes.collect()}  # one number per partition
    starts, total = [], 0
    for p in sorted(before):
        starts.append((p, total))
        total += before[p]
    offsets = classes.sparkSession.createDataFrame(starts or [(0, 0)], "part long, start long")
    joined = ranked.withColumn("part", part.cast("long")).join(F.broadcast(offsets), "part")
    return joined.withColumn("block", F.floor((F.col("start") + within) / BLOCK)).drop("part", "start", "rank")


def blocks(ordered: DataFrame, kept: int) -> DataFrame:
    """One row per block: its vectors (bounded by ``BLOCK``) and its box."""
    names = [f"y{i}" for i in range(kept)]
    rows = F.sort_array(F.collect_list(F.struct("node", "copies", "blob"))).alias("rows")
    return ordered.groupBy("block").agg(rows, *[F.min(c).alias(f"lo{i}") for i, c in enumerate(names)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(names)])


def block_pairs(boxes: DataFrame, kept: int, count: int, epsilon: float) -> DataFrame:
    """Pairs of blocks whose boxes come within epsilon, found by splitting pairs of intervals."""
    spark = boxes.sparkSession
    levels = 0
    while count - 1 >> (FAN * levels):
        levels += 1
    pairs = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    limit = epsilon * epsilon * (1 + 1e-9) + 1e-12
    for level in range(max(0, levels - 1), -1, -1):
        low, high = [f"lo{i}" for i in range(kept)], [f"hi{i}" for i in range(kept)]
        at = boxes.groupBy(F.shiftright("block", FAN * level).alias("i")).agg(*[F.min(c).alias(c) for c in low], *[F.max(c).alias(c) for c in high])

        def side(name: str) -> DataFrame:
            return at.select(F.shiftright("i", FAN).alias(name), F.col("i").alias(f"{name}i"), *[F.col(c).alias(f"{name}{c}") for c in (*low, *high)])

        both = pairs.join(side("a"), "a").join(side("b"), "b").where("ai <= bi")
        gaps: list[Column] = [
            F.greatest(F.lit(0.0), F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}")) for i in range(kept)
        ]
        near = both.where(reduce(Column.__add__, [g * g for g in gaps]) <= limit)
        pairs = stage(near.select(F.col("ai").alias("a"), F.col("bi").alias("b")), "block-pairs")
    return pairs


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest member reachable from each of ``n`` nodes over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def compared(pairs: DataFrame, content: DataFrame, size: int, threshold: float) -> DataFrame:
    """Per block pair and vector with a link in it: node, number of linked rows, and a node to which it is linked."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b, left, right in zip(frame["a"], frame["b"], frame["rows_a"], frame["rows_b"]):
                rows = [*left] if a == b else [*left, *right]
                x = unit_rows([r["blob"] for r in rows], size)
                copies = np.array([r["copies"] for r in rows], np.int64)
                cut = 0 if a == b else len(left)
                single = x.astype(np.float32)
                i, j = np.nonzero(single[: len(left)] @ single[cut:].T >= threshold - MARGIN)
                j = j + cut
                fresh = i < j
                i, j = i[fresh], j[fresh]
                sure = np.concatenate([np.einsum("ij,ij->i", x[i[s : s + 65536]], x[j[s : s + 65536]]) for s in range(0, len(i), 65536)] or [np.empty(0)])
                i, j = i[sure >= threshold], j[sure >= threshold]
                links = np.bincount(i, weights=copies[j], minlength=len(rows)) + np.bincount(j, weights=copies[i], minlength=len(rows))
                root = forest(i, j, len(rows))
                hit = np.flatnonzero(links)
                node = [bytes(r["node"]) for r in rows]
                yield pd.DataFrame({"node": [node[k] for k in hit], "links": links[hit].astype(np.int64), "to": [node[root[k]] for k in hit]})

    both = pairs.join(content.select(F.col("block").alias("a"), F.col("rows").alias("rows_a")), "a")
    both = both.join(content.select(F.col("block").alias("b"), F.col("rows").alias("rows_b")), "b")
    return both.select("a", "b", "rows_a", "rows_b").mapInPandas(compare, "node binary, links long, to binary")


def near_vectors(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """Per row: key, ``n_links`` (other rows linked directly), ``component_id`` (smallest id reachable), ``kept``.

    ``threshold`` must be above 0.  A vector that can't link is its own component.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    rows = stage(packed(df, key, vector), "vectors")
    classes = stage(
        rows.where("blob IS NOT NULL").groupBy("node").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.min("blob").alias("blob")),
        "classes",
    )
    width = F.when(F.substring("blob", 1, 1) == F.lit(b"8"), 8).otherwise(4)
    size, n = classes.agg(F.max((F.octet_length("blob") - 1) / width), F.count(F.lit(1))).first()
    if not n:
        found = classes.select("node", F.lit(0).cast("long").alias("n_links"), F.col("class_id").alias("component_id"))
    else:
        size = int(size)
        axes = principal_axes(classes, size)
        kept = min(BOX, size)
        content = stage(blocks(sequence(classes.select("node", "copies", "blob"), axes, epsilon), kept), "blocks")
        pairs = block_pairs(content.drop("rows"), kept, math.ceil(n / BLOCK), epsilon)
        links = stage(compared(pairs, content, size, threshold), "links")
        roots = connected(links.select(F.col("node").alias("a"), F.col("to").alias("b")))
        sums = links.groupBy("node").agg(F.sum("links").alias("others"))
        named = classes.join(sums, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lowest = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
        found = named.join(lowest, "root").select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(found, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
