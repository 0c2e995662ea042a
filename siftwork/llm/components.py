"""Connected components of a table of links, by alternating stars.

Every round links neighbours to the smallest node they know of, first along larger neighbours, then along smaller ones,
until each component is a star around its smallest node.  A round moves links only; it is written to the shared folder,
so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siftwork.sources.shared import stage


def connected(links: DataFrame, name: str = "links") -> DataFrame:
    """``links`` has columns a and b of one type; returns node and root (the smallest node) for all linked nodes."""
    near = F.least("a", "b").alias("v")
    far = F.greatest("a", "b").alias("u")
    edges = stage(links.where("a <> b").select(far, near).distinct(), name)
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), name)
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Number of links and a sum that changes with any of them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
