"""Exact quantiles of very many groups, as tables from beginning to end.

Groups of up to ``GROUP_ROWS`` rows are answered by Spark's exact percentile, combined map-side; a task holds a bounded
number of bounded value counts.  Larger groups get brackets around the wanted ranks from a sketch.  Brackets are a table
with a row per group: rows are joined with it and counted below, at and inside every bracket, and the counts narrow the
brackets until few enough values lie inside to be read off.  Three or four passes do for any size, and a hot value costs
nothing, as it becomes an edge.  The driver learns only how many groups are still open.

Rows meet their group's row by a join.  Groups on more than a thousandth of all rows, fewer than a thousand by
arithmetic, are joined by broadcast; the others by shuffle, so no task gets a hot group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions.columns import col
from siftwork.sources.shared import stage

GROUP_ROWS = 20_000
GROUP_VALUES = 20_000
LEAST_VALUES = 100
ACCURACY = 1_000
GRID = 250
FEW_GROUPS = 10_000
HOT_GROUPS = 1_000


def joined_by_group(df: DataFrame, keys: Sequence[str], groups: DataFrame, size: str = "__n") -> DataFrame:
    """``df`` with the columns of ``groups``, which holds each group once with its number of rows; other rows go.

    Keys are compared as values, null included. The columns of ``groups`` beside the keys must be new to ``df``.
    """
    number, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()

    def met(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        named = some.select(*[col(k).alias(f"__on{i}") for i, k in enumerate(keys)], *[col(c) for c in some.columns if c not in keys])
        on = reduce(Column.__and__, [col(k).eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(keys)])
        return rows.join(F.broadcast(named) if how.startswith("broadcast ") else named, on, how.removeprefix("broadcast "))

    drop = [f"__on{i}" for i in range(len(keys))]
    if number <= FEW_GROUPS:
        return met(df, groups, "broadcast inner").drop(*drop)
    hot = F.col(size) > total / HOT_GROUPS
    often, seldom = groups.where(hot), groups.where(~hot)
    rest = met(df, often.select(*[col(k) for k in keys]), "broadcast left_anti")
    return met(df, often, "broadcast inner").drop(*drop).unionByName(met(rest, seldom, "inner").drop(*drop))


def group_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Per group: the key columns, ``__n`` (its rows) and ``__q0``, ``__q1`` .. (per column an array, a value per prob).

    Linear interpolation; missing values are ignored, a group without values of a column has nulls there. A null key is a
    group like any other, an empty table gives no rows. ``df`` is read several times.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    if not by or not columns or not probs:
        raise ValueError("key columns, columns and probs are needed")
    keys = [f"__k{i}" for i in range(len(by))]
    cells = [col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)]
    rows = df.select(*[col(b).alias(k) for b, k in zip(by, keys)], *cells)
    sizes = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), "group-sizes")
    large = sizes.where(F.col("__n") > GROUP_ROWS)
    if large.isEmpty():
        found = _percentiles(rows, keys, len(columns), probs)
    else:
        small = joined_by_group(rows, keys, sizes.where(F.col("__n") <= GROUP_ROWS)).drop("__n")
        found = _percentiles(small, keys, len(columns), probs).unionByName(_bracketed(rows, keys, large, len(columns), probs))
    return found.withColumnsRenamed(dict(zip(keys, by)))


def _percentiles(rows: DataFrame, keys: list[str], width: int, probs: list[float]) -> DataFrame:
    wanted = F.array(*[F.lit(p) for p in probs])
    nothing = F.array(*[F.lit(None).cast("double") for _ in probs])
    answers = [F.coalesce(F.percentile(f"__v{i}", wanted), nothing).alias(f"__q{i}") for i in range(width)]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *answers)


def _bracketed(rows: DataFrame, keys: list[str], large: DataFrame, width: int, probs: list[float]) -> DataFrame:
    slots = [(i, j) for i in range(width) for j in range(len(probs))]
    state = stage(_first_brackets(joined_by_group(rows, keys, large), keys, width, probs), "brackets")
    limit = max(GROUP_VALUES // len(slots), LEAST_VALUES)
    is_open = reduce(Column.__or__, [F.col(f"s{i}_{j}.open") for i, j in slots])
    closed = []
    while True:
        closed.append(state.where(~is_open))
        going = state.where(is_open)
        if going.isEmpty():
            break
        met = joined_by_group(rows, keys, going)
        kept = [F.first(c).alias(c) for c in state.columns if c not in keys]
        counts = [_counts(F.col(f"__v{i}"), F.col(f"s{i}_{j}"), limit).alias(f"r{i}_{j}") for i, j in slots]
        counted = met.groupBy(*keys).agg(*kept, *counts)
        # One expression for all slots, as an array: written out per slot it would be too large to compile.
        each = [F.struct(F.col(f"s{i}_{j}").alias("s"), F.col(f"r{i}_{j}").alias("r"), F.col(f"__edges{i}").alias("e")) for i, j in slots]
        judged = F.transform(F.array(*each), lambda x: F.struct(x["s"].alias("s"), x["r"].alias("r"), x["e"].alias("e"), _answer(x["s"], x["r"]).alias("a")))
        edges = [f"__edges{i}" for i in range(width)]
        narrowed = counted.select(*keys, "__n", *edges, F.transform(judged, lambda x: _narrowed(x["s"], x["r"], x["e"], x["a"])).alias("slots"))
        narrowed = stage(narrowed, "narrowed")
        state = narrowed.select(*keys, "__n", *edges, *[F.col("slots")[n].alias(f"s{i}_{j}") for n, (i, j) in enumerate(slots)])
    done = reduce(DataFrame.unionByName, closed)
    answers = [F.array(*[F.col(f"s{i}_{j}.answer") for j in range(len(probs))]).alias(f"__q{i}") for i in range(width)]
    return done.select(*keys, "__n", *answers)


def _state(rank: Column, fraction: Column, low: Column, high: Column, expected: Column, answer: Column, still: Column) -> Column:
    fields = dict(rank=rank, fraction=fraction, low=low, high=high, expected=expected, answer=answer, open=still)
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _first_brackets(rows: DataFrame, keys: list[str], width: int, probs: list[float]) -> DataFrame:
    margin = 2.0 / ACCURACY
    cuts = F.array(*[F.lit(x) for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))])
    sketches = []
    for i in range(width):
        v = F.col(f"__v{i}")
        sketch = F.percentile_approx(v, cuts, F.lit(ACCURACY))
        sketches.append(F.struct(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), sketch.alias("cuts")).alias(f"__edges{i}"))
    sketched = rows.groupBy(*keys).agg(F.first("__n").alias("__n"), *sketches)
    slots = []
    for i in range(width):
        e = F.col(f"__edges{i}")
        for j, p in enumerate(probs):
            position = (e["n"] - 1) * F.lit(p)
            rank = F.floor(position).cast("long")
            expected = (e["n"] * 8.0 / ACCURACY) + 8.0
            none = F.lit(None).cast("double")
            slots.append(_state(rank, position - rank, e["cuts"][2 * j], e["cuts"][2 * j + 1], expected, none, e["n"] > 0).alias(f"s{i}_{j}"))
    return sketched.select(*keys, "__n", *[f"__edges{i}" for i in range(width)], *slots)


def _counts(v: Column, s: Column, limit: int) -> Column:
    """Rows below, at and inside a bracket, the values next to it, and the inside's values or, if many, a grid of them."""
    inside = (v > s["low"]) & (v < s["high"]) & s["open"]
    few = s["expected"] <= limit
    grid = F.array(*[F.lit((i + 1) / (GRID + 1)) for i in range(GRID)])
    return F.struct(
        F.count_if(v < s["low"]).alias("below"),
        F.count_if(v == s["low"]).alias("at_low"),
        F.count_if(inside).alias("inside"),
        F.count_if((v == s["high"]) & (s["high"] > s["low"])).alias("at_high"),
        F.max(F.when(v < s["low"], v)).alias("before"),
        F.min(F.when(v > s["high"], v)).alias("after"),
        F.sort_array(F.collect_list(F.when(inside & few, v))).alias("values"),
        F.percentile_approx(F.when(inside & ~few, v), grid, F.lit(ACCURACY)).alias("grid"),
    )


def _answer(s: Column, r: Column) -> Column:
    """The quantile, where its rank and the next lie on known values; else null."""
    start = r["below"] + r["at_low"]
    end = start + r["inside"]

    def value_at(rank: Column) -> Column:
        return (
            F.when(rank == r["below"] - 1, r["before"])
            .when(rank < r["below"], None)
            .when(rank < start, s["low"])
            .when(rank < end, F.get(r["values"], (rank - start).cast("int")))
            .when(rank < end + r["at_high"], s["high"])
            .when(rank == end + r["at_high"], r["after"])
        )

    first = value_at(s["rank"])
    return F.when(s["fraction"] == 0, first).otherwise(first + s["fraction"] * (value_at(s["rank"] + 1) - first))


def _narrowed(s: Column, r: Column, e: Column, answer: Column) -> Column:
    """The bracket after a pass: answered, or with edges nearer to its rank."""
    start = r["below"] + r["at_low"]
    end = start + r["inside"]
    place = F.floor((s["rank"] - start) / F.greatest(r["inside"], F.lit(1)) * GRID).cast("int")

    def edge(at: Column, old: Column) -> Column:
        return F.coalesce(F.when(at >= 0, F.get(r["grid"], F.greatest(at, F.lit(0)))), old)

    on_left, on_right = s["rank"] < r["below"], s["rank"] >= end + r["at_high"]
    low = F.when(on_left, e["least"]).when(on_right, s["high"]).otherwise(edge(place - 2, s["low"]))
    high = F.when(on_left, s["low"]).when(on_right, e["most"]).otherwise(edge(place + 3, s["high"]))
    inside = F.when(on_left, r["below"].cast("double")).when(on_right, e["n"].cast("double")).otherwise(r["inside"] * 8.0 / GRID + 8.0)
    moved = _state(s["rank"], s["fraction"], low, high, inside, answer, F.lit(True))
    ended = _state(s["rank"], s["fraction"], s["low"], s["high"], s["expected"], F.coalesce(s["answer"], answer), F.lit(False))
    return F.when(~s["open"] | answer.isNotNull(), ended).otherwise(moved)
