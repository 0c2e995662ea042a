"""Exact quantiles without sorting the table or holding a column in one task.

A first pass sketches every column (bounded size, combined map-side) and gives
a bracket of values around each wanted rank.  The next pass counts rows below,
at and inside every bracket, all columns in one aggregate.  When the bracket is
known to hold few rows its values come back with the counts and the rank is read
off; otherwise an inner sketch narrows the bracket by about a thousand times and
the pass repeats.  A trillion rows take three passes; nothing but counts,
sketches and a bounded handful of values is ever moved.  Hot values cost
nothing: a value that spans the rank becomes a bracket edge and is only counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions.columns import col, quoted

SKETCH_ACCURACY = 10_000
GRID = 1_000
SMALL_ROWS = 1_000_000
MAX_COLLECTED_VALUES = 1_000_000
MAX_GROUPS = 10_000


class _Bracket:
    """Search state of one wanted quantile."""

    def __init__(self, n: int, prob: float, low: float, high: float):
        position = (n - 1) * prob
        self.rank = int(position)
        self.fraction = position - self.rank
        self.low, self.high = low, high
        self.expected = 8 * n / SKETCH_ACCURACY + 8
        self.answer: float | None = None

    def order_statistic(self, rank: int, got) -> float | None:
        """Value at a zero-based rank, or None when it lies in the uncollected inside."""
        edges = got["below"]
        if rank == edges - 1:
            return got["before"]
        if rank < edges:
            return None
        if rank < edges + got["at_low"]:
            return self.low
        edges += got["at_low"]
        if rank < edges + got["inside"]:
            values = got["values"]
            return None if values is None else sorted(values)[rank - edges]
        edges += got["inside"]
        if rank < edges + got["at_high"]:
            return self.high
        return got["after"] if rank == edges + got["at_high"] else None

    def update(self, got, floor: float, ceiling: float) -> None:
        first = self.order_statistic(self.rank, got)
        second = first if self.fraction == 0 else self.order_statistic(self.rank + 1, got)
        if first is not None and second is not None:
            self.answer = first + self.fraction * (second - first)
            return
        start = got["below"] + got["at_low"]
        inside = got["inside"]
        if self.rank < got["below"]:
            self.low, self.high = floor, self.low
            self.expected = got["below"]
        elif self.rank >= start + inside + got["at_high"]:
            self.low, self.high = self.high, ceiling
            self.expected = float("inf")
        else:
            share = (self.rank - start) / max(inside, 1)
            grid = got["grid"] or []
            left, right = int(share * GRID) - 2, int(share * GRID) + 3
            if 0 <= left < len(grid):
                self.low = grid[left]
            if 0 <= right < len(grid):
                self.high = grid[right]
            self.expected = 8 * inside / GRID + 8


def _bracket_struct(value: Column, low: Column, high: Column, collect: bool) -> Column:
    inside = (value > low) & (value < high)
    probs = F.array(*[F.lit((i + 1) / (GRID + 1)) for i in range(GRID)])
    nothing = F.expr("cast(null as array<double>)")
    return F.struct(
        F.count_if(value < low).alias("below"),
        F.count_if(value == low).alias("at_low"),
        F.count_if(inside).alias("inside"),
        F.count_if((value == high) & (high > low)).alias("at_high"),
        F.max(F.when(value < low, value)).alias("before"),
        F.min(F.when(value > high, value)).alias("after"),
        (F.collect_list(F.when(inside, value)) if collect else nothing).alias("values"),
        (nothing if collect else F.percentile_approx(F.when(inside, value), probs, SKETCH_ACCURACY)).alias("grid"),
    )


def _collect_groups(df: DataFrame) -> list:
    rows = df.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups; quantiles are meant for a small set of classes")
    return rows


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    n_rows: int | None = None,
) -> dict[tuple, dict[str, list[float | None]]]:
    """Linear-interpolation quantiles per group: ``{group: {column: [value per prob]}}``.

    Missing values are ignored; a column without values gives None.  A small table
    is answered in one pass; ``n_rows`` saves counting it when the caller knows.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    if not columns:
        return {}
    keys = [col(b) for b in by]
    values = {c: col(c).cast("double") for c in columns}

    if n_rows is None:
        n_rows = df.count()
    if n_rows <= SMALL_ROWS:
        wanted = F.array(*[F.lit(p) for p in probs])
        aggs = [F.percentile(values[c], wanted).alias(f"q{i}") for i, c in enumerate(columns)]
        rows = _collect_groups(df.groupBy(*keys).agg(*aggs)) if by else df.agg(*aggs).collect()
        return {
            tuple(r[b] for b in by): {
                c: list(r[f"q{i}"]) if r[f"q{i}"] is not None else [None] * len(probs) for i, c in enumerate(columns)
            }
            for r in rows
        }

    margin = 2.0 / SKETCH_ACCURACY
    cuts = [x for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    wanted = F.array(*[F.lit(x) for x in cuts])
    aggs = [
        F.struct(
            F.count(values[c]).alias("n"),
            F.min(values[c]).alias("min"),
            F.max(values[c]).alias("max"),
            F.percentile_approx(values[c], wanted, SKETCH_ACCURACY).alias("cuts"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    sketched = _collect_groups(df.groupBy(*keys).agg(*aggs)) if by else df.agg(*aggs).collect()

    result: dict[tuple, dict[str, list[float | None]]] = {}
    state: dict[tuple, dict[tuple[int, int], _Bracket]] = {}
    bounds: dict[tuple, dict[int, tuple[float, float]]] = {}
    for row in sketched:
        group = tuple(row[b] for b in by)
        result[group] = {c: [None] * len(probs) for c in columns}
        state[group], bounds[group] = {}, {}
        for i in range(len(columns)):
            s = row[f"s{i}"]
            if s["n"] == 0:
                continue
            bounds[group][i] = (s["min"], s["max"])
            for j, p in enumerate(probs):
                state[group][i, j] = _Bracket(s["n"], p, s["cuts"][2 * j], s["cuts"][2 * j + 1])

    limit = MAX_COLLECTED_VALUES / max(1, len(columns) * len(probs))
    while True:
        open_ = {(i, j) for g in state.values() for (i, j), b in g.items() if b.answer is None}
        if not open_:
            break
        collectable = {
            slot: all(b[slot].expected <= limit for b in state.values() if slot in b and b[slot].answer is None)
            for slot in open_
        }
        slots = sorted(open_)
        rows = _refine(df, by, columns, values, state, slots, collectable)
        for row in rows:
            group = tuple(row[b] for b in by)
            for i, j in slots:
                bracket = state[group].get((i, j))
                if bracket is not None and bracket.answer is None:
                    bracket.update(row[f"r{i}_{j}"], *bounds[group][i])

    for group, slots_ in state.items():
        for (i, j), bracket in slots_.items():
            result[group][columns[i]][j] = bracket.answer
    return result


def _refine(df, by, columns, values, state, slots, collectable):
    if not by:
        only = state[()]
        aggs = [
            _bracket_struct(
                values[columns[i]], F.lit(only[i, j].low), F.lit(only[i, j].high), collectable[i, j]
            ).alias(f"r{i}_{j}")
            for i, j in slots
        ]
        return df.agg(*aggs).collect()
    # Group count was checked against MAX_GROUPS, so the bracket table is small.
    names = [f"__{side}{i}_{j}" for i, j in slots for side in ("lo", "hi")]
    table = []
    for group, brackets in state.items():
        edges = []
        for slot in slots:
            b = brackets.get(slot)
            edges += [None, None] if b is None or b.answer is not None else [b.low, b.high]
        table.append((*group, *edges))
    types = dict(df.select(*[col(b) for b in by]).dtypes)
    schema = ", ".join([f"__k{n} {types[b]}" for n, b in enumerate(by)] + [f"{n} double" for n in names])
    small = F.broadcast(df.sparkSession.createDataFrame(table, schema))
    on = [col(b).eqNullSafe(F.col(f"__k{n}")) for n, b in enumerate(by)]
    condition = on[0]
    for extra in on[1:]:
        condition = condition & extra
    needed = [col(b) for b in by] + [col(c) for c in columns if c not in by]
    joined = df.select(*needed).join(small, condition)
    aggs = [
        _bracket_struct(values[columns[i]], F.col(f"__lo{i}_{j}"), F.col(f"__hi{i}_{j}"), collectable[i, j]).alias(
            f"r{i}_{j}"
        )
        for i, j in slots
    ]
    return joined.groupBy(*[F.expr(quoted(b)) for b in by]).agg(*aggs).collect()
