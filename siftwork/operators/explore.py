"""Exploratory aggregates: distributions, box statistics, histograms, densities, rank correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from siftwork.functions.columns import col, melt_aggregates, numeric_columns
from siftwork.operators.group_quantiles import group_quantiles, joined_by_group
from siftwork.operators.quantiles import exact_quantiles
from siftwork.sources.shared import stage

TUKEY = 1.5
HOT_SHARE = 1_000
RANK_BUCKET_ROWS = 200_000
MAX_RANK_BUCKETS = 5_000


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per class, most frequent first."""
    counted = df.groupBy(col(column).alias("class")).agg(F.count(F.lit(1)).alias("rows"))
    # One row per class is left to add up.
    return counted.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy())).orderBy(F.desc("rows"), "class")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "value")
    )


def group_means(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else numeric_columns(df, exclude=[by])
    return df.groupBy(col(by)).agg(*[F.avg(col(c).cast("double")).alias(f"mean_{c}") for c in names])


def flag_distribution(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows with 0 and with 1 per flag; a side that never occurs counts 0."""
    rows = [
        (
            F.lit(f).alias("flag"),
            F.lit(v).alias("value"),
            F.count_if(col(f) == v).alias("rows"),
        )
        for f in flags
        for v in (0, 1)
    ]
    return melt_aggregates(df, rows)


def top_categories_by_class(df: DataFrame, column: str, target: str, classes: Sequence, n: int = 20) -> DataFrame:
    """The ``n`` most frequent categories with their rows per class."""
    counted = (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("category"))
        .agg(*[F.count_if(col(target) == c).alias(f"n_{c}") for c in classes], F.count(F.lit(1)).alias("total"))
    )
    return counted.orderBy(F.desc("total"), "category").limit(n)


def box_stats(df: DataFrame, columns: Sequence[str], by: str | None = None, whisker: float = TUKEY) -> DataFrame:
    """Quartiles, whisker ends (extreme rows inside the fences) and outlier count, per class and column.

    There may be any number of classes; ``df`` is read several times.
    """
    names = [f"{s}{i}" for i in range(len(columns)) for s in ("q1_", "q2_", "q3_", "lo_", "hi_")]
    if by is None:
        quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])[()]
        values = []
        for c in columns:
            q1, q2, q3 = quartiles[c]
            spread = None if q1 is None else whisker * (q3 - q1)
            values += [q1, q2, q3, None if q1 is None else q1 - spread, None if q1 is None else q3 + spread]
        fences = [F.lit(v).cast("double").alias(n) for n, v in zip(names, values)]
        joined, groups = df.select(*[col(c) for c in columns], *fences), []
    else:
        found = group_quantiles(df, columns, [0.25, 0.5, 0.75], [by])
        cells = []
        for i in range(len(columns)):
            q1, q2, q3 = (F.col(f"__q{i}")[j] for j in range(3))
            cells += [q1, q2, q3, q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)]
        fences = stage(found.select(col(by), "__n", *[c.alias(n) for n, c in zip(names, cells)]), "fences")
        rows = df.select(*[col(c) for c in dict.fromkeys([by, *columns])])
        joined, groups = joined_by_group(rows, [by], fences), [col(by)]
    packed = []
    for i, c in enumerate(columns):
        v, low, high = col(c).cast("double"), F.col(f"lo_{i}"), F.col(f"hi_{i}")
        inside = v.between(low, high)
        packed.append(
            F.struct(
                F.lit(c).alias("column"),
                F.max(f"q1_{i}").alias("q1"),
                F.max(f"q2_{i}").alias("median"),
                F.max(f"q3_{i}").alias("q3"),
                F.min(F.when(inside, v)).alias("whisker_low"),
                F.max(F.when(inside, v)).alias("whisker_high"),
                F.count_if(~inside).alias("outliers"),
            )
        )
    aggregated = joined.groupBy(*groups).agg(F.array(*packed).alias("r"))
    return aggregated.select(*groups, F.inline("r"))


KERNEL_REACH = 9.0


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins count 0."""
    v = col(column).cast("double")
    low, high = df.agg(F.min(v).alias("a"), F.max(v).alias("b")).collect()[0]
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, bin_low double, bin_high double, rows bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    index = F.least(F.floor((v - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counted = df.where(v.isNotNull()).groupBy(index.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counted, F.col("bin") == F.col("b"), "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"),
    )


def kernel_density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density on an even grid between the extremes, Scott bandwidth n^(-1/5) · s.

    A row adds to the grid points within ``KERNEL_REACH`` bandwidths only; what is left out is below 1e-17 of a row's
    peak. Bandwidths shrink as rows grow, so the work per row does too. Sums are combined in each task, so only
    ``points`` of them are moved.
    """
    v = col(column).cast("double")
    n, low, high, s = df.agg(F.count(v), F.min(v), F.max(v), F.stddev_samp(v)).collect()[0]
    spark = df.sparkSession
    if not n or n < 2 or not s:
        return spark.createDataFrame([], "point int, x double, density double")
    width = s * n ** (-0.2)
    step = (high - low) / (points - 1)
    scale = 1.0 / (n * width * (2 * 3.141592653589793) ** 0.5)
    place, reach = (v - F.lit(low)) / F.lit(step), F.lit(KERNEL_REACH * width / step)
    first = F.greatest(F.lit(0), F.ceil(place - reach).cast("int"))
    last = F.least(F.lit(points - 1), F.floor(place + reach).cast("int"))
    near = df.where(v.isNotNull()).select(v.alias("v"), F.explode(F.when(first <= last, F.sequence(first, last))).alias("p"))
    z = (F.col("v") - (F.lit(low) + F.col("p") * F.lit(step))) / F.lit(width)
    sums = near.groupBy("p").agg(F.sum(F.exp(F.lit(-0.5) * z * z)).alias("sum"))
    grid = spark.range(points).select(F.col("id").cast("int").alias("point"))
    return grid.join(sums, F.col("point") == F.col("p"), "left").select(
        "point", (F.lit(low) + F.col("point") * F.lit(step)).alias("x"), (F.coalesce("sum", F.lit(0.0)) * F.lit(scale)).alias("density")
    )


def _average_ranks(values: DataFrame) -> DataFrame:
    """(task, value, n) rows -> average rank of every distinct value inside its task.

    The input holds distinct values, so hot values are single rows. Values are
    cut into buckets at sketched quantiles; counts per bucket give the offsets
    and only one bucket at a time is ordered.
    """
    per_task = values.groupBy("task").agg(F.count(F.lit(1)).alias("d"))
    most = per_task.agg(F.max("d")).collect()[0][0] or 0
    buckets = min(MAX_RANK_BUCKETS, most // RANK_BUCKET_ROWS)
    if buckets > 1:
        probs = F.array(*[F.lit((i + 1) / (buckets + 1)) for i in range(buckets)])
        cuts = values.groupBy("task").agg(F.percentile_approx("value", probs, 10 * buckets).alias("cuts")).collect()
        # tasks x buckets numbers; both are bounded.
        table = F.broadcast(
            values.sparkSession.createDataFrame([(r["task"], r["cuts"]) for r in cuts], "task int, cuts array<double>")
        )
        position = F.size(F.filter(F.col("cuts"), lambda e: e < F.col("value")))
        values = stage(values.join(table, "task").withColumn("bucket", position).drop("cuts"), "rank-values")
    else:
        values = values.withColumn("bucket", F.lit(0))
    sizes = values.groupBy("task", "bucket").agg(F.sum("n").alias("bn"))
    before = F.sum("bn").over(
        Window.partitionBy("task").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("task", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    w = Window.partitionBy("task", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = values.withColumn("upto", F.sum("n").over(w))
    return upto.join(offsets, ["task", "bucket"]).select(
        "task",
        "value",
        "n",
        (F.col("offset") + F.col("upto") - (F.col("n") - 1) / F.lit(2.0)).alias("rank"),
    )


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every column pair (i > j), average ranks, pairwise complete.

    A column is ranked once, and again only for partners whose missing cells
    shrink its population. Ranks are computed on distinct values and attached to
    the rows by value: values holding more than a thousandth of a column form a
    small table (at most a thousand per ranking) that is broadcast; the others
    are joined by shuffle, where no key is hot any more. Rows need no key: each
    has a number that is written with the staged input.
    """
    names = list(columns)
    values = {c: col(c).cast("double") for c in names}
    narrow = stage(
        df.select(F.monotonically_increasing_id().alias("__row"), *[values[c].alias(f"v{i}") for i, c in enumerate(names)]), "rank-input"
    )
    pairs = [(i, j) for i in range(len(names)) for j in range(i)]
    both = {(i, j): F.col(f"v{i}").isNotNull() & F.col(f"v{j}").isNotNull() for i, j in pairs}
    counts = narrow.agg(
        *[F.count(f"v{i}").alias(f"c{i}") for i in range(len(names))],
        *[F.count_if(both[p]).alias(f"c{p[0]}_{p[1]}") for p in pairs],
    ).collect()[0]
    rankings: dict[tuple[int, int | None], int] = {}

    def ranking(i: int, partner: int, n_both: int) -> int:
        needed = (i, None if counts[f"c{i}"] == n_both else partner)
        return rankings.setdefault(needed, len(rankings))

    wanted = []
    for i, j in pairs:
        n = counts[f"c{i}_{j}"]
        wanted.append((i, j, ranking(i, j, n), ranking(j, i, n)))
    cells = []
    for (i, partner), task in rankings.items():
        value = F.col(f"v{i}") if partner is None else F.when(F.col(f"v{partner}").isNotNull(), F.col(f"v{i}"))
        cells.append(F.struct(F.lit(task).alias("task"), value.alias("value")))
    long = narrow.select("__row", F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    ranked = stage(
        _average_ranks(long.groupBy("task", "value").agg(F.count(F.lit(1)).alias("n"))), "ranks"
    )
    total = max([counts[f"c{i}"] for i in range(len(names))] or [0])
    is_hot = F.col("n") * HOT_SHARE > total
    hot = F.broadcast(ranked.where(is_hot).select("task", "value", "rank"))
    cold = ranked.where(~is_hot).select("task", "value", "rank")
    placed = long.join(hot, ["task", "value"]).unionByName(
        long.join(hot.select("task", "value"), ["task", "value"], "left_anti").join(cold, ["task", "value"])
    )
    wide = placed.groupBy("__row").agg(
        *[F.max(F.when(F.col("task") == t, F.col("rank"))).alias(f"r{t}") for t in range(len(rankings))]
    )
    rows = []
    for i, j, a, b in wanted:
        x, y = F.col(f"r{a}"), F.col(f"r{b}")
        paired = x.isNotNull() & y.isNotNull()
        spread = F.stddev_pop(F.when(paired, x)) * F.stddev_pop(F.when(paired, y))
        rho = F.try_divide(F.covar_pop(x, y), spread)
        rows.append((F.lit(names[i]).alias("column_a"), F.lit(names[j]).alias("column_b"), rho.alias("rho")))
    return melt_aggregates(wide, rows)


def head(df: DataFrame, key: str, columns: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """First ``n`` rows by key (a report, so the limit is the point)."""
    ordered = df.orderBy(col(key)).limit(n)
    return ordered if columns is None else ordered.select(*[col(c) for c in columns])


def stage_counts(df: DataFrame, stages: dict) -> DataFrame:
    """Rows left after each of a chain of conditions, counted in one scan.

    ``stages`` maps a stage name to the condition a row must also meet from there on.
    """
    rows, kept = [], F.lit(True)
    for i, (name, condition) in enumerate(stages.items()):
        kept = kept & condition
        rows.append((F.lit(i).alias("position"), F.lit(name).alias("stage"), F.count_if(kept).alias("rows")))
    start = (F.lit(-1).alias("position"), F.lit("input").alias("stage"), F.count(F.lit(1)).alias("rows"))
    counted = melt_aggregates(df, [start, *rows])
    # One row per stage.
    w = Window.partitionBy(F.lit(0)).orderBy("position")
    removed = F.lag("rows").over(w) - F.col("rows")
    first = F.first("rows").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counted.select(
        "position",
        "stage",
        "rows",
        F.coalesce(removed, F.lit(0)).alias("removed"),
        F.coalesce(F.try_divide((first - F.col("rows")) * F.lit(100.0), first), F.lit(0.0)).alias("removed_total_pct"),
    )

