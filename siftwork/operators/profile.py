"""Profiles of a table: missing values, cardinality, moments. One scan each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions.columns import col, melt_aggregates, numeric_columns, text_columns
from siftwork.operators.quantiles import exact_quantiles


def cell_digest(df: DataFrame, name: str) -> Column:
    """128 bits that stand for a cell; null for a missing one, one value for both zeros."""
    kind = dict(df.dtypes)[name]
    if kind in ("double", "float"):
        text = F.when(col(name) == 0, F.lit("0")).otherwise(col(name).cast("string"))
    elif kind.startswith(("array", "struct", "map")):
        text = F.when(col(name).isNotNull(), F.to_json(F.struct(col(name))))
    else:
        text = col(name)
    return F.unhex(F.md5(text if kind == "binary" else text.cast("string").cast("binary")))


def distinct_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per column (``__column``) its exact number of distinct values.

    Cells are reduced to digests and collapsed inside each task, so neither whole rows nor long texts are copied per
    column as several exact counts in one aggregate would.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("__column"), cell_digest(df, c).alias("__cell")) for c in names]))
    values = df.select(cells.alias("c")).select("c.*").where(F.col("__cell").isNotNull()).distinct()
    return values.groupBy("__column").agg(F.count(F.lit(1)).alias("__distinct"))


def with_distinct(profile: DataFrame, df: DataFrame, names: Sequence[str], approximate: bool = False) -> DataFrame:
    """``profile`` (one row per ``column``) with ``unique_values``."""
    if approximate:
        rows = [(F.lit(c).alias("__column"), F.approx_count_distinct(col(c)).alias("__distinct")) for c in names]
        counts = melt_aggregates(df, rows)
    else:
        counts = distinct_counts(df, names)
    joined = profile.join(counts, F.col("column") == F.col("__column"), "left")
    return joined.withColumn("unique_values", F.coalesce("__distinct", F.lit(0)).cast("bigint")).drop("__column", "__distinct")


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Per column: missing count, percentage (2 places), type, distinct values present."""
    names = list(columns) if columns is not None else df.columns
    types = dict(df.dtypes)
    rows = [
        (
            F.lit(c).alias("column"),
            (F.count(F.lit(1)) - F.count(col(c))).alias("missing_count"),
            F.round(
                F.coalesce(
                    F.try_divide((F.count(F.lit(1)) - F.count(col(c))) * F.lit(100.0), F.count(F.lit(1))), F.lit(0.0)
                ),
                2,
            ).alias("missing_percentage"),
            F.lit(types[c]).alias("dtype"),
        )
        for c in names
    ]
    return with_distinct(melt_aggregates(df, rows), df, names, approximate).orderBy(F.desc("missing_percentage"), "column")


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: unrounded missing percentage, largest first."""
    names = list(columns) if columns is not None else df.columns
    rows = [
        (
            F.lit(c).alias("column"),
            F.try_divide((F.count(F.lit(1)) - F.count(col(c))) * F.lit(100.0), F.count(F.lit(1))).alias("missing_pct"),
        )
        for c in names
    ]
    return melt_aggregates(df, rows).orderBy(F.desc("missing_pct"), "column")


def column_info(df: DataFrame) -> DataFrame:
    """Per column, in schema order: position, non-missing rows, type."""
    rows = [
        (F.lit(i).alias("position"), F.lit(c).alias("column"), F.count(col(c)).alias("non_null"), F.lit(t).alias("dtype"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return melt_aggregates(df, rows).orderBy("position")


def column_classes(df: DataFrame) -> DataFrame:
    """Per column: the type class used by the stages (number, text, other) and its non-missing rows."""
    numbers, texts = set(numeric_columns(df)), set(text_columns(df))
    rows = [
        (
            F.lit(c).alias("column"),
            F.lit("number" if c in numbers else "text" if c in texts else "other").alias("type_class"),
            F.count(col(c)).alias("non_null"),
        )
        for c in df.columns
    ]
    return melt_aggregates(df, rows)


def reconcile_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns against those the table has, with the rows each can supply."""
    rows = [
        (
            F.lit(c).alias("column"),
            F.lit(c in df.columns).alias("present"),
            (F.count(col(c)) if c in df.columns else F.lit(0).cast("bigint")).alias("non_null"),
        )
        for c in wanted
    ]
    return melt_aggregates(df, rows)


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: distinct values, nulls and their percentage, most missing first."""
    names = list(columns) if columns is not None else text_columns(df)
    rows = [
        (
            F.lit(c).alias("column"),
            (F.count(F.lit(1)) - F.count(col(c))).alias("nulls"),
            F.try_divide((F.count(F.lit(1)) - F.count(col(c))) * F.lit(100.0), F.count(F.lit(1))).alias("null_pct"),
        )
        for c in names
    ]
    wide = with_distinct(melt_aggregates(df, rows), df, names)
    return wide.select("column", "unique_values", "nulls", "null_pct").orderBy(F.desc("null_pct"), "column")


def distinct_samples(df: DataFrame, column: str, few: int = 10, sample: int = 5) -> DataFrame:
    """Distinct count of a column and its first values: up to ``few`` when it has no more, else ``sample``."""
    total = df.agg(F.count_distinct(col(column)).alias("n")).collect()[0]["n"]
    values = df.where(col(column).isNotNull()).select(col(column).alias("value")).distinct()
    shown = values.orderBy("value").limit(few if total <= few else sample)
    return shown.select(F.lit(column).alias("column"), F.lit(total).cast("bigint").alias("unique_values"), "value")


def column_extremes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: minimum and maximum."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return melt_aggregates(
        df,
        [
            (
                F.lit(c).alias("column"),
                F.min(col(c).cast("double")).alias("min"),
                F.max(col(c).cast("double")).alias("max"),
            )
            for c in names
        ],
    )


def adjusted_skewness(value: Column) -> Column:
    """Sample skewness with the bias correction n: g1 * sqrt(n(n-1)) / (n-2); 0 for a constant column."""
    n = F.count(value).cast("double")
    g1 = F.when(F.max(value) == F.min(value), F.lit(0.0)).otherwise(F.skewness(value))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def skewness_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else numeric_columns(df)
    return melt_aggregates(
        df,
        [(F.lit(c).alias("column"), adjusted_skewness(col(c).cast("double")).alias("skewness")) for c in names],
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min, exact quartiles, max."""
    names = list(columns) if columns is not None else numeric_columns(df)
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75]).get((), {})
    rows = []
    for c in names:
        v = col(c).cast("double")
        q = quartiles.get(c, [None] * 3)
        rows.append(
            (
                F.lit(c).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                *[F.lit(x).cast("double").alias(n) for x, n in zip(q, ("q1", "median", "q3"))],
                F.max(v).alias("max"),
            )
        )
    return melt_aggregates(df, rows)


def wide_text_columns(df: DataFrame, candidates: Sequence[str], limit: int, approximate: bool = False) -> list[str]:
    """Those candidates that hold more than ``limit`` distinct values."""
    names = [c for c in candidates if c in df.columns]
    if not names:
        return []
    if approximate:
        found = df.agg(*[F.approx_count_distinct(col(c)).alias(c) for c in names]).first().asDict()
    else:
        found = {r["__column"]: r["__distinct"] for r in distinct_counts(df, names).collect()}  # a row per column
    return [c for c in names if found.get(c, 0) > limit]
