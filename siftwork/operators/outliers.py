"""Valid ranges, ordered rejection accounting and interquartile fences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions import presets
from siftwork.functions.columns import col, melt_aggregates, within
from siftwork.operators.quantiles import exact_quantiles
from siftwork.operators.state import FittedStage, OptionEstimator

FENCE = 3.0


def _known(df: DataFrame, ranges: Mapping) -> dict:
    return {c: tuple(r) for c, r in ranges.items() if c in df.columns}


def in_ranges(ranges: Mapping) -> Column:
    """Conjunction of closed intervals; missing values pass."""
    condition = F.lit(True)
    for c, (low, high) in ranges.items():
        condition = condition & within(col(c), low, high)
    return condition


def range_filter(df: DataFrame, ranges: Mapping = presets.VALID_RANGES) -> DataFrame:
    return df.where(in_ranges(_known(df, ranges)))


def first_reason(ranges: Mapping) -> Column:
    """Name of the first range a row breaks, null when it breaks none."""
    reason = F.lit(None).cast("string")
    for c, (low, high) in reversed(list(ranges.items())):
        reason = F.when(~within(col(c), low, high), F.lit(c)).otherwise(reason)
    return reason


def rejection_counts(df: DataFrame, ranges: Mapping = presets.VALID_RANGES) -> DataFrame:
    """Rows removed by each rule; a row is charged to the first rule it breaks."""
    return (
        df.select(first_reason(_known(df, ranges)).alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )


def fences(df: DataFrame, columns: list[str], multiplier: float = FENCE, n_rows: int | None = None) -> dict:
    """``{column: (q1, median, q3, lower fence, upper fence)}`` from exact quartiles."""
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75], n_rows=n_rows).get((), {})
    result = {}
    for c in columns:
        q1, q2, q3 = found.get(c, [None] * 3)
        if q1 is not None:
            result[c] = (q1, q2, q3, q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return result


def outlier_profile(df: DataFrame, ranges: Mapping = presets.VALID_RANGES) -> DataFrame:
    """Per ranged column: range violations, rows outside the fences, the fences, extremes and median."""
    known = _known(df, ranges)
    bounds = fences(df, list(known))
    rows = []
    for c, (low, high) in known.items():
        v = col(c).cast("double")
        _, median, _, lower, upper = bounds.get(c, (None,) * 5)
        outside = F.lit(False) if lower is None else (v < F.lit(lower)) | (v > F.lit(upper))
        rows.append(
            (
                F.lit(c).alias("column"),
                F.count_if(v < 0).alias("negative_count"),
                F.count_if(v < low).alias("below_min"),
                F.count_if(v > high).alias("above_max"),
                F.lit(float(low)).alias("range_min"),
                F.lit(float(high)).alias("range_max"),
                F.count_if(outside).alias("statistical_outliers"),
                F.lit(lower).cast("double").alias("iqr_lower"),
                F.lit(upper).cast("double").alias("iqr_upper"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
                F.lit(median).cast("double").alias("median"),
            )
        )
    return melt_aggregates(df, rows)


class OutlierFilter(OptionEstimator):
    """Keeps rows inside the valid ranges and, if asked, under the upper fence of every column.

    The fence is capped by the range maximum. Only the upper side is applied
    unless ``both_sides`` is set.
    """

    def __init__(self, ranges: Mapping | None = None, statistical: bool = False, both_sides: bool = False):
        super().__init__()
        chosen = presets.VALID_RANGES if ranges is None else ranges
        self.set_options(
            ranges=[[c, low, high] for c, (low, high) in chosen.items()],
            statistical=statistical,
            both_sides=both_sides,
        )

    def _fit(self, df: DataFrame) -> "OutlierFilterModel":
        ranges = {c: (low, high) for c, low, high in self.option("ranges") if c in df.columns}
        upper, lower = {}, {}
        if self.option("statistical"):
            for c, (_, _, _, low, high) in fences(df.where(in_ranges(ranges)), list(ranges)).items():
                upper[c] = min(high, ranges[c][1])
                if self.option("both_sides"):
                    lower[c] = max(low, ranges[c][0])
        return OutlierFilterModel().with_state(
            ranges=[[c, low, high] for c, (low, high) in ranges.items()], upper=upper, lower=lower
        )


class OutlierFilterModel(FittedStage):
    def _ranges(self) -> dict:
        return {c: (low, high) for c, low, high in self.values["ranges"]}

    def _under_fences(self) -> Column:
        v = self.values
        condition = F.lit(True)
        for c, high in v["upper"].items():
            condition = condition & (col(c).isNull() | (col(c) <= F.lit(high)))
        for c, low in v["lower"].items():
            condition = condition & (col(c).isNull() | (col(c) >= F.lit(low)))
        return condition

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.where(in_ranges(self._ranges()) & self._under_fences())

    def removal_summary(self, df: DataFrame) -> DataFrame:
        """Per rule: rows removed and why. A fence is listed only for columns whose range removed nothing."""
        v, ranges = self.values, self._ranges()
        in_range = in_ranges(ranges)
        reason = first_reason(ranges)
        rows = []
        for i, (c, (low, high)) in enumerate(ranges.items()):
            fence = v["upper"].get(c)
            above = F.lit(False) if fence is None else in_range & (col(c) > F.lit(fence))
            rows.append(
                (
                    F.lit(i).alias("position"),
                    F.lit(c).alias("column"),
                    F.count_if(reason == c).alias("by_range"),
                    F.count_if(above).alias("by_fence"),
                    F.lit(f"Outside valid range ({low}, {high})").alias("range_reason"),
                    F.lit("" if fence is None else f"Extreme statistical outlier (3*IQR, upper bound: {fence:.2f})").alias(
                        "fence_reason"
                    ),
                )
            )
        counted = melt_aggregates(df, rows)
        by_range = F.col("by_range") > 0
        return (
            counted.select(
                "position",
                "column",
                F.when(by_range, F.col("by_range")).otherwise(F.col("by_fence")).alias("count"),
                F.when(by_range, F.col("range_reason")).otherwise(F.col("fence_reason")).alias("reason"),
            )
            .where(F.col("count") > 0)
            .orderBy("position")
            .drop("position")
        )

    def removal_totals(self, df: DataFrame) -> DataFrame:
        """Rows before, after, removed, and the removed percentage (null on an empty table)."""
        kept = in_ranges(self._ranges()) & self._under_fences()
        counted = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after"))
        removed = F.col("rows_before") - F.col("rows_after")
        return counted.select(
            "rows_before",
            "rows_after",
            removed.alias("rows_removed"),
            F.try_divide(removed * F.lit(100.0), F.col("rows_before")).alias("removal_percentage"),
        )


def before_after(df: DataFrame, cleaned: DataFrame, ranges: Mapping = presets.VALID_RANGES) -> DataFrame:
    """The outlier profile of the table before and after cleaning, stacked."""
    return (
        outlier_profile(df, ranges)
        .select(F.lit("before_cleaning").alias("stage"), "*")
        .unionByName(outlier_profile(cleaned, ranges).select(F.lit("after_cleaning").alias("stage"), "*"))
    )
