"""Column scaling fitted from one aggregate (plus exact quartiles for the robust kind)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siftwork.functions import presets
from siftwork.functions.columns import col, log1p_floor, numeric_columns
from siftwork.operators.quantiles import exact_quantiles
from siftwork.operators.state import FittedStage, OptionEstimator

METHODS = ("standard", "minmax", "robust", "auto")


class FeatureScaler(OptionEstimator):
    """Scales every numeric column that is not metadata.

    ``auto`` takes min-max for columns whose absolute population skewness is
    above the threshold and standard for the others. The log transform applies
    with the method ``standard`` only.
    """

    def __init__(
        self,
        method: str = "standard",
        skew_threshold: float = 1.0,
        exclude: Sequence[str] | None = None,
        log_columns: Sequence[str] | None = None,
    ):
        super().__init__()
        if method not in METHODS:
            raise ValueError(f"unknown scaling method {method!r}; one of {METHODS}")
        self.set_options(
            method=method,
            skew_threshold=skew_threshold,
            exclude=list(presets.METADATA_COLUMNS if exclude is None else exclude),
            log_columns=list(presets.LOG1P_BEFORE_STANDARD if log_columns is None else log_columns),
        )

    def _fit(self, df: DataFrame) -> "FeatureScalerModel":
        method = self.option("method")
        names = numeric_columns(df, exclude=self.option("exclude"))
        if not names:
            raise ValueError("nothing to scale: every number column is metadata")
        logged = set(self.option("log_columns")) if method == "standard" else set()
        values = {c: log1p_floor(col(c)) if c in logged else col(c).cast("double") for c in names}
        aggs = []
        for i, c in enumerate(names):
            v = values[c]
            parts = [F.min(v).alias("low"), F.max(v).alias("high")]
            if method in ("standard", "auto"):
                parts += [F.avg(v).alias("mean"), F.stddev_pop(v).alias("std")]
            if method == "auto":
                parts.append(F.skewness(v).alias("skew"))
            aggs.append(F.struct(*parts).alias(f"s{i}"))
        row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).collect()[0]
        quartiles = {}
        if method == "robust":
            quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75], n_rows=row["n"]).get((), {})
        threshold = self.option("skew_threshold")
        fitted = []
        for i, c in enumerate(names):
            s = row[f"s{i}"]
            kind = method
            constant = s["low"] is None or s["low"] == s["high"]
            if method == "auto":
                skewed = not constant and s["skew"] is not None and abs(s["skew"]) > threshold
                kind = "minmax" if skewed else "standard"
            if s["low"] is None:
                shift, divisor = 0.0, 1.0
            elif kind == "standard":
                shift, divisor = (s["low"], 1.0) if constant else (s["mean"], s["std"] or 1.0)
            elif kind == "minmax":
                shift, divisor = s["low"], (s["high"] - s["low"]) or 1.0
            else:
                q1, q2, q3 = quartiles[c]
                shift, divisor = q2, (q3 - q1) or 1.0
            fitted.append([c, kind, c in logged, shift, divisor])
        return FeatureScalerModel().with_state(columns=fitted, method=method)


class FeatureScalerModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        scaled = {}
        for c, _, logged, shift, divisor in self.values["columns"]:
            if c in df.columns:
                v = log1p_floor(col(c)) if logged else col(c).cast("double")
                scaled[c] = (v - F.lit(float(shift))) / F.lit(float(divisor))
        return df.withColumns(scaled) if scaled else df

    def parameters(self, spark) -> DataFrame:
        """The fitted table: column, kind, log flag, shift, divisor."""
        return spark.createDataFrame(
            [tuple(x) for x in self.values["columns"]],
            "column string, kind string, logged boolean, shift double, divisor double",
        )

    def kinds(self) -> dict[str, int]:
        counts: dict[str, int] = {}
        for _, kind, *_ in self.values["columns"]:
            counts[kind] = counts.get(kind, 0) + 1
        return counts
