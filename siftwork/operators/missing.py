"""Missing-value handling as an Estimator: drop columns, drop unlabelled rows, impute."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from siftwork.functions import presets
from siftwork.functions.columns import col, numeric_columns, require_columns, text_columns
from siftwork.operators.quantiles import exact_quantiles
from siftwork.operators.state import FittedStage, OptionEstimator


class MissingValueHandler(OptionEstimator):
    """Learns which columns to drop and what to fill.

    ``threshold`` is a share; a column goes when its missing percentage, rounded
    to two places, is strictly above it. Medians ignore rows without a target.
    ``keys`` are identifying numeric columns, which are never imputed.
    """

    def __init__(
        self,
        target: str = presets.TARGET,
        threshold: float = 0.95,
        constants: dict | None = None,
        keys: list[str] | None = None,
    ):
        super().__init__()
        self.set_options(
            target=target,
            threshold=threshold,
            constants=presets.CONSTANT_IMPUTES if constants is None else constants,
            keys=["code"] if keys is None else list(keys),
        )

    def _fit(self, df: DataFrame) -> "MissingValueModel":
        target = self.option("target")
        require_columns(df, [target], "target column")
        labelled = col(target).isNotNull()
        names = df.columns
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(labelled).alias("kept"),
            *[F.count_if(col(c).isNull()).alias(f"all{i}") for i, c in enumerate(names)],
            *[F.count_if(labelled & col(c).isNull()).alias(f"kept{i}") for i, c in enumerate(names)],
        ).collect()[0]
        limit = self.option("threshold") * 100
        share = {c: float(np.round(100 * row[f"all{i}"] / row["n"], 2)) if row["n"] else 0.0 for i, c in enumerate(names)}
        dropped = [c for c in names if share[c] > limit and c != target]
        gone = {*dropped, target}
        missing = {c: row[f"kept{i}"] for i, c in enumerate(names) if c not in gone}

        constants = self.option("constants")
        skip = {*gone, *self.option("keys")}
        numbers = [c for c in numeric_columns(df) if c not in skip]
        medians = [c for c in numbers if c not in constants]
        found = exact_quantiles(df.where(labelled), medians, [0.5], n_rows=row["kept"]).get((), {})
        fills: dict[str, dict] = {}
        for c in numbers:
            if c in constants:
                why = presets.RATIONALE_CONSTANT.get(c, "Fixed value")
                fills[c] = {"method": "constant", "value": constants[c], "rationale": why}
            elif found.get(c, [None])[0] is not None:
                fills[c] = {"method": "median", "value": found[c][0], "rationale": presets.RATIONALE_MEDIAN}
        for c in text_columns(df, exclude=gone):
            fills[c] = {"method": "constant", "value": "unknown", "rationale": presets.RATIONALE_TEXT}
        for c in fills:
            fills[c]["missing_count"] = missing[c]
        return MissingValueModel().with_state(target=target, dropped=dropped, fills=fills, shares=share)


class MissingValueModel(FittedStage):
    """Drop, filter and ``coalesce``: a projection with literal parameters."""

    @property
    def dropped_columns(self) -> list[str]:
        return self.values["dropped"]

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        types = {f.name: f.dataType for f in df.schema}
        out = df.drop(*v["dropped"])
        if v["target"] in types:
            out = out.where(col(v["target"]).isNotNull())
        filled = {}
        for c, fill in v["fills"].items():
            if c not in types or c in v["dropped"]:
                continue
            if fill["method"] == "median" and not isinstance(types[c], (T.DoubleType, T.FloatType)):
                filled[c] = F.coalesce(col(c).cast("double"), F.lit(float(fill["value"])))
            else:
                filled[c] = F.coalesce(col(c), F.lit(fill["value"]).cast(types[c]))
        return out.withColumns(filled) if filled else out

    def imputation_stats(self, df: DataFrame) -> DataFrame:
        """Columns that really had missing cells: method, value, count and reason."""
        rows = [
            (c, f["method"], str(f["value"]), int(f["missing_count"]), f["rationale"])
            for c, f in self.values["fills"].items()
            if f["missing_count"] > 0
        ]
        schema = "column string, method string, value string, missing_count bigint, rationale string"
        return df.sparkSession.createDataFrame(rows, schema)


def report_row(model: MissingValueModel, profile: DataFrame, threshold: float) -> DataFrame:
    """The imputation report as one nested row, ready for a JSON sink."""
    stats = model.imputation_stats(profile)
    packed_stats = stats.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct("column", F.struct("method", "value", "missing_count", "rationale").alias("statistics"))
                )
            )
        ).alias("imputation_statistics")
    )
    packed_profile = profile.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "column",
                        F.struct("missing_count", "missing_percentage", "dtype", "unique_values").alias("analysis"),
                    )
                )
            )
        ).alias("missing_value_analysis")
    )
    both = packed_stats.unionByName(packed_profile, allowMissingColumns=True)
    row = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return row.select(
        F.struct(
            F.lit(float(threshold)).alias("threshold_drop_feature"),
            F.lit("Drop features >95% missing, impute others based on type").alias("description"),
        ).alias("strategy"),
        F.array(*[F.lit(c) for c in model.dropped_columns]).cast("array<string>").alias("dropped_features"),
        "imputation_statistics",
        "missing_value_analysis",
    )
