"""The preparation flow: missing values, outliers, encoding, derived features, scaling, PCA."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from siftwork.functions import presets
from siftwork.functions.columns import col
from siftwork.operators.derive import FeatureDeriver
from siftwork.operators.encode import FeatureEncoder
from siftwork.operators.missing import MissingValueHandler
from siftwork.operators.outliers import OutlierFilter
from siftwork.operators.reduce import FeatureReducer
from siftwork.operators.scale import FeatureScaler


def preparation(
    target: str = presets.TARGET,
    missing_threshold: float = 0.95,
    top_n_labels: int = 15,
    scaling_method: str = "auto",
    skew_threshold: float = 1.0,
    variance_threshold: float = 0.95,
    statistical_outliers: bool = False,
    include_encoding: bool = True,
    include_features: bool = True,
    include_scaling: bool = True,
    include_pca: bool = True,
    feature_switches: Mapping[str, bool] | None = None,
    ranges: Mapping | None = None,
    encodings: Mapping[str, str] | None = None,
    rules: Mapping | None = None,
    metadata: Sequence[str] | None = None,
    constants: Mapping | None = None,
    log_columns: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
) -> Pipeline:
    """Stages in their fixed order; the last four can be switched off. Domain rules are arguments."""
    carried = list(presets.METADATA_COLUMNS if metadata is None else metadata)
    stages = [
        MissingValueHandler(target, missing_threshold, constants, list(keys) if keys is not None else None),
        OutlierFilter(ranges, statistical_outliers),
    ]
    if include_encoding:
        stages.append(FeatureEncoder(encodings, target, top_n_labels))
    if include_features:
        stages.append(FeatureDeriver(**(feature_switches or {}), rules=rules))
    if include_scaling:
        stages.append(FeatureScaler(scaling_method, skew_threshold, carried, log_columns))
    if include_pca:
        stages.append(FeatureReducer(variance_threshold, metadata=carried))
    return Pipeline(stages=stages)


def fit_preparation(flow: Pipeline, df: DataFrame, split: str = "split_group") -> PipelineModel:
    """Fit on the train rows when the table is split, on all rows otherwise."""
    train = df.where(col(split) == F.lit("train")) if split in df.columns else df
    return flow.fit(train)


def fit_transform(flow: Pipeline, df: DataFrame, split: str = "split_group") -> DataFrame:
    return fit_preparation(flow, df, split).transform(df)
