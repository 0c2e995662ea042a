"""Principal components: one distributed fit, a variance threshold, a centred projection."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from siftwork.functions import presets
from siftwork.functions.columns import col, numeric_columns, quoted, require_columns
from siftwork.operators.state import FittedStage, OptionEstimator

VECTOR, PROJECTED = "__features", "__projected"


class ComponentColumns(FittedStage):
    """Centred, sign-fixed component columns plus the metadata; everything else is dropped."""

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        array = vector_to_array(F.col(PROJECTED))
        components = [
            ((array[i] - F.lit(float(offset))) * F.lit(float(sign))).alias(f"PC{i + 1}")
            for i, (offset, sign) in enumerate(zip(v["offsets"], v["signs"]))
        ]
        kept = [col(c) for c in v["metadata"] if c in df.columns]
        return df.select(*components, *kept)


class FeatureReducer(OptionEstimator):
    """Keeps the fewest components whose cumulative variance reaches the threshold, or a fixed number.

    When no prefix reaches the threshold all components stay. Each component's
    largest loading is made positive.
    """

    def __init__(
        self,
        variance_threshold: float = 0.95,
        n_components: int | None = None,
        metadata: list[str] | None = None,
    ):
        super().__init__()
        self.set_options(
            variance_threshold=variance_threshold,
            n_components=n_components,
            metadata=presets.METADATA_COLUMNS if metadata is None else list(metadata),
        )

    def _fit(self, df: DataFrame) -> PipelineModel:
        metadata = self.option("metadata")
        names = numeric_columns(df, exclude=metadata)
        if not numeric_columns(df):
            raise ValueError("the table has no number column to reduce")
        if not names:
            raise ValueError("every number column is metadata, nothing is left to reduce")
        # VectorAssembler reads dots in names as nesting, so feed it plain aliases.
        assembler = FeatureVector().with_state(columns=names)
        vectors = assembler.transform(df).select(VECTOR)
        full = PCA(k=len(names), inputCol=VECTOR, outputCol=PROJECTED).fit(vectors)
        ratios = full.explainedVariance.toArray()
        wanted = self.option("n_components")
        if wanted is not None:
            k = min(int(wanted), len(names))
        else:
            reached = np.flatnonzero(np.cumsum(ratios) >= self.option("variance_threshold"))
            k = int(reached[0]) + 1 if len(reached) else len(names)
        loadings = full.pc.toArray()
        signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])
        means = df.agg(*[F.avg(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(names)]).collect()[0]
        offsets = np.array([means[f"m{i}"] for i in range(len(names))]) @ loadings
        columns = ComponentColumns().with_state(
            offsets=offsets[:k].tolist(),
            signs=[float(s) or 1.0 for s in signs[:k]],
            metadata=metadata,
            features=names,
            ratios=ratios[:k].tolist(),
            all_ratios=ratios.tolist(),
            loadings=(loadings * signs)[:, :k].tolist(),
        )
        return PipelineModel([assembler, full, columns])


class FeatureVector(FittedStage):
    """Packs the fitted columns into one vector; refuses rows' tables that lack one of them."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.values["columns"]
        require_columns(df, names, "feature column")
        held = [f"__v{i}" for i in range(len(names))]
        wide = df.withColumns({h: col(c).cast("double") for h, c in zip(held, names)})
        packed = VectorAssembler(inputCols=held, outputCol=VECTOR, handleInvalid="error").transform(wide)
        return packed.drop(*held)


def component_info(model: PipelineModel) -> dict:
    return model.stages[-1].values


def variance_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Scree table: share and running share of variance per kept component."""
    ratios = component_info(model)["ratios"]
    rows = [(i + 1, float(r)) for i, r in enumerate(ratios)]
    # One row per component, bounded by the number of columns.
    running = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return spark.createDataFrame(rows, "component int, explained double").withColumn(
        "cumulative", F.sum("explained").over(running)
    )


def plane(df: DataFrame, target: str, classes: list) -> DataFrame:
    """PC1, PC2 and the class code (position in the sorted class list, -1 when absent)."""
    require_columns(df, ["PC1", "PC2", target])
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.expr(quoted(target))) - 1
    return df.select("PC1", "PC2", F.coalesce(code, F.lit(-1)).cast("int").alias("class_code"))
