"""Profiles that can be merged: one small row per column and batch, whatever the number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siftwork.functions.columns import col, melt_aggregates
from siftwork.operators.profile import cell_digest

SKETCH_BITS = 14
# Three standard errors of a sketch with 2 ** SKETCH_BITS registers.
SKETCH_ERROR = 3 * 0.833 / 2 ** (SKETCH_BITS / 2)


def sketched_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, rows, missing cells, a sketch of its distinct cells; numbers also have their extremes and sum."""
    types = dict(df.dtypes)
    rows = []
    for c in columns if columns is not None else df.columns:
        kind = types[c]
        number = col(c).cast("double") if kind in ("double", "float", "int", "bigint") or kind.startswith("decimal") else F.lit(None).cast("double")
        rows.append(
            (
                F.lit(c).alias("column"),
                F.lit(kind).alias("dtype"),
                F.count(F.lit(1)).alias("rows"),
                (F.count(F.lit(1)) - F.count(col(c))).alias("missing_count"),
                F.min(number).alias("least"),
                F.max(number).alias("greatest"),
                F.hll_sketch_agg(cell_digest(df, c), SKETCH_BITS).alias("cells"),
            )
        )
    return melt_aggregates(df, rows)


def merged_profile(profiles: DataFrame) -> DataFrame:
    """One profile of everything that the given ones were made of; distinct cells within ``SKETCH_ERROR``."""
    rows, missing = F.sum("rows"), F.sum("missing_count")
    return profiles.groupBy("column", "dtype").agg(
        rows.alias("rows"),
        missing.alias("missing_count"),
        F.round(F.coalesce(F.try_divide(missing * F.lit(100.0), rows), F.lit(0.0)), 2).alias("missing_percentage"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("cells")).alias("unique_values"),
    )
