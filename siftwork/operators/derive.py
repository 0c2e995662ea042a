"""Derived features: ratios, densities, contributions and threshold flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions import presets
from siftwork.functions.columns import above, col, safe_ratio, scaled_by
from siftwork.operators.state import OptionTransformer


def derived_columns(existing: Sequence[str], rules: Mapping) -> dict[str, Column]:
    """Expressions for every rule whose inputs exist."""
    have = set(existing)
    out: dict[str, Column] = {}
    for name, top, bottom in rules.get("ratios", []):
        if {top, bottom} <= have:
            out[name] = safe_ratio(col(top), col(bottom))
    for name, source, divisor in rules.get("densities", []):
        if source in have:
            out[name] = F.coalesce(col(source).cast("double") / F.lit(float(divisor)), F.lit(0.0))
    for name, source, factor in rules.get("contributions", []):
        if source in have:
            out[name] = scaled_by(col(source), factor)
    for name, source, threshold in rules.get("flags", []):
        if source in have:
            out[name] = above(col(source), threshold)
    for name, expression in rules.get("sql", []):
        out[name] = F.expr(expression)
    return out


class FeatureDeriver(OptionTransformer):
    """Adds all derived columns in one projection. Each family has its own switch.

    ``rules`` replaces the preset; its ``sql`` entries are (name, SQL expression) pairs.
    """

    def __init__(
        self,
        ratios: bool = True,
        density: bool = True,
        contributions: bool = True,
        flags: bool = True,
        rules: Mapping | None = None,
    ):
        super().__init__()
        chosen = rules or {
            "ratios": presets.RATIOS,
            "densities": presets.DENSITY,
            "contributions": presets.CONTRIBUTIONS,
            "flags": presets.FLAGS,
        }
        switches = {"ratios": ratios, "densities": density, "contributions": contributions, "flags": flags}
        self.set_options(rules={k: v for k, v in chosen.items() if switches.get(k, True)})

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = derived_columns(df.columns, self.option("rules"))
        return df.withColumns(columns) if columns else df
