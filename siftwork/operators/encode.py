"""Categorical encoders: multi-label indicators, one-hot, smoothed target means, label codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siftwork.functions import presets
from siftwork.functions.aliases import COUNTRY_ALIASES
from siftwork.functions.columns import col, melt_aggregates, require_columns
from siftwork.functions.labels import parse_labels
from siftwork.operators.state import FittedStage, OptionEstimator
from siftwork.sources.shared import shared_path, stage

MAX_LEVELS = 500
MAX_INLINE_LEVELS = 20_000


def top_labels(df: DataFrame, labels: Column, n: int) -> DataFrame:
    """The ``n`` most frequent labels of an array column; a label counts once per row, ties by name."""
    return (
        df.select(F.explode(F.array_distinct(labels)).alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "label")
        .limit(n)
    )


def indicator_columns(labels: Column, names: list[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per label. The label list is small and fixed, so this stays a projection."""
    return {f"{prefix}_{x}": F.coalesce(F.array_contains(labels, F.lit(x)).cast("int"), F.lit(0)) for x in names}


def level_list(df: DataFrame, column: str, limit: int = MAX_LEVELS) -> list:
    """Sorted distinct values; refuses a column with more than ``limit`` of them."""
    rows = df.where(col(column).isNotNull()).select(col(column).alias("v")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {column!r} has more than {limit} levels")
    return sorted(r["v"] for r in rows)


def onehot_columns(column: str, levels: list) -> dict[str, Column]:
    return {f"{column}_{x}": F.coalesce((col(column) == F.lit(x)).cast("double"), F.lit(0.0)) for x in levels}


def target_statistics(df: DataFrame, column: str, outcome: Column) -> DataFrame:
    """Smoothed mean of ``outcome`` per category: weight n·v / (n·v + v_category) on the category mean.

    One shuffle of at most one row per category and task; the global mean and
    variance come from the same per-category moments.
    """
    y = outcome.cast("double")
    per_category = (
        df.where(outcome.isNotNull())
        .groupBy(col(column).alias("category"))
        .agg(F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("variance"))
    )
    return per_category


def smoothed(n: Column, mean: Column, variance: Column, all_mean: Column, all_variance: Column) -> Column:
    weight = F.try_divide(n * all_variance, n * all_variance + variance)
    return F.when(all_variance == 0, all_mean).otherwise(weight * mean + (1 - weight) * all_mean)


def class_list(df: DataFrame, target: str) -> list:
    return level_list(df, target, MAX_LEVELS)


class FeatureEncoder(OptionEstimator):
    """Encodes each listed column by its method: ``multilabel``, ``onehot`` or ``target``.

    Columns the table lacks are skipped. ``class_index`` picks the class whose
    smoothed share encodes a category when the target has several classes
    (the first in order by default); ``per_class`` writes one column for each.
    """

    def __init__(
        self,
        methods: Mapping[str, str] | None = None,
        target: str = presets.TARGET,
        top_n: int = 15,
        target_kind: str = "auto",
        class_index: int | None = None,
        per_class: bool = False,
        aliases: Mapping[str, str] | None = None,
        max_levels: int = MAX_LEVELS,
    ):
        super().__init__()
        self.set_options(
            methods=list((presets.ENCODINGS if methods is None else methods).items()),
            target=target,
            top_n=top_n,
            target_kind=target_kind,
            class_index=class_index,
            per_class=per_class,
            aliases=None if aliases is None else dict(aliases),
            max_levels=max_levels,
        )

    def _fit(self, df: DataFrame) -> "FeatureEncoderModel":
        target = self.option("target")
        aliases = self.option("aliases") or COUNTRY_ALIASES
        plans = []
        for column, method in self.option("methods"):
            if column not in df.columns:
                continue
            if method == "multilabel":
                rows = top_labels(df, parse_labels(col(column), aliases), self.option("top_n")).collect()
                plans.append({"column": column, "method": method, "levels": [r["label"] for r in rows]})
            elif method == "onehot":
                plans.append(
                    {"column": column, "method": method, "levels": level_list(df, column, self.option("max_levels"))}
                )
            elif method == "target":
                if target not in df.columns:
                    raise ValueError(f"target encoding of {column!r} needs the column {target!r}")
                plans.extend(self._target_plans(df, column, target))
            else:
                raise ValueError(f"unknown encoding method {method!r}")
        return FeatureEncoderModel().with_state(plans=plans, aliases=self.option("aliases"))

    def _target_plans(self, df: DataFrame, column: str, target: str) -> list[dict]:
        if is_continuous(df, target, self.option("target_kind")):
            return [_continuous_plan(df, column, col(target))]
        classes = class_list(df, target)
        if not classes:
            raise ValueError(f"target column {target!r} has no values")
        if self.option("per_class"):
            plans = _class_plans(df, column, target, {c: f"{column}_{c}" for c in classes})
            plans[-1]["drop"] = True
            return plans
        index = self.option("class_index")
        chosen = index if index is not None else (1 if len(classes) == 2 else 0)
        return _class_plans(df, column, target, {classes[chosen]: None})


def is_continuous(df: DataFrame, target: str, kind: str) -> bool:
    """Whether target encoding averages the target itself rather than the share of a class."""
    return kind == "continuous" or (
        kind == "auto" and isinstance(df.schema[target].dataType, (T.DoubleType, T.FloatType, T.DecimalType))
    )


def _class_plans(df: DataFrame, column: str, target: str, outputs: Mapping) -> list[dict]:
    """Smoothed share of each class per category: the rows are read once for all classes."""
    stats = stage(
        df.where(col(target).isNotNull())
        .groupBy(col(column).alias("category"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(col(target) == F.lit(c)).alias(f"h{i}") for i, c in enumerate(outputs)],
        ),
        "category-counts",
    )
    totals = stats.agg(F.sum("n").alias("n"), *[F.sum(f"h{i}").alias(f"h{i}") for i in range(len(outputs))]).first()
    plans = []
    for i, out in enumerate(outputs.values()):
        share = totals[f"h{i}"] / totals["n"] if totals["n"] else 0.0
        mean = F.col(f"h{i}") / F.col("n")
        value = smoothed(F.col("n"), mean, mean * (1 - mean), F.lit(share), F.lit(share * (1 - share)))
        plans.append(_plan(stats, column, value, out, share))
    return plans


def _continuous_plan(df: DataFrame, column: str, outcome: Column) -> dict:
    y = outcome.cast("double")
    totals = df.agg(F.avg(y).alias("m"), F.var_pop(y).alias("v")).first()
    mean, variance = totals["m"] or 0.0, totals["v"] or 0.0
    stats = target_statistics(df, column, outcome)
    value = smoothed(F.col("n"), F.col("mean"), F.col("variance"), F.lit(mean), F.lit(variance))
    return _plan(stats, column, value, None, mean)


def _plan(stats: DataFrame, column: str, value: Column, out: str | None, mean: float) -> dict:
    """A lookup kept in the model while it is small, as a table in the shared folder otherwise."""
    encoded = stats.where(F.col("category").isNotNull()).select(
        F.col("category").cast("string").alias("category"), value.alias("value")
    )
    rows = encoded.limit(MAX_INLINE_LEVELS + 1).collect()
    plan = {"column": column, "method": "target", "out": out, "mean": mean}
    if len(rows) > MAX_INLINE_LEVELS:
        path = shared_path(stats.sparkSession, "levels")
        encoded.write.parquet(path)
        return {**plan, "path": path}
    return {**plan, "levels": [[r["category"], r["value"]] for r in rows]}


class FeatureEncoderModel(FittedStage):
    """Levels live here, so the output columns are fixed and new rows need no look at the data."""

    def tables(self) -> dict[str, str]:
        return {f"levels{i}": plan["path"] for i, plan in enumerate(self.values["plans"]) if "path" in plan}

    def with_tables(self, folders: dict[str, str]) -> "FeatureEncoderModel":
        v = self.values
        plans = [{**p, "path": folders[f"levels{i}"]} if "path" in p else p for i, p in enumerate(v["plans"])]
        return self.with_state(**{**v, "plans": plans})

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        aliases = v["aliases"] or COUNTRY_ALIASES
        out = df
        for plan in v["plans"]:
            c = plan["column"]
            if c not in out.columns:
                continue
            if plan["method"] == "multilabel":
                held = "__labels"
                marks = indicator_columns(F.col(held), plan["levels"], c)
                out = out.withColumn(held, parse_labels(col(c), aliases)).withColumns(marks).drop(held, c)
            elif plan["method"] == "onehot":
                out = out.withColumns(onehot_columns(c, plan["levels"])).drop(c)
            else:
                out = self._encode_target(out, plan)
                if plan.get("drop"):
                    out = out.drop(c)
        return out

    @staticmethod
    def _encode_target(df: DataFrame, plan: dict) -> DataFrame:
        c = plan["column"]
        if "path" in plan:
            levels = df.sparkSession.read.parquet(plan["path"])
        else:
            rows = [tuple(x) for x in plan["levels"]]
            # At most MAX_INLINE_LEVELS rows.
            levels = F.broadcast(df.sparkSession.createDataFrame(rows, "category string, value double"))
        levels = levels.select(F.col("category").alias("__category"), F.col("value").alias("__value"))
        joined = df.join(levels, col(c).cast("string") == F.col("__category"), "left")
        value = F.coalesce("__value", F.lit(float(plan["mean"])))
        return joined.withColumn(plan["out"] or c, value).drop("__category", "__value")


def out_of_fold_target(df: DataFrame, column: str, outcome: Column, fold: str, out: str) -> DataFrame:
    """Target encoding where each row is encoded from the other folds, so its own outcome never leaks in."""
    y = outcome.cast("double")
    zero = F.lit(0.0)
    # Every category and fold of the input has a cell, also those without any outcome.
    cells = stage(
        df.groupBy(col(column).alias("__c"), col(fold).alias("__f")).agg(
            F.count(y).alias("n"), F.coalesce(F.sum(y), zero).alias("s"), F.coalesce(F.sum(y * y), zero).alias("q")
        ),
        "cells",
    )
    held = cells.select("__c", "__f", "n", "s", "q")
    totals = cells.groupBy("__c").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"), F.sum("q").alias("tq"))
    folds = cells.groupBy("__f").agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"), F.sum("q").alias("fq"))
    overall = folds.collect()
    an, as_, aq = (sum(r[x] for r in overall) for x in ("fn", "fs", "fq"))
    by_fold = F.broadcast(
        df.sparkSession.createDataFrame(
            [(r["__f"], float(an - r["fn"]), float(as_ - r["fs"]), float(aq - r["fq"])) for r in overall],
            f"__g {dict(df.dtypes)[fold]}, gn double, gs double, gq double",
        )
    )
    rest = (
        held.join(totals.withColumnRenamed("__c", "__t"), F.col("__c").eqNullSafe(F.col("__t")))
        .join(by_fold, F.col("__f").eqNullSafe(F.col("__g")))
        .select(
            "__c",
            "__f",
            (F.col("tn") - F.col("n")).alias("n"),
            (F.col("ts") - F.col("s")).alias("s"),
            (F.col("tq") - F.col("q")).alias("q"),
            F.try_divide(F.col("gs"), F.col("gn")).alias("m"),
            F.try_divide(F.col("gq"), F.col("gn")).alias("mq"),
        )
    )
    mean = F.try_divide(F.col("s"), F.col("n"))
    variance = F.greatest(F.try_divide(F.col("q"), F.col("n")) - mean * mean, F.lit(0.0))
    all_variance = F.greatest(F.col("mq") - F.col("m") * F.col("m"), F.lit(0.0))
    value = F.coalesce(smoothed(F.col("n"), mean, variance, F.col("m"), all_variance), F.col("m"))
    table = rest.select("__c", "__f", value.alias("__v"))
    return (
        df.join(table, col(column).eqNullSafe(F.col("__c")) & col(fold).eqNullSafe(F.col("__f")), "left")
        .withColumn(out, F.col("__v"))
        .drop("__c", "__f", "__v")
    )


class LabelCoder(OptionEstimator):
    """Classes, in sorted order, to codes 0..k-1 and back."""

    def __init__(self, column: str = presets.TARGET, out: str = "label"):
        super().__init__()
        self.set_options(column=column, out=out)

    def _fit(self, df: DataFrame) -> "LabelCoderModel":
        column = self.option("column")
        require_columns(df, [column], "target column")
        return LabelCoderModel().with_state(column=column, out=self.option("out"), classes=class_list(df, column))


class LabelCoderModel(FittedStage):
    @property
    def classes(self) -> list:
        return self.values["classes"]

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.values
        position = F.array_position(F.array(*[F.lit(c) for c in v["classes"]]), col(v["column"])).cast("int") - 1
        return df.withColumn(v["out"], F.when(position >= 0, position.cast("double")))

    def decode(self, code: Column) -> Column:
        names = F.array(*[F.lit(c) for c in self.classes])
        return F.try_element_at(names, code.cast("int") + 1)


def label_sums(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sum of each indicator column, smallest first."""
    rows = [(F.lit(c).alias("column"), F.sum(col(c)).cast("bigint").alias("rows")) for c in columns]
    return melt_aggregates(df, rows).orderBy("rows", "column")

