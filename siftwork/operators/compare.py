"""Comparison of training runs: leaderboard, gap, stability, efficiency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SUMMARY_COLUMNS = [
    "model",
    "f1_macro",
    "f1_weighted",
    "val_accuracy",
    "precision_macro",
    "recall_macro",
    "cv_mean",
    "cv_std",
    "training_time",
]


def flatten_runs(documents: DataFrame) -> DataFrame:
    """Nested run documents -> one flat row per run; absent fields are null."""
    h = "training_history"
    return documents.select(
        F.col("model_name").alias("model"),
        F.col(f"{h}.train_metrics.accuracy").alias("train_accuracy"),
        F.col(f"{h}.val_metrics.accuracy").alias("val_accuracy"),
        F.col(f"{h}.val_metrics.precision_macro").alias("precision_macro"),
        F.col(f"{h}.val_metrics.recall_macro").alias("recall_macro"),
        F.col(f"{h}.val_metrics.f1_macro").alias("f1_macro"),
        F.col(f"{h}.val_metrics.f1_weighted").alias("f1_weighted"),
        F.col(f"{h}.cv_scores.mean").alias("cv_mean"),
        F.col(f"{h}.cv_scores.std").alias("cv_std"),
        F.col(f"{h}.cv_scores.scores").alias("cv_scores"),
        F.col(f"{h}.training_time").alias("training_time"),
        F.col("hyperparameters"),
    )


def leaderboard(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("f1_macro"), "model")


def gap_table(runs: DataFrame) -> DataFrame:
    gap = F.col("train_accuracy") - F.col("val_accuracy")
    return runs.select("model", "train_accuracy", "val_accuracy", gap.alias("gap")).orderBy(
        F.desc_nulls_last("gap"), "model"
    )


def accuracy_long(runs: DataFrame) -> DataFrame:
    """One row per run and dataset."""
    long = runs.unpivot("model", ["train_accuracy", "val_accuracy"], "dataset", "accuracy")
    return long.replace({"train_accuracy": "Train", "val_accuracy": "Validation"}, subset=["dataset"])


def fold_scores(runs: DataFrame) -> DataFrame:
    """One row per run and fold, numbered from 1; runs without scores give none."""
    return runs.select("model", F.posexplode("cv_scores").alias("position", "score")).select(
        "model", (F.col("position") + 1).alias("fold"), "score"
    )


def stability(runs: DataFrame) -> DataFrame:
    return runs.select("model", "cv_mean", "cv_std").orderBy(F.desc_nulls_last("cv_mean"), "model")


def efficiency(runs: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("f1_macro"), F.col("training_time"))
    return runs.select("model", "f1_macro", "training_time", rate.alias("f1_per_second")).orderBy(
        F.desc_nulls_last("f1_per_second"), "model"
    )


def best_run(runs: DataFrame, columns: Sequence[str] = ("model", "f1_macro", "hyperparameters")) -> DataFrame:
    return leaderboard(runs).limit(1).select(*columns)


def run_summary(runs: DataFrame) -> DataFrame:
    return leaderboard(runs).select(*SUMMARY_COLUMNS)
