"""Classification metrics from confusion counts: the rows are read once, the rest is tiny."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siftwork.functions.columns import col
from siftwork.operators.ranking import stratum_sizes

GAP_LIMIT = 0.05


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (group, label, prediction). Partial counts leave each task, so hot classes cost nothing."""
    return df.groupBy(*[col(b) for b in by], col(label).alias("actual"), col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True positives, support and predicted rows for every class seen on either side."""
    hit = F.col("actual") == F.col("predicted")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("actual").alias("class"),
            F.when(hit, F.col("n")).otherwise(zero).alias("hits"),
            F.col("n").alias("support"),
            zero.alias("predicted_n"),
        ),
        F.struct(
            F.col("predicted").alias("class"), zero.alias("hits"), zero.alias("support"), F.col("n").alias("predicted_n")
        ),
    )
    return (
        counts.select(*[col(b) for b in by], F.inline(sides))
        .groupBy(*[col(b) for b in by], "class")
        .agg(F.sum("hits").alias("hits"), F.sum("support").alias("support"), F.sum("predicted_n").alias("predicted_n"))
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_scores(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 per class; a zero divisor gives 0."""
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted_n")
    return per_class.select(
        *[col(b) for b in by],
        "class",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(hits * 2, support + predicted).alias("f1"),
        "support",
        "hits",
    )


def _averages(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Class scores to one row per group, with the rows they stand for."""

    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    return scores.groupBy(*[col(b) for b in by]).agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        weighted("precision").alias("precision_weighted"),
        F.avg("recall").alias("recall_macro"),
        weighted("recall").alias("recall_weighted"),
        F.avg("f1").alias("f1_macro"),
        weighted("f1").alias("f1_weighted"),
        F.sum("support").alias("support"),
    )


def classification_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and F1 each as plain and support-weighted class means."""
    return _averages(class_scores(class_counts(counts, by), by), by).drop("support")


def evaluate(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return classification_metrics(confusion_counts(df, label, prediction))


def classification_report(counts: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    scores = class_scores(class_counts(counts))
    per_class = scores.select(F.col("class").cast("string").alias("name"), "precision", "recall", "f1", "support")
    summary = _averages(scores)
    none = F.lit(None).cast("double")

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("support").alias("support"),
        )

    lines = F.array(
        line("accuracy", none, none, F.col("accuracy")),
        line("macro avg", F.col("precision_macro"), F.col("recall_macro"), F.col("f1_macro")),
        line("weighted avg", F.col("precision_weighted"), F.col("recall_weighted"), F.col("f1_weighted")),
    )
    return per_class.unionByName(summary.select(F.inline(lines)))


def confusion_matrix(counts: DataFrame, classes: Sequence) -> DataFrame:
    """One row per class, one column per predicted class, zeros filled; absent classes keep their row."""
    matrix = counts.groupBy(F.col("actual")).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).cast("bigint").alias(f"pred_{c}")
            for c in classes
        ]
    )
    frame = counts.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(classes)], f"position int, label {dict(counts.dtypes)['actual']}"
    )
    filled = frame.join(matrix, F.col("label") == F.col("actual"), "left").orderBy("position")
    return filled.select(
        F.col("label").alias("actual"),
        *[F.coalesce(F.col(f"`pred_{c}`"), F.lit(0)).alias(f"pred_{c}") for c in classes],
    )


def balanced_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Add n / (k · n_class) to every row. The class table is checked to be small, then broadcast."""
    sizes = stratum_sizes(df.where(col(label).isNotNull()), label)
    total, k = sum(sizes.values()), len(sizes)
    rows = [(c, total / (k * n)) for c, n in sizes.items()]
    schema = f"__c {dict(df.select(col(label).alias('c')).dtypes)['c']}, __w double"
    weights = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    joined = df.join(weights, col(label) == F.col("__c"), "left")
    return joined.withColumn(out, F.col("__w")).drop("__c", "__w")


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    sizes = stratum_sizes(df.where(col(label).isNotNull()), label)
    total, k = sum(sizes.values()), len(sizes)
    rows = [(c, n, total / (k * n)) for c, n in sizes.items()]
    schema = f"class {dict(df.select(col(label).alias('c')).dtypes)['c']}, rows bigint, weight double"
    return df.sparkSession.createDataFrame(rows, schema)


def generalisation_gap(df: DataFrame, train: str, val: str, limit: float = GAP_LIMIT) -> DataFrame:
    """Train minus validation score, and whether it is large enough to suspect overfitting."""
    gap = col(train) - col(val)
    return df.withColumn("gap", gap).withColumn("overfit", gap > limit)
