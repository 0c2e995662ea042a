"""Comparison of training runs. Each nation's orders play one model: a rule judged against the planted label."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import GRADED_SQL, folds_sql, query, r6_sql, rounded, split_sql
from siftwork.catalog.models import METRICS, RULE, judged, metrics_ctes
from siftwork.operators.compare import (
    accuracy_long,
    best_run,
    efficiency,
    flatten_runs,
    fold_scores,
    gap_table,
    leaderboard,
    run_summary,
    stability,
)
from siftwork.operators.metrics import classification_metrics, confusion_counts
from siftwork.operators.split import assign_folds, assign_split
from siftwork.operators.train import HISTORY_SCHEMA
from siftwork.sources.documents import read_documents
from siftwork.sources.shared import shared_path, stage

UNTESTED = "NATION_3"
RUNS_SQL = f"""{GRADED_SQL}, {split_sql('graded', 'code', 'grade')},
j AS (SELECT code, n_name AS model, split_group, grade, grade AS actual, {RULE} AS prediction FROM divided),
jt AS (SELECT * FROM j WHERE split_group = 'train'), jv AS (SELECT * FROM j WHERE split_group = 'val'),
{metrics_ctes('jt', 't', 'model')}, {metrics_ctes('jv', 'v', 'model')}, {folds_sql('jt', 'code', 'grade')},
cv AS (SELECT model, fold, AVG(CASE WHEN prediction = actual THEN 1e0 ELSE 0e0 END) AS score FROM folded
  WHERE model <> '{UNTESTED}' GROUP BY 1, 2),
cm AS (SELECT model, AVG(score) AS cv_mean, STDDEV_POP(score) AS cv_std FROM cv GROUP BY 1),
ct AS (SELECT model, COUNT(*) / 1e3 AS training_time FROM jt GROUP BY 1),
runs AS (SELECT v.model, t.accuracy AS train_accuracy, v.accuracy AS val_accuracy, v.precision_macro, v.recall_macro,
  v.f1_macro, v.f1_weighted, cv_mean, cv_std, training_time
  FROM vmetrics v JOIN tmetrics t USING (model) JOIN ct USING (model) LEFT JOIN cm USING (model))"""
FLOATS = ["train_accuracy", "val_accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted", "cv_mean", "cv_std"]


def _cells(*names: str) -> str:
    return ", ".join(f"{r6_sql(n)} AS {n}" for n in names)


def run_documents(spark, sf_dir):
    """One nested run record per nation, written as JSON documents and read back by path pattern."""
    df = stage(judged(spark, sf_dir).select("code", F.col("n_name").alias("model"), "grade", "prediction"))
    divided = stage(assign_split(df, "grade", "code"))
    train, val = (divided.where(F.col("split_group") == s) for s in ("train", "val"))

    def metrics(part):
        scores = classification_metrics(confusion_counts(part, "grade", "prediction", ["model"]), ["model"])
        packed = F.map_from_arrays(F.array(*[F.lit(m) for m in METRICS]), F.array(*METRICS))
        return scores.select("model", packed.alias("metrics"))

    hit = F.when(F.col("grade") == F.col("prediction"), 1.0).otherwise(0.0)
    folds = assign_folds(train, "grade", "code").where(F.col("model") != UNTESTED)
    scores = folds.groupBy("model", "fold").agg(F.avg(hit).alias("score"))
    cv = scores.groupBy("model").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "score"))), lambda e: e["score"]).alias("scores"),
        F.avg("score").alias("mean"),
        F.stddev_pop("score").alias("std"),
        F.count(F.lit(1)).alias("folds"),
    )
    seconds = train.groupBy("model").agg((F.count(F.lit(1)) / 1000).alias("training_time"))
    nothing = F.expr("cast(null as map<string,double>)")
    joined = (
        metrics(val)
        .withColumnRenamed("metrics", "val_metrics")
        .join(metrics(train).withColumnRenamed("metrics", "train_metrics"), "model")
        .join(seconds, "model")
        .join(cv, "model", "left")
    )
    documents = joined.select(
        F.col("model").alias("model_name"),
        F.create_map(F.lit("rule"), F.lit("three conditions"), F.lit("nation"), F.col("model")).alias("hyperparameters"),
        F.struct(
            "train_metrics",
            "val_metrics",
            nothing.alias("test_metrics"),
            F.when(F.col("scores").isNotNull(), F.struct("scores", "mean", "std", "folds")).alias("cv_scores"),
            "training_time",
        ).alias("training_history"),
    )
    base = shared_path(spark, "runs")
    documents.write.json(f"{base}/v1/rules_metadata")
    documents.limit(1).write.json(f"{base}/v1/other_documents")
    return read_documents(spark, base, HISTORY_SCHEMA)


def runs(spark, sf_dir):
    return flatten_runs(run_documents(spark, sf_dir))


@query("a12_run_documents", f"WITH {RUNS_SQL} SELECT model, {_cells(*FLOATS)}, training_time, model AS nation FROM runs")
def scanned_documents(spark, sf_dir):
    """Recursive scan of nested documents; a run without fold scores gives nulls."""
    flat = rounded(runs(spark, sf_dir), *FLOATS)
    return flat.select("model", *FLOATS, "training_time", F.col("hyperparameters")["nation"].alias("nation"))


@query("m1_leaderboard", f"WITH {RUNS_SQL} SELECT model, {_cells('f1_macro')} FROM runs")
def board(spark, sf_dir):
    return rounded(leaderboard(runs(spark, sf_dir)).select("model", "f1_macro"), "f1_macro")


@query(
    "m2_gap_table",
    f"WITH {RUNS_SQL} SELECT model, {_cells('train_accuracy', 'val_accuracy')}, {r6_sql('train_accuracy - val_accuracy')} AS gap FROM runs",
)
def gaps(spark, sf_dir):
    return rounded(gap_table(runs(spark, sf_dir)), "train_accuracy", "val_accuracy", "gap")


@query(
    "m3_melt",
    f"""WITH {RUNS_SQL} SELECT model, 'Train' AS dataset, {r6_sql('train_accuracy')} AS accuracy FROM runs
       UNION ALL SELECT model, 'Validation', {r6_sql('val_accuracy')} FROM runs""",
)
def melted(spark, sf_dir):
    return rounded(accuracy_long(runs(spark, sf_dir)), "accuracy")


@query("m4_explode_scores", f"WITH {RUNS_SQL} SELECT model, fold + 1 AS fold, {r6_sql('score')} AS score FROM cv")
def exploded(spark, sf_dir):
    return rounded(fold_scores(runs(spark, sf_dir)), "score")


@query("m5_stability", f"WITH {RUNS_SQL} SELECT model, {_cells('cv_mean', 'cv_std')} FROM runs")
def stable(spark, sf_dir):
    return rounded(stability(runs(spark, sf_dir)), "cv_mean", "cv_std")


@query(
    "m6_efficiency",
    f"WITH {RUNS_SQL} SELECT model, {_cells('f1_macro')}, training_time, {r6_sql('f1_macro / training_time')} AS f1_per_second FROM runs",
)
def efficient(spark, sf_dir):
    return rounded(efficiency(runs(spark, sf_dir)), "f1_macro", "f1_per_second")


@query(
    "m7_best_run",
    f"WITH {RUNS_SQL} SELECT model, {_cells('f1_macro')}, model AS nation FROM runs ORDER BY runs.f1_macro DESC, model LIMIT 1",
)
def best(spark, sf_dir):
    top = best_run(runs(spark, sf_dir))
    return rounded(top.select("model", "f1_macro", F.col("hyperparameters")["nation"].alias("nation")), "f1_macro")


SUMMARY = ["f1_macro", "f1_weighted", "val_accuracy", "precision_macro", "recall_macro", "cv_mean", "cv_std"]


@query("m8_summary", f"WITH {RUNS_SQL} SELECT model, {_cells(*SUMMARY)}, training_time FROM runs")
def summary(spark, sf_dir):
    return rounded(run_summary(runs(spark, sf_dir)), *SUMMARY)
