"""Classifiers, metrics, training records, tuning.

Nearest neighbours are deterministic and can be written in SQL, so training,
prediction, persistence and tuning are checked through them; the other models
are checked for their quality on a planted label.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from siftwork.catalog.base import (
    GRADED_SQL,
    NUMBERS,
    folds_sql,
    graded,
    query,
    r6,
    r6_sql,
    rounded,
    split_sql,
    table,
)
from siftwork.operators.boosting import SoftmaxBooster
from siftwork.operators.classify import GRIDS, Classifier
from siftwork.operators.metrics import (
    balanced_weights,
    class_counts,
    class_scores,
    class_weight_table,
    classification_report,
    confusion_counts,
    confusion_matrix,
    evaluate,
    generalisation_gap,
)
from siftwork.operators.neighbours import KNNClassifier
from siftwork.operators.nystroem import NystroemFeatures
from siftwork.operators.scale import FeatureScaler
from siftwork.operators.split import assign_split
from siftwork.operators.train import HISTORY_SCHEMA, TrainedModel, grid_points, grid_search
from siftwork.sources.documents import write_document
from siftwork.sources.shared import shared_path, stage

WIDTH = 64
AXES = [f"e{i}" for i in range(WIDTH)]
METRICS = [
    "accuracy",
    "precision_macro",
    "precision_weighted",
    "recall_macro",
    "recall_weighted",
    "f1_macro",
    "f1_weighted",
]
RULE = """SUBSTR('abcde', 1 + (CASE WHEN avg_disc > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN avg_qty > 25 THEN 1 ELSE 0 END)
     + (CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END), 1)"""
JUDGED_SQL = f"{GRADED_SQL}, judged AS (SELECT *, grade AS actual, {RULE} AS prediction FROM graded)"


def judged(spark, sf_dir):
    """The planted label and a rule that ignores one of its four conditions (and so never says ``e``)."""
    return graded(spark, sf_dir).withColumn("prediction", F.expr(RULE))


def metrics_ctes(source: str, prefix: str = "", by: str | None = None) -> str:
    """CTEs ending in ``{prefix}metrics`` over ``source(actual, prediction)``."""
    p = prefix
    group, on = (f"{by}, ", f" AND s.{by} = c.{by}") if by else ("", "")
    scores = f"GROUP BY {by}" if by else ""
    return f"""{p}classes AS (SELECT {group}actual AS c FROM {source} UNION SELECT {group}prediction FROM {source}),
{p}pc AS (SELECT {"c." + by + ", " if by else ""}c.c, COUNT(*) FILTER (WHERE actual = c.c AND prediction = c.c) AS tp,
  COUNT(*) FILTER (WHERE actual = c.c) AS sup, COUNT(*) FILTER (WHERE prediction = c.c) AS prd
  FROM {p}classes c JOIN {source} s ON TRUE{on} GROUP BY ALL),
{p}scores AS (SELECT *, CASE WHEN prd = 0 THEN 0e0 ELSE tp / prd END AS p, CASE WHEN sup = 0 THEN 0e0 ELSE tp / sup END AS r,
  CASE WHEN prd + sup = 0 THEN 0e0 ELSE 2 * tp / (prd + sup) END AS f FROM {p}pc),
{p}metrics AS (SELECT {group}SUM(tp) / SUM(sup) AS accuracy, AVG(p) AS precision_macro, SUM(p * sup) / SUM(sup) AS precision_weighted,
  AVG(r) AS recall_macro, SUM(r * sup) / SUM(sup) AS recall_weighted, AVG(f) AS f1_macro, SUM(f * sup) / SUM(sup) AS f1_weighted
  FROM {p}scores {scores})"""


METRICS_OUT = ", ".join(f"{r6_sql(m)} AS {m}" for m in METRICS)

EMB_SQL = f"""emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
{split_sql('emb', 'vec_id', 'label')},
tr AS (SELECT * FROM divided WHERE split_group = 'train'), va AS (SELECT * FROM divided WHERE split_group = 'val'),
te AS (SELECT * FROM divided WHERE split_group = 'test')"""


def knn_ctes(asking: str, points: str, prefix: str = "", k: int = 15, extra: str = "", on: str = "TRUE") -> str:
    """CTEs ending in ``{prefix}votes`` and ``{prefix}pred(vec_id, actual, prediction)``."""
    p = prefix
    return f"""{p}d AS (SELECT q.vec_id, {extra}q.label AS actual, t.label, t.vec_id AS tid, list_distance(q.x, t.x) AS d
  FROM {asking} q JOIN {points} t ON {on}),
{p}near AS (SELECT * FROM {p}d QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d, tid) <= {k}),
{p}least AS (SELECT *, MIN(d) OVER (PARTITION BY vec_id) AS mn FROM {p}near),
{p}votes AS (SELECT vec_id, actual, label, SUM(CASE WHEN mn = 0 THEN CASE WHEN d = 0 THEN 1e0 ELSE 0e0 END ELSE 1 / d END) AS w
  FROM {p}least GROUP BY ALL),
{p}pred AS (SELECT vec_id, actual, label AS prediction FROM {p}votes
  QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY w DESC, label) = 1)"""


def vectors(spark, sf_dir):
    """Embeddings with a stratified split; spread over the cores, as each row costs a search."""
    df = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    divided = assign_split(df, "label", "vec_id")
    return divided.repartition(spark.sparkContext.defaultParallelism, "vec_id")


def parts(df, *names):
    return [df.where(F.col("split_group") == n).drop("split_group") for n in names]


def axes(spark, sf_dir):
    df = vectors(spark, sf_dir)
    cells = [F.col("embedding")[i].alias(a) for i, a in enumerate(AXES)]
    return stage(df.select("vec_id", "label", "split_group", *cells))


def knn(**params) -> Classifier:
    return Classifier("knn", AXES, "label", "vec_id", **params)


def scaled_orders(spark, sf_dir):
    df = stage(graded(spark, sf_dir).select("code", "grade", *NUMBERS))
    scaled = FeatureScaler("standard", exclude=["code"]).fit(df).transform(df)
    return stage(assign_split(scaled, "grade", "code"))


def quality(spark, sf_dir, model: str, label: str = "grade", **params):
    """Per-class report on the validation rows."""
    df = scaled_orders(spark, sf_dir)
    if label == "xor":
        df = df.withColumn("xor", F.when((F.col("avg_qty") > 0) != (F.col("c_acctbal") > 0), "y").otherwise("n"))
    train, val = parts(df, "train", "val")
    trained = TrainedModel(Classifier(model, NUMBERS, label, "code", **params))
    trained.train(train, folds=0)
    return rounded(trained.report(val), "precision", "recall", "f1")


@query("k1_logistic")
def logistic(spark, sf_dir):
    return quality(spark, sf_dir, "logistic_regression")


@query(
    "k2_knn",
    f"WITH {EMB_SQL}, {knn_ctes('te', 'tr')} SELECT vec_id, actual AS label, CAST(prediction AS DOUBLE) AS prediction FROM pred",
)
def nearest(spark, sf_dir):
    """Distance-weighted vote of the 15 nearest train vectors for every test vector."""
    train, test = parts(vectors(spark, sf_dir), "train", "test")
    model = KNNClassifier("embedding", "label", "vec_id").fit(train)
    return model.transform(test).select("vec_id", "label", "prediction")


@query(
    "k2_knn_cells",
    f"""WITH {EMB_SQL}, m AS (SELECT q.vec_id, t.vec_id AS tid, list_sum(list_transform(list_zip(q.x, t.x), lambda z: ABS(z[1] - z[2]))) AS d
         FROM te q, tr t), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d, tid) AS rk FROM m)
       SELECT vec_id, rk AS rank, tid AS neighbour, {r6_sql('d')} AS distance FROM r WHERE rk <= 5""",
)
def nearest_by_cells(spark, sf_dir):
    """The same search as a join over cells, as used when the train side is too large to broadcast."""
    train, test = parts(vectors(spark, sf_dir), "train", "test")
    options = dict(n_neighbors=5, metric="manhattan", broadcast_bytes=0, block_rows=2000)
    model = KNNClassifier("embedding", "label", "vec_id", **options).fit(train)
    near = model.neighbours(test).select("vec_id", F.posexplode("__near").alias("position", "n"))
    return near.select(
        "vec_id",
        (F.col("position") + 1).cast("bigint").alias("rank"),
        F.col("n.ids").alias("neighbour"),
        r6(F.col("n.distances")).alias("distance"),
    )


ODD_KEY = "CASE WHEN vec_id % 5 = 0 THEN NULL ELSE CAST(FLOOR(vec_id / 4) AS BIGINT) END"


@query(
    "k2_knn_repeated_keys",
    f"""WITH {EMB_SQL}, {knn_ctes('te', 'tr')} SELECT branch, vec_id AS row, CAST(prediction AS DOUBLE) AS prediction
       FROM pred, (SELECT UNNEST(['broadcast', 'cells']) AS branch)""",
)
def nearest_of_odd_keys(spark, sf_dir):
    """Asking rows whose keys are repeated or missing, against a broadcast and against cells."""
    train, test = parts(vectors(spark, sf_dir), "train", "test")
    asking = test.withColumnRenamed("vec_id", "row").withColumn("vec_id", F.expr(ODD_KEY.replace("vec_id", "row")))
    found = []
    for branch, options in (("broadcast", {}), ("cells", dict(broadcast_bytes=0, block_rows=2000))):
        model = KNNClassifier("embedding", "label", "vec_id", **options).fit(train)
        found.append(model.transform(asking).select(F.lit(branch).alias("branch"), "row", "prediction"))
    return found[0].unionByName(found[1])


@query("k3_svm")
def svm(spark, sf_dir):
    """Kernel machine by Nyström features at its declared settings, on a label no linear model can learn."""
    return quality(spark, sf_dir, "svm", label="xor")


KERNEL_AXES = {"avg_qty": 50.0, "avg_disc": 0.1, "c_acctbal": 10000.0, "o_totalprice": 500000.0}
KERNEL_ROW = ", ".join(f"{c} / {scale}e0 AS {c}" for c, scale in KERNEL_AXES.items())
PROBES = 20


@query(
    "k3_kernel_features",
    f"""WITH {GRADED_SQL}, r AS (SELECT code, {KERNEL_ROW} FROM graded), probes AS (SELECT * FROM r ORDER BY code LIMIT {PROBES}),
       k AS (SELECT p.code, EXP(-({" + ".join(f"POWER(p.{c} - r.{c}, 2)" for c in KERNEL_AXES)})) AS k FROM probes p, r)
       SELECT code, COUNT(*) AS rows, {r6_sql("AVG(k)")} AS kernel_mean, TRUE AS within FROM k GROUP BY 1""",
)
def kernel_features(spark, sf_dir):
    """Dot products of features with those of twenty probes against the kernel itself: off by a thousandth at most."""
    cells = [(F.col(c) / scale).alias(c) for c, scale in KERNEL_AXES.items()]
    rows = stage(graded(spark, sf_dir).select("code", array_to_vector(F.array(*cells)).alias("v")))
    model = NystroemFeatures("v", "z", 300, 1.0).fit(rows)
    probes = rows.orderBy("code").limit(PROBES).collect()
    points = [p["v"].toArray().tolist() for p in probes]
    close = model.products(rows, points, "close").select(vector_to_array("v").alias("v"), "close")
    cells = [F.col("v")[j].alias(f"x{j}") for j in range(len(KERNEL_AXES))]
    close = close.select(*cells, *[F.col("close")[i].alias(f"close{i}") for i in range(len(points))])
    out = []
    for i, (p, at) in enumerate(zip(probes, points)):
        gaps = [(F.col(f"x{j}") - F.lit(x)) * (F.col(f"x{j}") - F.lit(x)) for j, x in enumerate(at)]
        exact = F.exp(-sum(gaps[1:], gaps[0]))
        worst = F.max(F.abs(exact - F.col(f"close{i}"))) <= 1e-3
        out.append(F.struct(F.lit(p["code"]).cast("bigint").alias("code"), F.count(F.lit(1)).alias("rows"), r6(F.avg(exact)).alias("kernel_mean"), worst.alias("within")))
    return close.agg(F.array(*out).alias("found")).select(F.inline("found"))


@query("k4_random_forest")
def forest(spark, sf_dir):
    return quality(spark, sf_dir, "random_forest", n_estimators=40, max_depth=10)


_BOOSTED: dict[tuple[str, str], str] = {}


def boosted(spark, sf_dir) -> tuple[TrainedModel, DataFrame]:
    """The booster at its declared settings, fitted once per application and table folder and loaded from then on; the validation rows."""
    train, val = parts(scaled_orders(spark, sf_dir), "train", "val")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BOOSTED:
        trained = TrainedModel(Classifier("xgboost", NUMBERS, "grade", "code"))
        trained.train(train, folds=0)
        path = shared_path(spark, "boosted")
        trained.save(path, spark)
        _BOOSTED[key] = path
    return TrainedModel.load(_BOOSTED[key], spark), val


@query("k5_boosting")
def boosting(spark, sf_dir):
    """A hundred rounds of depth 6, rows and columns sampled, leaves penalised: report on the validation rows."""
    trained, val = boosted(spark, sf_dir)
    return rounded(trained.report(val), "precision", "recall", "f1")


@query(
    "k5_softmax_boosting",
    f"""WITH {GRADED_SQL}, {split_sql('graded', 'code', 'grade')}
       SELECT grade AS name, COUNT(*) AS support, TRUE AS learnt FROM divided WHERE split_group = 'val' GROUP BY 1""",
)
def boosting_bounds(spark, sf_dir):
    """Classes of the planted label that the booster finds again: nine of ten validation rows of each, at least."""
    trained, val = boosted(spark, sf_dir)
    classes = class_scores(class_counts(trained.counts(val)))
    return classes.select(F.col("class").alias("name"), "support", (F.col("recall") >= 0.9).alias("learnt"))


SPLIT_EDGES = {"avg_qty": [10.0, 20.0, 25.0, 30.0, 40.0], "avg_disc": [0.02, 0.04, 0.05, 0.06, 0.08], "c_acctbal": [0.0, 2500.0, 4500.0, 7000.0]}
SPLIT_BINS = " UNION ALL ".join(
    f"SELECT grade, {j} AS feature, {' + '.join(f'CASE WHEN {c} > {e} THEN 1 ELSE 0 END' for e in edges)} AS bin FROM graded"
    for j, (c, edges) in enumerate(SPLIT_EDGES.items())
)


@query(
    "k5_softmax_split",
    f"""WITH {GRADED_SQL}, b AS ({SPLIT_BINS}), c AS (SELECT UNNEST(['a', 'b', 'c', 'd', 'e']) AS name),
       cells AS (SELECT name, feature, bin, SUM(3355443 - CASE WHEN grade = name THEN 16777216 ELSE 0 END) / 16777216e0 AS g,
         SUM(5368709) / 16777216e0 AS h FROM b, c GROUP BY ALL),
       sides AS (SELECT *, SUM(g) OVER w AS lg, SUM(h) OVER w AS lh, SUM(g) OVER (PARTITION BY name, feature) AS tg,
         SUM(h) OVER (PARTITION BY name, feature) AS th FROM cells WINDOW w AS (PARTITION BY name, feature ORDER BY bin)),
       gains AS (SELECT *, POWER(GREATEST(ABS(lg) - 0.1e0, 0), 2) / (lh + 1) + POWER(GREATEST(ABS(tg - lg) - 0.1e0, 0), 2) / (th - lh + 1)
         - POWER(GREATEST(ABS(tg) - 0.1e0, 0), 2) / (th + 1) AS gain FROM sides WHERE lh >= 1 AND th - lh >= 1),
       best AS (SELECT * FROM gains QUALIFY ROW_NUMBER() OVER (PARTITION BY name ORDER BY gain DESC, feature, bin) = 1)
       SELECT name, CAST(feature AS INTEGER) AS feature, CAST(bin AS INTEGER) AS bin,
         {r6_sql("-SIGN(lg) * GREATEST(ABS(lg) - 0.1e0, 0) / (lh + 1)")} AS low_value,
         {r6_sql("-SIGN(tg - lg) * GREATEST(ABS(tg - lg) - 0.1e0, 0) / (th - lh + 1)")} AS high_value FROM best""",
)
def first_split(spark, sf_dir):
    """The first split of every class: gradients, Hessians, penalised gains and leaf values over all rows."""
    df = graded(spark, sf_dir)
    rows = df.select("code", F.array(*SPLIT_EDGES).alias("features"), (F.ascii("grade") - F.ascii(F.lit("a"))).alias("label"))
    options = dict(n_classes=5, n_estimators=1, max_depth=1, learning_rate=1.0, subsample=1.0, colsample_bytree=1.0)
    model = SoftmaxBooster(edges=list(SPLIT_EDGES.values()), key="code", **options).fit(rows)
    trees = model.values["trees"][0]
    found = [("abcde"[c], t["feature"][0], t["bin"][0], t["value"][1], t["value"][2]) for c, t in enumerate(trees)]
    out = spark.createDataFrame(found, "name string, feature int, bin int, low_value double, high_value double")
    return rounded(out, "low_value", "high_value")


@query(
    "k6_class_weights",
    f"""WITH {GRADED_SQL}, c AS (SELECT grade, COUNT(*) AS rows FROM graded GROUP BY 1)
       SELECT grade AS class, rows, {r6_sql("(SELECT COUNT(*) FROM graded) / ((SELECT COUNT(*) FROM c) * rows)")} AS weight FROM c""",
)
def class_weights(spark, sf_dir):
    return rounded(class_weight_table(graded(spark, sf_dir), "grade"), "weight")


@query(
    "k6_row_weights",
    f"""WITH {GRADED_SQL}, c AS (SELECT grade, COUNT(*) AS rows FROM graded GROUP BY 1)
       SELECT code, grade, {r6_sql("(SELECT COUNT(*) FROM graded) / ((SELECT COUNT(*) FROM c) * rows)")} AS class_weight
       FROM graded JOIN c USING (grade)""",
)
def row_weights(spark, sf_dir):
    return rounded(balanced_weights(stage(graded(spark, sf_dir).select("code", "grade")), "grade"), "class_weight")


@query(
    "k7_train",
    f"""WITH {EMB_SQL}, {folds_sql('tr', 'vec_id', 'label')},
       {knn_ctes('folded', 'folded', 'c', extra='q.fold, ', on='t.fold <> q.fold')},
       {knn_ctes('tr', 'tr', 't')}, {knn_ctes('va', 'tr', 'v')}, {metrics_ctes('vpred', 'v')},
       acc AS (SELECT fold, AVG(CASE WHEN cpred.prediction = actual THEN 1e0 ELSE 0e0 END) AS a FROM cpred JOIN folded USING (vec_id) GROUP BY 1)
       SELECT 'fold ' || (fold + 1) AS measure, {r6_sql('a')} AS value FROM acc
       UNION ALL SELECT 'cv mean', {r6_sql('AVG(a)')} FROM acc UNION ALL SELECT 'cv std', {r6_sql('STDDEV_POP(a)')} FROM acc
       UNION ALL SELECT 'train accuracy', {r6_sql('AVG(CASE WHEN prediction = actual THEN 1e0 ELSE 0e0 END)')} FROM tpred
       UNION ALL SELECT 'validation f1_macro', {r6_sql('f1_macro')} FROM vmetrics
       UNION ALL SELECT 'validation accuracy', {r6_sql('accuracy')} FROM vmetrics""",
)
def train_run(spark, sf_dir):
    """Five stratified folds, the final fit, train accuracy and validation metrics."""
    train, val = parts(axes(spark, sf_dir), "train", "val")
    trained = TrainedModel(knn())
    trained.train(train, val, folds=5)
    h = trained.history
    rows = [(f"fold {i + 1}", a) for i, a in enumerate(h["cv_scores"]["scores"])]
    rows += [
        ("cv mean", h["cv_scores"]["mean"]),
        ("cv std", h["cv_scores"]["std"]),
        ("train accuracy", h["train_metrics"]["accuracy"]),
        ("validation f1_macro", h["val_metrics"]["f1_macro"]),
        ("validation accuracy", h["val_metrics"]["accuracy"]),
    ]
    return rounded(spark.createDataFrame(rows, "measure string, value double"), "value")


@query(
    "k8_predict",
    f"WITH {EMB_SQL}, {knn_ctes('te', 'tr')} SELECT vec_id, actual AS label, prediction FROM pred",
)
def predict(spark, sf_dir):
    train, test = parts(axes(spark, sf_dir), "train", "test")
    trained = TrainedModel(knn())
    trained.train(train, folds=0)
    return trained.predict(test).select("vec_id", "label", "prediction")


@query(
    "k9_probabilities",
    f"""WITH {EMB_SQL}, {knn_ctes('te', 'tr')}, classes AS (SELECT DISTINCT label AS c FROM tr),
       total AS (SELECT vec_id, SUM(w) AS t FROM votes GROUP BY 1)
       SELECT total.vec_id, c AS class, {r6_sql('COALESCE(w, 0) / t')} AS probability
       FROM total CROSS JOIN classes LEFT JOIN votes ON votes.vec_id = total.vec_id AND votes.label = c""",
)
def probabilities(spark, sf_dir):
    train, test = parts(axes(spark, sf_dir), "train", "test")
    scored = knn().fit(train).transform(test)
    long = scored.select("vec_id", F.posexplode("probability").alias("class", "probability"))
    return rounded(long, "probability")


@query("k10_metrics", f"WITH {JUDGED_SQL}, {metrics_ctes('judged')} SELECT {METRICS_OUT} FROM metrics")
def metrics(spark, sf_dir):
    return rounded(evaluate(judged(spark, sf_dir), "grade", "prediction"), *METRICS)


@query(
    "k11_report",
    f"""WITH {JUDGED_SQL}, {metrics_ctes('judged')}, n AS (SELECT COUNT(*) AS n FROM judged)
       SELECT c AS name, {r6_sql('p')} AS precision, {r6_sql('r')} AS recall, {r6_sql('f')} AS f1, sup AS support FROM scores
       UNION ALL SELECT 'accuracy', NULL, NULL, {r6_sql('accuracy')}, n FROM metrics, n
       UNION ALL SELECT 'macro avg', {r6_sql('precision_macro')}, {r6_sql('recall_macro')}, {r6_sql('f1_macro')}, n FROM metrics, n
       UNION ALL SELECT 'weighted avg', {r6_sql('precision_weighted')}, {r6_sql('recall_weighted')}, {r6_sql('f1_weighted')}, n
       FROM metrics, n""",
)
def report(spark, sf_dir):
    counts = confusion_counts(judged(spark, sf_dir), "grade", "prediction")
    return rounded(classification_report(counts), "precision", "recall", "f1")


@query(
    "k12_confusion",
    f"""WITH {JUDGED_SQL} SELECT actual,
       {", ".join(f"COUNT(*) FILTER (WHERE prediction = '{c}') AS pred_{c}" for c in 'abcde')} FROM judged GROUP BY 1""",
)
def confusion(spark, sf_dir):
    return confusion_matrix(confusion_counts(judged(spark, sf_dir), "grade", "prediction"), list("abcde"))


@query(
    "k13_gap",
    f"""WITH {GRADED_SQL}, {split_sql('graded', 'code', 'grade')},
       h AS (SELECT n_name, split_group, CASE WHEN {RULE} = grade THEN 1e0 ELSE 0e0 END AS hit FROM divided),
       a AS (SELECT n_name, AVG(hit) FILTER (WHERE split_group = 'train') AS t, AVG(hit) FILTER (WHERE split_group = 'val') AS v
             FROM h GROUP BY 1)
       SELECT n_name, {r6_sql('t')} AS train_accuracy, {r6_sql('v')} AS val_accuracy, {r6_sql('t - v')} AS gap,
         t - v > 0.05 AS overfit FROM a""",
)
def gap(spark, sf_dir):
    df = stage(judged(spark, sf_dir).select("code", "n_name", "grade", "prediction"))
    df = assign_split(df, "grade", "code")
    hit = F.when(F.col("grade") == F.col("prediction"), 1.0).otherwise(0.0)
    scored = df.groupBy("n_name").agg(
        *[F.avg(F.when(F.col("split_group") == s, hit)).alias(f"{s}_accuracy") for s in ("train", "val")]
    )
    return rounded(generalisation_gap(scored, "train_accuracy", "val_accuracy"), "train_accuracy", "val_accuracy", "gap")


GRID = GRIDS["knn"]
GRID_POINTS = ", ".join(f"({i}, {p['n_neighbors']}, '{p['weights']}', '{p['metric']}')" for i, p in enumerate(grid_points(GRID)))
GRID_PAIRS = " UNION ALL ".join(
    f"""SELECT {metrics} AS metrics, q.vec_id, q.fold, q.label AS actual, t.label, t.vec_id AS tid, {d} AS d
  FROM folded q JOIN folded t ON t.fold <> q.fold"""
    for metrics, d in (
        ("['minkowski', 'euclidean']", "list_distance(q.x, t.x)"),
        ("['manhattan']", "list_sum(list_transform(list_zip(q.x, t.x), lambda z: ABS(z[1] - z[2])))"),
    )
)
GRID_SQL = f"""{EMB_SQL}, {folds_sql('tr', 'vec_id', 'label')},
gd AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY metrics, vec_id ORDER BY d, tid) AS rk FROM ({GRID_PAIRS})
  QUALIFY rk <= {max(GRID['n_neighbors'])}),
grid(pos, k, w, metric) AS (VALUES {GRID_POINTS}),
gn AS (SELECT pos, k, w, gd.*, MIN(d) OVER (PARTITION BY pos, vec_id) AS mn FROM gd JOIN grid ON rk <= k AND list_contains(metrics, metric)),
gv AS (SELECT pos, k, w, fold, vec_id, actual, label, SUM(CASE WHEN w = 'uniform' THEN 1e0
  WHEN mn = 0 THEN CASE WHEN d = 0 THEN 1e0 ELSE 0e0 END ELSE 1 / d END) AS s FROM gn GROUP BY ALL),
gp AS (SELECT pos * 10 + fold AS cell, actual, label AS prediction FROM gv
  QUALIFY ROW_NUMBER() OVER (PARTITION BY pos, vec_id ORDER BY s DESC, label) = 1),
{metrics_ctes('gp', 'g', 'cell')},
result AS (SELECT pos, ANY_VALUE(k) AS k, ANY_VALUE(w) AS w, ANY_VALUE(metric) AS metric, AVG(f1_macro) AS f
  FROM gmetrics JOIN grid ON pos = cell // 10 GROUP BY 1)"""


def search(spark, sf_dir):
    """The whole grid of the nearest-neighbour model over five folds: two fits a fold answer its thirty points."""
    (train,) = parts(axes(spark, sf_dir), "train")
    return grid_search(train, knn(), GRID, "vec_id", folds=5, parallelism=4)


@query(
    "k14_grid_search",
    f"WITH {GRID_SQL} SELECT CAST(k AS INTEGER) AS n_neighbors, w AS weights, metric, {r6_sql('f')} AS f1_macro FROM result",
)
def tuned(spark, sf_dir):
    rows = [(p["n_neighbors"], p["weights"], p["metric"], s) for p, s in search(spark, sf_dir).table]
    return rounded(spark.createDataFrame(rows, "n_neighbors int, weights string, metric string, f1_macro double"), "f1_macro")


@query(
    "a11_tuning_document",
    f"""WITH {GRID_SQL}, best AS (SELECT * FROM result ORDER BY ROUND(f, 12) DESC, pos LIMIT 1)
       SELECT 'knn' AS model, {r6_sql('f')} AS best_score, CAST(k AS VARCHAR) AS n_neighbors, '"' || metric || '"' AS metric,
         '"' || w || '"' AS weights, 5 AS cv_folds FROM best""",
)
def tuning_document(spark, sf_dir):
    path = shared_path(spark, "tuning")
    write_document(search(spark, sf_dir).document(spark), path)
    back = spark.read.schema(
        "model string, best_score double, best_params map<string,string>, cv_folds int, timestamp string"
    ).json(path)
    best = [F.col("best_params")[n].alias(n) for n in ("n_neighbors", "metric", "weights")]
    return back.select("model", r6(F.col("best_score")).alias("best_score"), *best, "cv_folds")


@query("k15_evaluate_saved", f"WITH {EMB_SQL}, {knn_ctes('te', 'tr')}, {metrics_ctes('pred')} SELECT {METRICS_OUT} FROM metrics")
def evaluate_saved(spark, sf_dir):
    """A saved model, loaded again and measured on the held-out split."""
    train, test = parts(axes(spark, sf_dir), "train", "test")
    trained = TrainedModel(knn())
    trained.train(train, folds=0)
    path = shared_path(spark, "model")
    trained.save(path, spark)
    return rounded(evaluate(TrainedModel.load(path, spark).predict(test), "label", "prediction"), *METRICS)


@query(
    "a10_run_document",
    f"""WITH {EMB_SQL}, {knn_ctes('va', 'tr', 'v', k=20)}, {metrics_ctes('vpred', 'v')}
       SELECT 'KNN' AS model_name, '20' AS n_neighbors, (SELECT string_agg(CAST(l AS VARCHAR), ',' ORDER BY l)
         FROM (SELECT DISTINCT label AS l FROM tr)) AS classes, {r6_sql('accuracy')} AS val_accuracy, {r6_sql('f1_macro')} AS val_f1_macro
       FROM vmetrics""",
)
def run_document(spark, sf_dir):
    train, val = parts(axes(spark, sf_dir), "train", "val")
    trained = TrainedModel(knn(n_neighbors=20))
    trained.train(train, val, folds=0)
    path = shared_path(spark, "model")
    trained.save(path, spark)
    back = spark.read.schema(HISTORY_SCHEMA).json(f"{path}/run_metadata")
    return back.select(
        "model_name",
        F.col("hyperparameters")["n_neighbors"].alias("n_neighbors"),
        F.array_join("classes", ",").alias("classes"),
        r6(F.col("training_history.val_metrics")["accuracy"]).alias("val_accuracy"),
        r6(F.col("training_history.val_metrics")["f1_macro"]).alias("val_f1_macro"),
    )


@query("a14_saved_model", f"WITH {EMB_SQL}, {knn_ctes('va', 'tr')} SELECT vec_id, prediction FROM pred")
def saved_model(spark, sf_dir):
    train, val = parts(axes(spark, sf_dir), "train", "val")
    trained = TrainedModel(knn())
    trained.train(train, folds=0)
    path = shared_path(spark, "model")
    trained.save(path, spark)
    return TrainedModel.load(path, spark).predict(val).select("vec_id", "prediction")
