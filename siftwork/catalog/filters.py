"""Projections, filters, preconditions and stage switches."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import (
    FEATURES_SQL,
    GRADED_SQL,
    RANGES,
    RAW_SQL,
    features,
    graded,
    query,
    r6_sql,
    raw_products,
    rounded,
    split_sql,
    table,
)
from siftwork.operators.classify import Classifier
from siftwork.operators.dedupe import drop_duplicates
from siftwork.operators.missing import MissingValueHandler
from siftwork.operators.outliers import range_filter, rejection_counts
from siftwork.operators.profile import column_classes, wide_text_columns
from siftwork.operators.reduce import FeatureReducer
from siftwork.operators.scale import FeatureScaler, FeatureScalerModel
from siftwork.operators.split import assign_split, check_ratios
from siftwork.operators.train import TrainedModel
from siftwork.plans.prepare import fit_preparation, preparation
from siftwork.sources.delimited import select_wanted, valid_class
from siftwork.sources.shared import stage
from siftwork.sources.splits import features_and_target

IN_RANGE = "c_acctbal BETWEEN 0 AND 9000 AND o_totalprice BETWEEN 0 AND 450000"


@query("b1_projection", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders")
def projection(spark, sf_dir):
    return select_wanted(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderkey", "o_note", "o_totalprice"])


@query(
    "b2_drop_unlabelled",
    "SELECT documents.doc_id, lang, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def drop_unlabelled(spark, sf_dir):
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return both.where(F.col("quality").isNotNull()).select("doc_id", "lang", "quality")


@query(
    "b3_class_filter",
    f"WITH {RAW_SQL} SELECT code, grade FROM raw WHERE LOWER(grade) IN ('a','b','c','d','e')",
)
def class_filter(spark, sf_dir):
    return raw_products(spark, sf_dir).where(valid_class("grade")).select("code", "grade")


@query(
    "b4_range_filter",
    f"""WITH {FEATURES_SQL} SELECT code, c_acctbal, o_totalprice, qty FROM features
       WHERE {IN_RANGE} AND (qty IS NULL OR qty BETWEEN 20 AND 300)""",
)
def valid_range_filter(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "c_acctbal", "o_totalprice", "qty")
    return range_filter(df, {**RANGES, "qty": (20, 300), "absent_column": (0, 1)})


@query(
    "b5_reject_reasons",
    f"""WITH {FEATURES_SQL}, r AS (SELECT CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN 'c_acctbal'
         WHEN o_totalprice < 0 OR o_totalprice > 450000 THEN 'o_totalprice' WHEN qty < 20 OR qty > 300 THEN 'qty' END
         AS reason FROM features)
       SELECT reason, COUNT(*) AS rejected FROM r WHERE reason IS NOT NULL GROUP BY 1""",
)
def reject_reasons(spark, sf_dir):
    return rejection_counts(features(spark, sf_dir), {**RANGES, "qty": (20, 300)})


@query("b6_drop_empty_columns", f"WITH {FEATURES_SQL} SELECT code, avg_price, o_orderpriority FROM features")
def drop_empty_columns(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "avg_price", "o_orderpriority")
    wide = df.withColumn("empty", F.expr("nullif(avg_price, avg_price)"))
    model = MissingValueHandler("o_orderpriority").fit(wide)
    return wide.drop(*model.dropped_columns)


@query("b7_drop_wide_text", "SELECT doc_id, lang, source FROM documents")
def drop_wide_text(spark, sf_dir):
    """``n_chars`` is redundant; ``text`` has too many distinct values, ``source`` has few."""
    df = table(spark, sf_dir, "documents")
    gone = wide_text_columns(df, ["text", "source"], 100)
    return df.drop("n_chars", *gone)


@query(
    "b8_type_classes",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, '{k}' AS type_class, COUNT({c}) AS non_null FROM features"
        for c, k in [("code", "number"), ("qty", "number"), ("types", "text"), ("c_mktsegment", "text"),
                     ("o_totalprice", "number")])}
       UNION ALL SELECT 'large', 'other', COUNT(*) FILTER (WHERE qty IS NOT NULL) FROM features""",
)
def type_classes(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "qty", "types", "c_mktsegment", "o_totalprice")
    return column_classes(df.withColumn("large", F.col("qty") > 100))


@query(
    "b9_metadata_kept",
    f"""WITH {FEATURES_SQL}, s AS (SELECT AVG(c_acctbal) AS m, STDDEV_POP(c_acctbal) AS s FROM features)
       SELECT code, o_orderpriority, {r6_sql("(c_acctbal - m) / s")} AS c_acctbal FROM features, s""",
)
def metadata_kept(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "o_orderpriority", "c_acctbal")
    return rounded(FeatureScaler("standard", exclude=["code", "o_orderpriority"]).fit(df).transform(df), "c_acctbal")


@query(
    "b10_fit_on_train",
    f"""WITH {GRADED_SQL}, {split_sql('graded', 'code', 'grade')},
       s AS (SELECT AVG(c_acctbal) AS m, STDDEV_POP(c_acctbal) AS s FROM divided WHERE split_group = 'train')
       SELECT code, split_group, {r6_sql("(c_acctbal - m) / s")} AS c_acctbal FROM divided, s""",
)
def fit_on_train(spark, sf_dir):
    df = assign_split(stage(graded(spark, sf_dir).select("code", "c_acctbal", "grade")), "grade", "code")
    model = fit_preparation(FeatureScaler("standard", exclude=["code"]), df)
    return rounded(model.transform(df).select("code", "split_group", "c_acctbal"), "c_acctbal")


@query("b11_features_and_target", f"WITH {FEATURES_SQL} SELECT code, qty, c_acctbal FROM features")
def split_off_target(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "qty", "c_acctbal", "o_orderpriority")
    return features_and_target(df, "o_orderpriority")[0]


@query(
    "b12_preconditions",
    "SELECT c AS check_name, TRUE AS refused, (SELECT COUNT(*) FROM orders) AS table_rows FROM (VALUES "
    "('ratios'), ('target'), ('numeric'), ('pca_columns'), ('untrained'), ('unfitted')) t(c)",
)
def preconditions(spark, sf_dir):
    """Each check is provoked on the orders table and must be refused while the plan is built."""
    df = table(spark, sf_dir, "orders")
    texts = df.select("o_orderkey", "o_orderstatus")
    reducer = FeatureReducer(metadata=["o_orderkey"])
    checks = {
        "ratios": lambda: check_ratios(0.7, 0.2, 0.2),
        "target": lambda: assign_split(df, "grade", "o_orderkey"),
        "numeric": lambda: FeatureScaler(exclude=["o_orderkey"]).fit(texts),
        "pca_columns": lambda: reducer.fit(df.select("o_orderkey", "o_totalprice", "o_custkey"))
        .stages[0]
        .transform(texts),
        "untrained": lambda: TrainedModel(Classifier("knn", label="o_orderstatus")).predict(df),
        "unfitted": lambda: FeatureScalerModel().transform(df),
    }
    outcomes = []
    for name, provoke in checks.items():
        try:
            provoke()
            outcomes.append((name, False))
        except ValueError:
            outcomes.append((name, True))
    verdicts = spark.createDataFrame(outcomes, "check_name string, refused boolean")
    return verdicts.withColumn("table_rows", F.lit(df.count()).cast("bigint"))


@query(
    "b13_distinct_documents",
    """SELECT doc_id, lang, source, n_chars FROM documents
       QUALIFY ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def distinct_documents(spark, sf_dir):
    return drop_duplicates(table(spark, sf_dir, "documents"), ["text"], "doc_id").drop("text")


FLOW_SQL = f"""{FEATURES_SQL},
filled AS (SELECT code, o_orderpriority, c_acctbal, o_totalprice,
    COALESCE(avg_price, (SELECT MEDIAN(avg_price) FROM features)) AS avg_price,
    COALESCE(avg_disc, (SELECT MEDIAN(avg_disc) FROM features)) AS avg_disc FROM features),
kept AS (SELECT * FROM filled WHERE {IN_RANGE}),
derived AS (SELECT *, CASE WHEN avg_disc = 0 THEN 0e0 ELSE avg_price / avg_disc END AS price_per_disc,
    CASE WHEN avg_price > 40000 THEN 1 ELSE 0 END AS dear FROM kept),
moments AS (SELECT {", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}"
                              for c in ("c_acctbal", "o_totalprice", "avg_price", "avg_disc", "price_per_disc", "dear"))}
    FROM derived)"""
FLOW_RULES = {
    "ratios": [("price_per_disc", "avg_price", "avg_disc")],
    "flags": [("dear", "avg_price", 40000.0)],
}
FLOW_COLUMNS = ["c_acctbal", "o_totalprice", "avg_price", "avg_disc", "price_per_disc", "dear"]


@query(
    "b14_stage_switches",
    f"""WITH {FLOW_SQL} SELECT code, o_orderpriority,
       {", ".join(f"{r6_sql(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in FLOW_COLUMNS)} FROM derived, moments""",
)
def stage_switches(spark, sf_dir):
    """Encoding and PCA off; missing values, ranges, derived features and scaling in their fixed order."""
    df = stage(
        features(spark, sf_dir).select("code", "avg_price", "avg_disc", "c_acctbal", "o_totalprice", "o_orderpriority")
    )
    flow = preparation(
        target="o_orderpriority",
        scaling_method="standard",
        include_encoding=False,
        include_pca=False,
        ranges=RANGES,
        rules=FLOW_RULES,
        metadata=["code", "o_orderpriority"],
        log_columns=[],
    )
    return rounded(fit_preparation(flow, df).transform(df), *FLOW_COLUMNS)
