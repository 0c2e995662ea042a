"""Categorical encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import (
    FEATURES_SQL,
    GRADED_SQL,
    PRIORITIES,
    TYPES,
    features,
    folds_sql,
    graded,
    query,
    r6_sql,
    rounded,
)
from siftwork.functions.columns import col
from siftwork.functions.labels import parse_labels
from siftwork.operators.encode import FeatureEncoder, LabelCoder, label_sums, out_of_fold_target, top_labels
from siftwork.operators.split import assign_folds
from siftwork.sources.shared import stage

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def encoded_sql(source: str, column: str, hit: str, name: str) -> str:
    """Smoothed share of ``hit`` per category, as a CTE of (category, value, mean)."""
    return f"""{name}_g AS (SELECT AVG({hit}) AS m, VAR_POP({hit}) AS v FROM {source}),
{name} AS (SELECT {column} AS category, ANY_VALUE(m) AS mean,
  ANY_VALUE(v) * COUNT(*) / (ANY_VALUE(v) * COUNT(*) + VAR_POP({hit})) * AVG({hit})
  + (1 - ANY_VALUE(v) * COUNT(*) / (ANY_VALUE(v) * COUNT(*) + VAR_POP({hit}))) * ANY_VALUE(m) AS value
  FROM {source}, {name}_g GROUP BY 1)"""


def _hit(priority: str) -> str:
    return f"CASE WHEN o_orderpriority = '{priority}' THEN 1e0 ELSE 0e0 END"


TOP_SQL = """lt AS (SELECT code, UNNEST(list_distinct(string_split(types, ','))) AS label FROM features WHERE types IS NOT NULL),
top AS (SELECT label, COUNT(*) AS rows FROM lt GROUP BY 1 ORDER BY rows DESC, label LIMIT {n})"""


@query("f1_top_labels", f"WITH {FEATURES_SQL}, {TOP_SQL.format(n=3)} SELECT label, rows FROM top")
def most_frequent(spark, sf_dir):
    return top_labels(features(spark, sf_dir), parse_labels(F.col("types"), {}), 3)


def _marks() -> str:
    return ", ".join(f"CAST(COALESCE(list_contains(string_split(types, ','), '{t}'), FALSE) AS INTEGER) AS types_{t}" for t in TYPES)


@query("f2_multilabel", f"WITH {FEATURES_SQL} SELECT code, {_marks()} FROM features")
def multilabel(spark, sf_dir):
    df = stage(features(spark, sf_dir).select("code", "types"))
    encoder = FeatureEncoder({"types": "multilabel"}, "code", top_n=6, aliases={"none": "none"})
    return encoder.fit(df).transform(df)


@query(
    "f3_onehot",
    f"""WITH {FEATURES_SQL} SELECT code,
       {", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1e0 ELSE 0e0 END AS c_mktsegment_{s}" for s in SEGMENTS if s != 'MACHINERY')}
       FROM features""",
)
def onehot(spark, sf_dir):
    """Levels come from the fit rows; a level unseen there gives zeros everywhere."""
    df = features(spark, sf_dir).select("code", "c_mktsegment")
    model = FeatureEncoder({"c_mktsegment": "onehot"}, "code").fit(df.where("c_mktsegment <> 'MACHINERY'"))
    return model.transform(df)


@query(
    "f4_target_encode",
    f"""WITH {FEATURES_SQL}, {encoded_sql('features', 'n_name', _hit('1-URGENT'), 'e')}
       SELECT code, o_orderpriority, {r6_sql('value')} AS n_name FROM features JOIN e ON category = n_name""",
)
def target_encode(spark, sf_dir):
    df = stage(features(spark, sf_dir).select("code", "o_orderpriority", "n_name"))
    return rounded(FeatureEncoder({"n_name": "target"}, "o_orderpriority").fit(df).transform(df), "n_name")


@query(
    "f4_target_per_class",
    f"""WITH {FEATURES_SQL}, {", ".join(encoded_sql('features', 'n_name', _hit(p), f'e{i}') for i, p in enumerate(PRIORITIES))}
       SELECT code, o_orderpriority, {", ".join(f'{r6_sql(f"e{i}.value")} AS "n_name_{p}"' for i, p in enumerate(PRIORITIES))}
       FROM features {" ".join(f"JOIN e{i} ON e{i}.category = n_name" for i in range(5))}""",
)
def target_per_class(spark, sf_dir):
    df = stage(features(spark, sf_dir).select("code", "o_orderpriority", "n_name"))
    encoder = FeatureEncoder({"n_name": "target"}, "o_orderpriority", per_class=True)
    return rounded(encoder.fit(df).transform(df), *[f"n_name_{p}" for p in PRIORITIES])


@query(
    "f4_target_out_of_fold",
    f"""WITH {GRADED_SQL}, {folds_sql('graded', 'code', 'grade')},
       y AS (SELECT code, n_name, fold, CASE WHEN grade = 'c' THEN 1e0 ELSE 0e0 END AS y FROM folded),
       g AS (SELECT f, AVG(y) AS m, VAR_POP(y) AS v FROM y, (SELECT DISTINCT fold AS f FROM y) WHERE fold <> f GROUP BY 1),
       c AS (SELECT f, n_name, COUNT(*) AS n, AVG(y) AS m, VAR_POP(y) AS v
             FROM y, (SELECT DISTINCT fold AS f FROM y) WHERE fold <> f GROUP BY 1, 2)
       SELECT y.code, y.fold, {r6_sql("COALESCE(g.v * n / (g.v * n + c.v) * c.m + (1 - g.v * n / (g.v * n + c.v)) * g.m, g.m)")} AS encoded
       FROM y JOIN g ON g.f = y.fold LEFT JOIN c ON c.f = y.fold AND c.n_name = y.n_name""",
)
def target_out_of_fold(spark, sf_dir):
    df = assign_folds(stage(graded(spark, sf_dir).select("code", "n_name", "grade")), "grade", "code")
    hit = (F.col("grade") == "c").cast("double")
    return rounded(out_of_fold_target(df, "n_name", hit, "fold", "encoded").select("code", "fold", "encoded"), "encoded")


@query(
    "f5_encoder",
    f"""WITH {FEATURES_SQL}, {encoded_sql('features', 'n_name', _hit('1-URGENT'), 'e')}
       SELECT code, o_orderpriority, {r6_sql('value')} AS n_name, {_marks()},
       {", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1e0 ELSE 0e0 END AS c_mktsegment_{s}" for s in SEGMENTS)}
       FROM features JOIN e ON category = n_name""",
)
def encoder(spark, sf_dir):
    """One encoder, one method per column, columns the table lacks skipped."""
    df = stage(features(spark, sf_dir).select("code", "types", "c_mktsegment", "n_name", "o_orderpriority"))
    methods = {"types": "multilabel", "c_mktsegment": "onehot", "n_name": "target", "absent": "onehot"}
    model = FeatureEncoder(methods, "o_orderpriority", top_n=6, aliases={"none": "none"}).fit(df)
    return rounded(model.transform(df), "n_name")


@query(
    "f6_label_codes",
    """SELECT o_orderkey, CAST(DENSE_RANK() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label,
       o_orderpriority AS decoded FROM orders""",
)
def label_codes(spark, sf_dir):
    df = table_orders(spark, sf_dir)
    model = LabelCoder("o_orderpriority", "label").fit(df)
    return model.transform(df).select("o_orderkey", "label", model.decode(F.col("label")).alias("decoded"))


def table_orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority")


@query(
    "l16_indicator_sums",
    f"""WITH {FEATURES_SQL}, m AS (SELECT {_marks()} FROM features)
       {" UNION ALL ".join(f"SELECT 'types_{t}' AS column, CAST(SUM(types_{t}) AS BIGINT) AS rows FROM m" for t in TYPES)}""",
)
def indicator_sums(spark, sf_dir):
    marks = multilabel(spark, sf_dir)
    return label_sums(marks, [c for c in marks.columns if c.startswith("types_")])


@query(
    "l19_encoded_range",
    f"""WITH {FEATURES_SQL}, {encoded_sql('features', 'n_name', _hit('1-URGENT'), 'e')}
       SELECT {r6_sql('MIN(value)')} AS low, {r6_sql('MAX(value)')} AS high FROM features JOIN e ON category = n_name""",
)
def encoded_range(spark, sf_dir):
    df = target_encode(spark, sf_dir)
    return df.agg(F.min(col("n_name")).alias("low"), F.max(col("n_name")).alias("high"))
