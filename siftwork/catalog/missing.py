"""Missing values: profile, imputation, statistics."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from siftwork.catalog.base import FEATURES_SQL, features, query, r6, r6_sql, rounded, table
from siftwork.functions.columns import safe_ratio
from siftwork.operators.missing import MissingValueHandler
from siftwork.operators.profile import missing_profile
from siftwork.sources.shared import stage

PROFILED = {"qty": "double", "avg_price": "double", "types": "string", "c_acctbal": "double", "c_mktsegment": "string"}
NUMERIC = ["qty", "avg_qty", "avg_price", "avg_disc"]


@query(
    "c1_missing_profile",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) - COUNT({c}) AS missing_count, "
        f"ROUND((COUNT(*) - COUNT({c})) * 1e2 / COUNT(*), 2) + 0e0 AS missing_percentage, '{t}' AS dtype, "
        f"COUNT(DISTINCT {c}) AS unique_values FROM features" for c, t in PROFILED.items())}""",
)
def profile(spark, sf_dir):
    return missing_profile(features(spark, sf_dir), list(PROFILED))


@query(
    "c2_median_impute",
    f"""WITH {FEATURES_SQL} SELECT code, o_orderpriority,
       {", ".join(f"{r6_sql(f'COALESCE({c}, (SELECT MEDIAN({c}) FROM features))')} AS {c}" for c in NUMERIC)}
       FROM features""",
)
def median_impute(spark, sf_dir):
    df = stage(features(spark, sf_dir).select("code", "o_orderpriority", *NUMERIC))
    return rounded(MissingValueHandler("o_orderpriority").fit(df).transform(df), *NUMERIC)


@query(
    "c3_constant_impute",
    f"WITH {FEATURES_SQL} SELECT code, o_orderpriority, COALESCE(max_tax, 0e0) AS max_tax FROM features",
)
def constant_impute(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "o_orderpriority", "max_tax")
    return MissingValueHandler("o_orderpriority", constants={"max_tax": 0}).fit(df).transform(df)


@query(
    "c4_text_impute",
    f"WITH {FEATURES_SQL} SELECT code, o_orderpriority, COALESCE(types, 'unknown') AS types FROM features",
)
def text_impute(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "o_orderpriority", "types")
    return MissingValueHandler("o_orderpriority").fit(df).transform(df)


WITH_LABELS = """lab AS (SELECT d.doc_id AS code, lang, CASE WHEN lang = 'fr' THEN NULL ELSE n_chars END AS n_chars,
    CASE WHEN source IN ('src0', 'src1') THEN NULL ELSE source END AS source, NULLIF(lang, lang) AS empty,
    CAST(toxic AS DOUBLE) AS toxic, CAST(l.quality AS VARCHAR) AS quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled_documents(spark, sf_dir):
    """Documents whose label is often missing, with gaps in a number and in a text column."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("code"),
        "lang",
        F.when(F.col("lang") != "fr", F.col("n_chars")).alias("n_chars"),
        F.when(~F.col("source").isin("src0", "src1"), F.col("source")).alias("source"),
        F.expr("nullif(lang, lang)").alias("empty"),
        F.col("toxic").cast("double").alias("toxic"),
        F.col("quality").cast("string").alias("quality"),
    )


HANDLED = f"""WITH {WITH_LABELS}, kept AS (SELECT * FROM lab WHERE quality IS NOT NULL),
  m AS (SELECT CAST(MEDIAN(n_chars) AS DOUBLE) AS n, CAST(MEDIAN(toxic) AS DOUBLE) AS t FROM kept)
  SELECT code, lang, COALESCE(CAST(n_chars AS DOUBLE), n) AS n_chars, COALESCE(source, 'unknown') AS source,
    COALESCE(toxic, t) AS toxic, quality FROM kept, m"""


@query("c5_handler", HANDLED)
def handler(spark, sf_dir):
    """Drop the empty column, drop unlabelled rows, fill numbers with medians and texts with a placeholder."""
    df = stage(labelled_documents(spark, sf_dir))
    return MissingValueHandler("quality").fit(df).transform(df)


STATS = """SELECT '{c}' AS column, '{m}' AS method, {v} AS value, COUNT(*) - COUNT({c}) AS missing_count,
  '{r}' AS rationale FROM features"""


@query(
    "c6_imputation_stats",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join([
        *[STATS.format(c=c, m="median", v=r6_sql(f"MEDIAN({c})"), r="Median imputation") for c in NUMERIC],
        STATS.format(c="max_tax", m="constant", v="0e0", r="Fixed value"),
        STATS.format(c="types", m="constant", v="NULL", r="Placeholder for missing categorical data"),
    ])}""",
)
def imputation_stats(spark, sf_dir):
    df = stage(features(spark, sf_dir).select("code", "o_orderpriority", "types", "max_tax", "c_acctbal", *NUMERIC))
    model = MissingValueHandler("o_orderpriority", constants={"max_tax": 0}).fit(df)
    return model.imputation_stats(df).withColumn("value", r6(F.col("value").try_cast("double")))


@query("c7_handler_stage", HANDLED)
def handler_stage(spark, sf_dir):
    """The same handler as a stage of an ML flow; the label is a column like any other."""
    df = stage(labelled_documents(spark, sf_dir))
    return Pipeline(stages=[MissingValueHandler("quality")]).fit(df).transform(df)


@query(
    "c8_zero_fill",
    f"""WITH {FEATURES_SQL} SELECT code, qty, {r6_sql("COALESCE(avg_price / NULLIF(qty, 0), 0e0)")} AS price_per_unit
       FROM features""",
)
def zero_fill(spark, sf_dir):
    df = features(spark, sf_dir).select("code", "qty", "avg_price")
    return df.select("code", "qty", r6(safe_ratio(F.col("avg_price"), F.col("qty"))).alias("price_per_unit"))
