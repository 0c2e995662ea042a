"""Outlier profile, interquartile filter and their reports."""

from __future__ import annotations

from siftwork.catalog.base import FEATURES_SQL, features, query, r6_sql, rounded
from siftwork.operators.explore import box_stats
from siftwork.operators.outliers import OutlierFilter, before_after, outlier_profile
from siftwork.sources.shared import stage

CHECKED = {"c_acctbal": (0, 9000), "o_totalprice": (0, 450000), "qty": (2, 1000), "avg_disc": (0, 1)}
MEASURES = ["iqr_lower", "iqr_upper", "min", "max", "median"]


def _profile_sql(source: str, columns: dict) -> str:
    parts = []
    for c, (low, high) in columns.items():
        parts.append(
            f"""SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} < 0) AS negative_count,
  COUNT(*) FILTER (WHERE {c} < {low}) AS below_min, COUNT(*) FILTER (WHERE {c} > {high}) AS above_max,
  {low}e0 AS range_min, {high}e0 AS range_max,
  COUNT(*) FILTER (WHERE {c} < lo OR {c} > hi) AS statistical_outliers,
  {r6_sql("ANY_VALUE(lo)")} AS iqr_lower, {r6_sql("ANY_VALUE(hi)")} AS iqr_upper,
  {r6_sql(f"MIN({c})")} AS min, {r6_sql(f"MAX({c})")} AS max, {r6_sql(f"MEDIAN({c})")} AS median
  FROM {source}, (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM
    (SELECT QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.75) AS q3 FROM {source}))"""
        )
    return " UNION ALL ".join(parts)


# Rows outside the upper fence must exist for the filter to have an effect.
FENCED = {"c_acctbal": (0, 9000), "price_ratio": (0, 1000000)}
FENCED_SQL = f"""{FEATURES_SQL}, fe AS (SELECT code, c_acctbal,
  CASE WHEN avg_disc = 0 THEN 0e0 ELSE avg_price / avg_disc END AS price_ratio FROM features),
inside AS (SELECT * FROM fe WHERE c_acctbal BETWEEN 0 AND 9000
  AND (price_ratio IS NULL OR price_ratio BETWEEN 0 AND 1000000)),
fences AS (SELECT LEAST(9000, QUANTILE_CONT(c_acctbal, 0.75) + 3 * (QUANTILE_CONT(c_acctbal, 0.75) - QUANTILE_CONT(c_acctbal, 0.25))) AS a,
  LEAST(1000000, QUANTILE_CONT(price_ratio, 0.75) + 3 * (QUANTILE_CONT(price_ratio, 0.75) - QUANTILE_CONT(price_ratio, 0.25))) AS r
  FROM inside),
cleaned AS (SELECT inside.* FROM inside, fences WHERE c_acctbal <= a AND (price_ratio IS NULL OR price_ratio <= r))"""


def fenced_input(spark, sf_dir):
    ratio = "IF(avg_disc = 0, 0D, avg_price / avg_disc) AS price_ratio"
    return stage(features(spark, sf_dir).selectExpr("code", "c_acctbal", ratio))


@query("d1_outlier_profile", f"WITH {FEATURES_SQL} {_profile_sql('features', CHECKED)}")
def profile(spark, sf_dir):
    return rounded(outlier_profile(stage(features(spark, sf_dir).select(*CHECKED)), CHECKED), *MEASURES)


@query("d2_iqr_filter", f"WITH {FENCED_SQL} SELECT code, c_acctbal, {r6_sql('price_ratio')} AS price_ratio FROM cleaned")
def iqr_filter(spark, sf_dir):
    df = fenced_input(spark, sf_dir)
    return rounded(OutlierFilter(FENCED, statistical=True).fit(df).transform(df), "price_ratio")


@query(
    "d3_before_after",
    f"""WITH {FENCED_SQL} SELECT 'before_cleaning' AS stage, * FROM ({_profile_sql('fe', FENCED)})
       UNION ALL SELECT 'after_cleaning', * FROM ({_profile_sql('cleaned', FENCED)})""",
)
def before_and_after(spark, sf_dir):
    df = fenced_input(spark, sf_dir)
    cleaned = OutlierFilter(FENCED, statistical=True).fit(df).transform(df)
    return rounded(before_after(df, stage(cleaned), FENCED), *MEASURES)


@query(
    "d3_removal_summary",
    f"""WITH {FENCED_SQL}, n AS (SELECT
         (SELECT COUNT(*) FROM fe WHERE NOT (c_acctbal BETWEEN 0 AND 9000)) AS a,
         (SELECT COUNT(*) FROM fe WHERE c_acctbal BETWEEN 0 AND 9000 AND price_ratio > 1000000) AS p,
         (SELECT COUNT(*) FROM inside, fences WHERE price_ratio > r) AS f, r FROM fences)
       SELECT 'c_acctbal' AS column, a AS count, 'Outside valid range (0, 9000)' AS reason FROM n WHERE a > 0
       UNION ALL SELECT 'price_ratio', CASE WHEN p > 0 THEN p ELSE f END,
         CASE WHEN p > 0 THEN 'Outside valid range (0, 1000000)'
           ELSE 'Extreme statistical outlier (3*IQR, upper bound: ' || printf('%.2f', r) || ')' END
       FROM n WHERE p > 0 OR f > 0""",
)
def removal_summary(spark, sf_dir):
    df = fenced_input(spark, sf_dir)
    return OutlierFilter(FENCED, statistical=True).fit(df).removal_summary(df)


@query(
    "d3_removal_totals",
    f"""WITH {FENCED_SQL}, n AS (SELECT (SELECT COUNT(*) FROM fe) AS b, (SELECT COUNT(*) FROM cleaned) AS a)
       SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed, {r6_sql("(b - a) * 1e2 / b")} AS removal_percentage
       FROM n""",
)
def removal_totals(spark, sf_dir):
    df = fenced_input(spark, sf_dir)
    return rounded(OutlierFilter(FENCED, statistical=True).fit(df).removal_totals(df), "removal_percentage")


@query(
    "d4_tukey_stats",
    f"""WITH {FENCED_SQL}, q AS (SELECT QUANTILE_CONT(price_ratio, 0.25) AS q1, QUANTILE_CONT(price_ratio, 0.5) AS q2,
         QUANTILE_CONT(price_ratio, 0.75) AS q3 FROM fe)
       SELECT 'price_ratio' AS column, {r6_sql("ANY_VALUE(q1)")} AS q1, {r6_sql("ANY_VALUE(q2)")} AS median,
         {r6_sql("ANY_VALUE(q3)")} AS q3,
         {r6_sql("MIN(price_ratio) FILTER (WHERE price_ratio >= q1 - 1.5 * (q3 - q1))")} AS whisker_low,
         {r6_sql("MAX(price_ratio) FILTER (WHERE price_ratio <= q3 + 1.5 * (q3 - q1))")} AS whisker_high,
         COUNT(*) FILTER (WHERE price_ratio < q1 - 1.5 * (q3 - q1) OR price_ratio > q3 + 1.5 * (q3 - q1)) AS outliers
       FROM fe, q""",
)
def tukey_stats(spark, sf_dir):
    stats = box_stats(fenced_input(spark, sf_dir), ["price_ratio"])
    return rounded(stats, "q1", "median", "q3", "whisker_low", "whisker_high")
