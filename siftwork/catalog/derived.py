"""Derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import FEATURES_SQL, features, query, r6, r6_sql, rounded
from siftwork.functions.columns import above, safe_ratio, scaled_by
from siftwork.operators.derive import FeatureDeriver

RATIO = "CASE WHEN avg_disc = 0 OR avg_disc IS NULL THEN 0e0 ELSE avg_price / avg_disc END"


@query("g1_safe_ratio", f"WITH {FEATURES_SQL} SELECT code, {r6_sql(RATIO)} AS price_per_disc FROM features")
def ratio(spark, sf_dir):
    df = features(spark, sf_dir)
    return df.select("code", r6(safe_ratio(F.col("avg_price"), F.col("avg_disc"))).alias("price_per_disc"))


@query("g2_density", f"WITH {FEATURES_SQL} SELECT code, {r6_sql('COALESCE(avg_price / 1e2, 0e0)')} AS density FROM features")
def density(spark, sf_dir):
    deriver = FeatureDeriver(rules={"densities": [("density", "avg_price", 100.0)]})
    return rounded(deriver.transform(features(spark, sf_dir).select("code", "avg_price")).drop("avg_price"), "density")


@query(
    "g3_contributions",
    f"""WITH {FEATURES_SQL} SELECT code, {r6_sql("COALESCE(avg_qty * 9e0, 0e0)")} AS from_qty,
       {r6_sql("COALESCE(avg_disc * 4e0, 0e0)")} AS from_disc FROM features""",
)
def contributions(spark, sf_dir):
    return features(spark, sf_dir).select(
        "code",
        r6(scaled_by(F.col("avg_qty"), 9.0)).alias("from_qty"),
        r6(scaled_by(F.col("avg_disc"), 4.0)).alias("from_disc"),
    )


@query(
    "g4_flags",
    f"""WITH {FEATURES_SQL} SELECT code, CASE WHEN avg_qty > 25 THEN 1 ELSE 0 END AS large,
       CASE WHEN c_acctbal > 4500 THEN 1 ELSE 0 END AS wealthy FROM features""",
)
def flags(spark, sf_dir):
    return features(spark, sf_dir).select(
        "code", above(F.col("avg_qty"), 25.0).alias("large"), above(F.col("c_acctbal"), 4500.0).alias("wealthy")
    )


@query(
    "g5_derived_features",
    f"""WITH {FEATURES_SQL} SELECT code, {r6_sql(RATIO)} AS price_per_disc,
       {r6_sql("COALESCE(avg_price / 1e2, 0e0)")} AS density, {r6_sql("COALESCE(avg_qty * 9e0, 0e0)")} AS from_qty,
       {r6_sql("c_acctbal + o_totalprice")} AS worth FROM features""",
)
def derived_features(spark, sf_dir):
    """Flags switched off, a rule with an absent input skipped, one rule given as SQL."""
    rules = {
        "ratios": [("price_per_disc", "avg_price", "avg_disc"), ("lost", "avg_price", "absent")],
        "densities": [("density", "avg_price", 100.0)],
        "contributions": [("from_qty", "avg_qty", 9.0)],
        "flags": [("large", "avg_qty", 25.0)],
        "sql": [("worth", "c_acctbal + o_totalprice")],
    }
    names = ["price_per_disc", "density", "from_qty", "worth"]
    out = FeatureDeriver(flags=False, rules=rules).transform(features(spark, sf_dir))
    return rounded(out, *names).select("code", *names)
