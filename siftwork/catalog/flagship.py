"""The flagship: clean the order features and summarise them by class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftwork.catalog.base import FEATURES_SQL, RANGES, features, query, r6, r6_sql
from siftwork.catalog.filters import IN_RANGE
from siftwork.operators.missing import MissingValueHandler
from siftwork.operators.outliers import range_filter
from siftwork.sources.shared import stage


@query(
    "flagship_clean_profile",
    f"""WITH {FEATURES_SQL},
       med AS (SELECT MEDIAN(qty) AS q, MEDIAN(avg_price) AS p FROM features),
       filled AS (SELECT o_orderpriority, c_acctbal, o_totalprice, COALESCE(qty, q) AS qty,
         COALESCE(avg_price, p) AS avg_price FROM features, med)
       SELECT o_orderpriority, COUNT(*) AS n, {r6_sql("AVG(qty)")} AS mean_qty, {r6_sql("AVG(avg_price)")} AS mean_price,
         MIN(c_acctbal) AS min_balance, MAX(o_totalprice) AS max_total
       FROM filled WHERE {IN_RANGE} GROUP BY 1""",
)
def cleaned_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stage(features(spark, sf_dir).select("code", "qty", "avg_price", "c_acctbal", "o_totalprice", "o_orderpriority"))
    filled = MissingValueHandler("o_orderpriority").fit(df).transform(df)
    return (
        range_filter(filled, RANGES)
        .groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n"),
            r6(F.avg("qty")).alias("mean_qty"),
            r6(F.avg("avg_price")).alias("mean_price"),
            F.min("c_acctbal").alias("min_balance"),
            F.max("o_totalprice").alias("max_total"),
        )
    )
