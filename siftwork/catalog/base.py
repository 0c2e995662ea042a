"""Registry, input views and shared SQL text.

The wide input is ``features``: one row per order with line-item averages
(missing for orders without lines), customer columns and labels.  Averages are
taken over whole cents, so the view has the same bits on every engine and in
every run, whatever the order of summation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column) -> Column:
    """Rounded for comparison; the nudge keeps exact halves from going either way."""
    return F.round(value + F.lit(1e-9), 6)


def r6_sql(value: str) -> str:
    return f"(ROUND(({value}) + 1e-9, 6) + 0e0)"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(F.col(f"`{n}`")) for n in names})


GRADE = """SUBSTR('abcde', 1 + (CASE WHEN avg_disc > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN avg_qty > 25 THEN 1 ELSE 0 END)
     + (CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) + (CASE WHEN c_acctbal > 4500 THEN 1 ELSE 0 END), 1)"""

NUMBERS = ["qty", "avg_qty", "avg_price", "avg_disc", "max_tax", "c_acctbal", "o_totalprice"]
RANGES = {"c_acctbal": (0, 9000), "o_totalprice": (0, 450000)}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def line_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    )

    def total(c: str) -> Column:
        return F.sum(F.round(F.col(c) * 100).cast("bigint")).cast("double")

    n = F.count(F.lit(1))
    return lines.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("qty"),
        (F.sum(F.col("l_quantity").cast("bigint")).cast("double") / n).alias("avg_qty"),
        (total("l_extendedprice") / n / 100).alias("avg_price"),
        (total("l_discount") / n / 100).alias("avg_disc"),
        F.max("l_tax").alias("max_tax"),
        # Six labels exist, so the set stays small however many lines an order has.
        F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(line_averages(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("code"),
            "qty",
            "avg_qty",
            "avg_price",
            "avg_disc",
            "max_tax",
            "types",
            "c_acctbal",
            "c_mktsegment",
            "n_name",
            "o_totalprice",
            "o_orderpriority",
        )
    )


FEATURES_SQL = """li AS (
  SELECT l_orderkey,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS qty,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / COUNT(*) AS avg_qty,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 1e2 AS avg_price,
         CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 1e2 AS avg_disc,
         MAX(l_tax) AS max_tax,
         string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
features AS (
  SELECT o_orderkey AS code, li.qty, li.avg_qty, li.avg_price, li.avg_disc, li.max_tax, li.types,
         c_acctbal, c_mktsegment, n_name, o_totalprice, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN li ON l_orderkey = o_orderkey)"""


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lines, and a five-class label planted on thresholds."""
    return features(spark, sf_dir).where(F.col("qty").isNotNull()).withColumn("grade", F.expr(GRADE))


GRADED_SQL = f"{FEATURES_SQL}, graded AS (SELECT *, {GRADE} AS grade FROM features WHERE qty IS NOT NULL)"

RAW_GRADE = f"""CASE WHEN qty IS NULL THEN NULL WHEN max_tax < 0.03 THEN 'unknown'
  WHEN c_mktsegment = 'BUILDING' THEN UPPER({GRADE}) ELSE {GRADE} END"""


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As landed: labels in mixed case, some missing, some outside the classes."""
    return features(spark, sf_dir).withColumn("grade", F.expr(RAW_GRADE))


RAW_SQL = f"{FEATURES_SQL}, raw AS (SELECT *, {RAW_GRADE} AS grade FROM features)"


def split_sql(source: str, key: str, target: str, seed: int = 42) -> str:
    """CTEs that end in ``divided``: ``source`` plus ``split_group`` (70/15/15, stratified)."""
    return f"""sizes AS (SELECT {target} AS k, COUNT(*) AS n FROM {source} GROUP BY 1),
totals AS (SELECT CAST(SUM(n) AS BIGINT) AS n, CAST(CEIL((0.15e0 + 0.15e0) * SUM(n)) AS BIGINT) AS n_rest FROM sizes),
t1 AS (SELECT k, sizes.n, (sizes.n * (totals.n - n_rest)) // totals.n AS base,
         (sizes.n * (totals.n - n_rest)) % totals.n AS rem, totals.n - n_rest AS want, n_rest FROM sizes, totals),
t2 AS (SELECT k, n, n_rest, base + CASE WHEN ROW_NUMBER() OVER (ORDER BY rem DESC, k)
         <= want - SUM(base) OVER () THEN 1 ELSE 0 END AS in_train FROM t1),
v1 AS (SELECT *, n - in_train AS rest, n_rest - CAST(CEIL(0.5e0 * n_rest) AS BIGINT) AS n_val FROM t2),
v2 AS (SELECT *, (rest * n_val) // n_rest AS base, (rest * n_val) % n_rest AS rem FROM v1),
quotas AS (SELECT k, in_train, base + CASE WHEN ROW_NUMBER() OVER (ORDER BY rem DESC, k)
         <= n_val - SUM(base) OVER () THEN 1 ELSE 0 END AS in_val FROM v2),
ordered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {target} ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR))) AS rk
         FROM {source}),
divided AS (SELECT ordered.* EXCLUDE (rk), CASE WHEN rk <= in_train THEN 'train'
         WHEN rk <= in_train + in_val THEN 'val' ELSE 'test' END AS split_group
         FROM ordered JOIN quotas ON quotas.k = ordered.{target})"""


def folds_sql(source: str, key: str, target: str, folds: int = 5, seed: int = 42, prefix: str = "") -> str:
    """CTEs that end in ``{prefix}folded``: ``source`` plus ``fold``."""
    p = prefix
    return f"""{p}fc AS (SELECT {target} AS k, COUNT(*) AS n FROM {source} GROUP BY 1),
{p}fo AS (SELECT k, n, COALESCE(CAST(SUM(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0)
         AS off FROM {p}fc),
{p}fq AS (SELECT k, f, GREATEST(0, (n - ((((f - off) % {folds}) + {folds}) % {folds}) + {folds - 1}) // {folds}) AS q
         FROM {p}fo, (SELECT UNNEST(range({folds})) AS f)),
{p}fe AS (SELECT k, f, q, CAST(SUM(q) OVER (PARTITION BY k ORDER BY f) AS BIGINT) AS e FROM {p}fq),
{p}fr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {target} ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR))) AS rk
         FROM {source}),
{p}folded AS (SELECT {p}fr.* EXCLUDE (rk), CAST(f AS INTEGER) AS fold FROM {p}fr JOIN {p}fe
         ON {p}fe.k = {p}fr.{target} AND rk <= e AND rk > e - q)"""
