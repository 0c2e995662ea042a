"""Samples, splits, folds and their check."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import FEATURES_SQL, GRADED_SQL, features, folds_sql, graded, query, r6_sql, rounded, split_sql, table
from siftwork.operators.split import (
    assign_folds,
    assign_split,
    mark_split,
    sample_exact,
    split_distribution,
    verify_stratification,
)
from siftwork.sources.shared import stage


@query(
    "j1_sample",
    """SELECT o_orderkey, o_orderpriority FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)) LIMIT 1000""",
)
def sample(spark, sf_dir):
    return sample_exact(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", 1000)


@query(
    "j2_split",
    f"""WITH o AS (SELECT o_orderkey, o_orderpriority FROM orders), {split_sql('o', 'o_orderkey', 'o_orderpriority')}
       SELECT * FROM divided""",
)
def split(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return assign_split(df, "o_orderpriority", "o_orderkey")


@query(
    "j3_split_unstratified",
    """WITH n AS (SELECT COUNT(*) AS n, CAST(CEIL(0.3e0 * COUNT(*)) AS BIGINT) AS rest FROM orders),
       o AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) AS rk FROM orders)
       SELECT o_orderkey, CASE WHEN rk <= n - rest THEN 'train'
         WHEN rk <= n - CAST(CEIL(0.5e0 * rest) AS BIGINT) THEN 'val' ELSE 'test' END AS split_group FROM o, n""",
)
def split_unstratified(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return assign_split(df, "o_orderpriority", "o_orderkey", stratify=False).drop("o_orderpriority")


@query(
    "j4_mark_split",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'train' WHEN o_orderstatus = 'O' THEN 'val' ELSE 'test' END
       AS split_group FROM orders""",
)
def mark(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    train, val = (df.where(F.col("o_orderstatus") == s).select("o_orderkey") for s in ("F", "O"))
    return mark_split(df, "o_orderkey", train, val).drop("o_orderstatus")


DIVIDED = f"{GRADED_SQL}, {split_sql('graded', 'code', 'grade')}"


def divided(spark, sf_dir):
    return assign_split(stage(graded(spark, sf_dir).select("code", "grade")), "grade", "code")


def _share(split: str) -> str:
    n = f"COUNT(*) FILTER (WHERE split_group = '{split}')"
    return f"{n} / (SELECT COUNT(*) FROM divided WHERE split_group = '{split}')"


@query(
    "j5_verify",
    f"""WITH {DIVIDED}, s AS (SELECT grade, {_share('train')} AS t, {_share('val')} AS v, {_share('test')} AS e
         FROM divided GROUP BY 1), d AS (SELECT MAX(GREATEST(ABS(v - t), ABS(e - t))) AS d FROM s)
       SELECT {r6_sql('d')} AS max_deviation, d < 0.05 AS is_balanced FROM d""",
)
def verify(spark, sf_dir):
    return rounded(verify_stratification(divided(spark, sf_dir), "grade"), "max_deviation")


@query(
    "j5_distribution",
    f"""WITH {DIVIDED} SELECT grade AS class,
       {", ".join(f"COUNT(*) FILTER (WHERE split_group = '{s}') AS n_{s}" for s in ('train', 'val', 'test'))},
       {", ".join(f"{r6_sql(_share(s))} AS share_{s}" for s in ('train', 'val', 'test'))} FROM divided GROUP BY 1""",
)
def distribution(spark, sf_dir):
    df = split_distribution(divided(spark, sf_dir), "grade")
    return rounded(df, "share_train", "share_val", "share_test")


@query(
    "j6_folds",
    f"""WITH o AS (SELECT o_orderkey, o_orderpriority FROM orders), {folds_sql('o', 'o_orderkey', 'o_orderpriority')}
       SELECT * FROM folded""",
)
def folds(spark, sf_dir):
    return assign_folds(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey")


@query(
    "l15_report_sample",
    f"""WITH {FEATURES_SQL} SELECT code, c_acctbal, o_totalprice, o_orderpriority FROM features
       ORDER BY md5('7:' || CAST(code AS VARCHAR)) LIMIT 1000""",
)
def report_sample(spark, sf_dir):
    """The seeded thousand rows drawn for a pair plot."""
    df = stage(features(spark, sf_dir).select("code", "c_acctbal", "o_totalprice", "o_orderpriority"))
    return sample_exact(df, "code", 1000, seed=7)
