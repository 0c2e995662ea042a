"""Exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import FEATURES_SQL, GRADED_SQL, PRIORITIES, features, graded, query, r6_sql, rounded, table
from siftwork.operators.explore import (
    box_stats,
    class_distribution,
    flag_distribution,
    group_means,
    head,
    histogram,
    kernel_density,
    spearman,
    stage_counts,
    top_categories_by_class,
    value_counts,
)
from siftwork.operators.outliers import in_ranges
from siftwork.operators.profile import (
    categorical_summary,
    column_extremes,
    column_info,
    describe,
    distinct_samples,
    missing_share,
    skewness_table,
)
from siftwork.sources.shared import stage

PLAIN = ["qty", "avg_price", "avg_disc", "c_acctbal"]
INFO = {"code": "bigint", "qty": "double", "types": "string", "c_acctbal": "double", "o_orderpriority": "string"}


@query(
    "l1_class_distribution",
    f"""WITH {GRADED_SQL} SELECT grade AS class, COUNT(*) AS rows, {r6_sql("COUNT(*) / (SELECT COUNT(*) FROM graded)")} AS share
       FROM graded GROUP BY 1""",
)
def classes(spark, sf_dir):
    return rounded(class_distribution(graded(spark, sf_dir), "grade"), "share")


@query(
    "l2_missing_share",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, {r6_sql(f'(COUNT(*) - COUNT({c})) * 1e2 / COUNT(*)')} AS missing_pct FROM features"
        for c in INFO)}""",
)
def missing(spark, sf_dir):
    return rounded(missing_share(features(spark, sf_dir), list(INFO)), "missing_pct")


@query(
    "l3_skewness",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, {r6_sql(f'SKEWNESS({c})')} AS skewness FROM features" for c in PLAIN)}""",
)
def skewness(spark, sf_dir):
    return rounded(skewness_table(features(spark, sf_dir), PLAIN), "skewness")


@query(
    "l4_extremes",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, MIN({c}) AS min, MAX({c}) AS max FROM features" for c in PLAIN)}""",
)
def extremes(spark, sf_dir):
    return column_extremes(features(spark, sf_dir), PLAIN)


@query(
    "l5_group_means",
    f"""WITH {FEATURES_SQL} SELECT o_orderpriority, {", ".join(f"{r6_sql(f'AVG({c})')} AS mean_{c}" for c in PLAIN)}
       FROM features GROUP BY 1""",
)
def means(spark, sf_dir):
    return rounded(group_means(features(spark, sf_dir), "o_orderpriority", PLAIN), *[f"mean_{c}" for c in PLAIN])


def _box(c: str) -> str:
    return f"""SELECT o_orderpriority, '{c}' AS column, {r6_sql('ANY_VALUE(q1)')} AS q1, {r6_sql('ANY_VALUE(q2)')} AS median,
  {r6_sql('ANY_VALUE(q3)')} AS q3, {r6_sql(f'MIN({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
  {r6_sql(f'MAX({c}) FILTER (WHERE {c} <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
  FROM features JOIN (SELECT o_orderpriority, QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS q2,
    QUANTILE_CONT({c}, 0.75) AS q3 FROM features GROUP BY 1) USING (o_orderpriority) GROUP BY 1"""


@query("l6_box_stats", f"WITH {FEATURES_SQL} {' UNION ALL '.join(_box(c) for c in ('qty', 'avg_price', 'c_acctbal'))}")
def boxes(spark, sf_dir):
    columns = ["qty", "avg_price", "c_acctbal"]
    df = stage(features(spark, sf_dir).select("o_orderpriority", *columns))
    return rounded(box_stats(df, columns, "o_orderpriority"), "q1", "median", "q3", "whisker_low", "whisker_high")


MANY = {"l_quantity": "qty", "l_extendedprice": "price"}
MANY_KEY = "CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE l_orderkey END"


def _many(c: str) -> str:
    return f"""SELECT k, '{c}' AS column, {r6_sql('ANY_VALUE(q1)')} AS q1, {r6_sql('ANY_VALUE(q2)')} AS median, {r6_sql('ANY_VALUE(q3)')} AS q3,
  {r6_sql(f'MIN({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
  {r6_sql(f'MAX({c}) FILTER (WHERE {c} <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
  FROM lines JOIN (SELECT k, QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS q2, QUANTILE_CONT({c}, 0.75) AS q3
    FROM lines GROUP BY 1) USING (k) GROUP BY 1"""


@query(
    "l6_box_stats_many_groups",
    f"""WITH lines AS (SELECT CAST({MANY_KEY} AS BIGINT) AS k, {", ".join(f"CAST({c} AS DOUBLE) AS {n}" for c, n in MANY.items())}
       FROM lineitem) {' UNION ALL '.join(_many(n) for n in MANY.values())}""",
)
def many_boxes(spark, sf_dir):
    """Box statistics of every second order's lines, a group each, and of all other lines as one hot group."""
    cells = [F.col(c).cast("double").alias(n) for c, n in MANY.items()]
    lines = table(spark, sf_dir, "lineitem").select(F.expr(MANY_KEY).cast("bigint").alias("k"), *cells)
    return rounded(box_stats(lines, list(MANY.values()), "k"), "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "l7_histogram",
    f"""WITH s AS (SELECT MIN(o_totalprice) AS lo, (MAX(o_totalprice) - MIN(o_totalprice)) / 50 AS w FROM orders),
       b AS (SELECT LEAST(CAST(FLOOR((o_totalprice - lo) / w) AS INTEGER), 49) AS bin, COUNT(*) AS n FROM orders, s GROUP BY 1)
       SELECT CAST(g AS INTEGER) AS bin, {r6_sql('lo + g * w')} AS bin_low, {r6_sql('lo + (g + 1) * w')} AS bin_high,
         COALESCE(n, 0) AS rows FROM (SELECT UNNEST(range(50)) AS g) CROSS JOIN s LEFT JOIN b ON bin = g""",
)
def bins(spark, sf_dir):
    return rounded(histogram(table(spark, sf_dir, "orders"), "o_totalprice", 50), "bin_low", "bin_high")


@query(
    "l8_density",
    f"""WITH s AS (SELECT COUNT(*) AS n, MIN(x) AS lo, MAX(x) AS hi, STDDEV_SAMP(x) * POWER(COUNT(*), -0.2) AS h FROM v),
       g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 49 AS x, n, h FROM s, (SELECT UNNEST(range(50)) AS i))
       SELECT point, {r6_sql('g.x')} AS x, {r6_sql('SUM(EXP(-0.5 * POWER((v.x - g.x) / h, 2))) / ANY_VALUE(n * h * SQRT(2 * PI()))')} AS density
       FROM g, v GROUP BY point, g.x""".replace("WITH s", "WITH v AS (SELECT c_acctbal / 1e3 AS x FROM customer), s"),
)
def density(spark, sf_dir):
    df = table(spark, sf_dir, "customer").selectExpr("c_acctbal / 1e3 AS x")
    return rounded(kernel_density(df, "x", 50), "x", "density")


def _rho(a: str, b: str) -> str:
    rank = "RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2e0"
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, {r6_sql('CORR(x, y)')} AS rho FROM
  (SELECT {rank.format(c=a)} AS x, {rank.format(c=b)} AS y FROM features WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query(
    "l9_spearman",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        _rho(a, b) for i, a in enumerate(['qty', 'avg_disc', 'max_tax', 'c_acctbal']) for b in ['qty', 'avg_disc', 'max_tax', 'c_acctbal'][:i])}""",
)
def rank_correlation(spark, sf_dir):
    """Columns with ties, hot values and missing cells."""
    return rounded(spearman(features(spark, sf_dir), ["qty", "avg_disc", "max_tax", "c_acctbal"]), "rho")


@query(
    "l9_spearman_repeated_rows",
    f"""WITH {FEATURES_SQL.replace("features AS (", "once AS (")}, features AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE qty > 100)
       {" UNION ALL ".join(_rho(a, b) for a, b in [('avg_disc', 'qty'), ('max_tax', 'qty'), ('max_tax', 'avg_disc')])}""",
)
def rank_correlation_of_copies(spark, sf_dir):
    """Some rows twice, so that no column names a row."""
    df = features(spark, sf_dir)
    return rounded(spearman(df.unionByName(df.where("qty > 100")), ["qty", "avg_disc", "max_tax"]), "rho")


@query(
    "l10_categorical_summary",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(DISTINCT {c}) AS unique_values, COUNT(*) - COUNT({c}) AS nulls, "
        f"{r6_sql(f'(COUNT(*) - COUNT({c})) * 1e2 / COUNT(*)')} AS null_pct FROM features"
        for c in ('types', 'c_mktsegment', 'n_name', 'o_orderpriority'))}""",
)
def categorical(spark, sf_dir):
    return rounded(categorical_summary(features(spark, sf_dir)), "null_pct")


@query(
    "l10_distinct_samples",
    """SELECT 'n_name' AS column, (SELECT COUNT(DISTINCT n_name) FROM nation JOIN customer ON c_nationkey = n_nationkey) AS unique_values,
         value FROM (SELECT DISTINCT n_name AS value FROM nation JOIN customer ON c_nationkey = n_nationkey ORDER BY 1 LIMIT 5)
       UNION ALL SELECT 'c_mktsegment', (SELECT COUNT(DISTINCT c_mktsegment) FROM customer), value
       FROM (SELECT DISTINCT c_mktsegment AS value FROM customer ORDER BY 1 LIMIT 10)""",
)
def samples(spark, sf_dir):
    """Many distinct values show five of them, few show all."""
    nation = table(spark, sf_dir, "nation")
    df = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return distinct_samples(df, "n_name").unionByName(distinct_samples(df, "c_mktsegment"))


def _per_class(c: str) -> str:
    return f"COUNT(*) FILTER (WHERE o_orderpriority = '{c}') AS \"n_{c}\""


@query(
    "l11_top_categories",
    f"""WITH {FEATURES_SQL}, top AS (SELECT n_name, COUNT(*) AS total FROM features GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)
       SELECT n_name AS category, {", ".join(_per_class(c) for c in PRIORITIES)}, ANY_VALUE(total) AS total
       FROM features JOIN top USING (n_name) GROUP BY 1""",
)
def top_categories(spark, sf_dir):
    df = features(spark, sf_dir).select("n_name", "o_orderpriority")
    return top_categories_by_class(df, "n_name", "o_orderpriority", PRIORITIES, 20)


@query(
    "l12_describe",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT({c}) AS count, {r6_sql(f'AVG({c})')} AS mean, {r6_sql(f'STDDEV_SAMP({c})')} AS std, "
        f"{r6_sql(f'MIN({c})')} AS min, {r6_sql(f'QUANTILE_CONT({c}, 0.25)')} AS q1, {r6_sql(f'MEDIAN({c})')} AS median, "
        f"{r6_sql(f'QUANTILE_CONT({c}, 0.75)')} AS q3, {r6_sql(f'MAX({c})')} AS max FROM features" for c in PLAIN)}""",
)
def description(spark, sf_dir):
    df = stage(features(spark, sf_dir).select(*PLAIN))
    return rounded(describe(df, PLAIN), "mean", "std", "min", "q1", "median", "q3", "max")


@query(
    "l13_info",
    f"""WITH {FEATURES_SQL} {" UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column, COUNT({c}) AS non_null, '{t}' AS dtype FROM features"
        for i, (c, t) in enumerate(INFO.items()))}""",
)
def info(spark, sf_dir):
    return column_info(features(spark, sf_dir).select(*INFO))


@query("l14_head", f"WITH {FEATURES_SQL} SELECT code, n_name, types FROM features ORDER BY code LIMIT 5")
def first_rows(spark, sf_dir):
    return head(features(spark, sf_dir), "code", ["code", "n_name", "types"])


@query(
    "l17_flag_distribution",
    f"""WITH {FEATURES_SQL}, f AS (SELECT CASE WHEN avg_qty > 25 THEN 1 ELSE 0 END AS large,
         CASE WHEN c_acctbal > 1000000 THEN 1 ELSE 0 END AS never FROM features)
       {" UNION ALL ".join(f"SELECT '{n}' AS flag, {v} AS value, COUNT(*) FILTER (WHERE {n} = {v}) AS rows FROM f"
                           for n in ('large', 'never') for v in (0, 1))}""",
)
def flag_counts(spark, sf_dir):
    df = features(spark, sf_dir).selectExpr(
        "CASE WHEN avg_qty > 25 THEN 1 ELSE 0 END AS large", "CASE WHEN c_acctbal > 1000000 THEN 1 ELSE 0 END AS never"
    )
    return flag_distribution(df, ["large", "never"])


@query("l18_value_counts", f"WITH {FEATURES_SQL} SELECT types AS value, COUNT(*) AS rows FROM features WHERE types IS NOT NULL GROUP BY 1")
def frequencies(spark, sf_dir):
    return value_counts(features(spark, sf_dir), "types")


@query(
    "l20_stage_summary",
    f"""WITH {FEATURES_SQL}, n AS (SELECT COUNT(*) AS a, COUNT(qty) AS b,
         COUNT(*) FILTER (WHERE qty IS NOT NULL AND c_acctbal BETWEEN 0 AND 9000) AS c FROM features)
       SELECT -1 AS position, 'input' AS stage, a AS rows, CAST(0 AS BIGINT) AS removed, 0e0 AS removed_total_pct FROM n
       UNION ALL SELECT 0, 'labelled', b, a - b, {r6_sql('(a - b) * 1e2 / a')} FROM n
       UNION ALL SELECT 1, 'in range', c, b - c, {r6_sql('(a - c) * 1e2 / a')} FROM n""",
)
def stage_summary(spark, sf_dir):
    stages = {"labelled": F.col("qty").isNotNull(), "in range": in_ranges({"c_acctbal": (0, 9000)})}
    return rounded(stage_counts(features(spark, sf_dir), stages), "removed_total_pct")
