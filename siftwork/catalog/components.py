"""Principal components. Two columns have a closed form in SQL; more do not."""

from __future__ import annotations


from siftwork.catalog.base import (
    FEATURES_SQL,

    PRIORITIES,
    features,
    graded,
    query,
    r6_sql,
    rounded,
)
from siftwork.operators.reduce import FeatureReducer, component_info, plane, variance_table
from siftwork.operators.scale import FeatureScaler
from siftwork.sources.shared import stage

# In units of a thousand, so that both columns matter and six places mean something.
PAIR_SQL = f"""{FEATURES_SQL}, src AS (SELECT code, o_orderpriority, c_acctbal / 1e3 AS x,
  (o_totalprice + 5 * c_acctbal) / 1e5 AS y FROM features),
cov AS (SELECT AVG(x) AS mx, AVG(y) AS my, VAR_SAMP(x) AS a, VAR_SAMP(y) AS d, COVAR_SAMP(x, y) AS b FROM src),
eig AS (SELECT *, (a + d) / 2 + SQRT(POWER((a - d) / 2, 2) + b * b) AS l1,
  (a + d) / 2 - SQRT(POWER((a - d) / 2, 2) + b * b) AS l2 FROM cov),
raw1 AS (SELECT *, b / SQRT(b * b + POWER(l1 - a, 2)) AS u, (l1 - a) / SQRT(b * b + POWER(l1 - a, 2)) AS w FROM eig),
vec AS (SELECT *, CASE WHEN ABS(u) >= ABS(w) THEN SIGN(u) ELSE SIGN(w) END AS s1,
  CASE WHEN ABS(w) >= ABS(u) THEN SIGN(-w) ELSE SIGN(u) END AS s2 FROM raw1)"""
FIVE = ["qty", "avg_price", "avg_disc", "c_acctbal", "o_totalprice"]


def pair_input(spark, sf_dir):
    return features(spark, sf_dir).selectExpr(
        "code", "o_orderpriority", "c_acctbal / 1e3 AS x", "(o_totalprice + 5 * c_acctbal) / 1e5 AS y"
    )


def five_scaled(spark, sf_dir):
    df = stage(graded(spark, sf_dir).select("code", "grade", *FIVE))
    return FeatureScaler("standard", exclude=["code"]).fit(df).transform(df)


@query("i1_pca_threshold")
def pca_threshold(spark, sf_dir):
    """Fewest components that reach the threshold, on five scaled columns."""
    df = five_scaled(spark, sf_dir)
    model = FeatureReducer(0.75, metadata=["code", "grade"]).fit(df)
    return rounded(variance_table(spark, model), "explained", "cumulative")


@query(
    "i1_pca_threshold_pair",
    f"""WITH {PAIR_SQL} SELECT 1 AS component, {r6_sql("l1 / (l1 + l2)")} AS explained, {r6_sql("l1 / (l1 + l2)")} AS cumulative
       FROM eig UNION ALL SELECT 2, {r6_sql("l2 / (l1 + l2)")}, {r6_sql("1e0")} FROM eig WHERE l1 / (l1 + l2) < 0.6""",
)
def pca_threshold_pair(spark, sf_dir):
    """The same choice on two columns, where SQL can follow."""
    model = FeatureReducer(0.6, metadata=["code", "o_orderpriority"]).fit(stage(pair_input(spark, sf_dir)))
    return rounded(variance_table(spark, model), "explained", "cumulative")


@query(
    "i2_pca_fixed_pair",
    f"""WITH {PAIR_SQL} SELECT 1 AS feature, 1 AS component, {r6_sql("s1 * u")} AS loading FROM vec
       UNION ALL SELECT 2, 1, {r6_sql("s1 * w")} FROM vec""",
)
def pca_fixed_pair(spark, sf_dir):
    """Loadings of a single component of two columns."""
    model = FeatureReducer(n_components=1, metadata=["code", "o_orderpriority"]).fit(stage(pair_input(spark, sf_dir)))
    rows = [(i + 1, 1, float(r[0])) for i, r in enumerate(component_info(model)["loadings"])]
    return rounded(spark.createDataFrame(rows, "feature int, component int, loading double"), "loading")


@query("i2_pca_fixed")
def pca_fixed(spark, sf_dir):
    """A fixed number of components, capped by the number of columns."""
    df = five_scaled(spark, sf_dir)
    model = FeatureReducer(n_components=9, metadata=["code", "grade"]).fit(df)
    rows = [(i + 1, j + 1, float(x)) for i, r in enumerate(component_info(model)["loadings"]) for j, x in enumerate(r)]
    return rounded(spark.createDataFrame(rows, "feature int, component int, loading double"), "loading")


@query(
    "i3_pca_project",
    f"""WITH {PAIR_SQL} SELECT code, o_orderpriority, {r6_sql("s1 * (u * (x - mx) + w * (y - my))")} AS PC1,
       {r6_sql("s2 * (-w * (x - mx) + u * (y - my))")} AS PC2 FROM src, vec""",
)
def pca_project(spark, sf_dir):
    df = stage(pair_input(spark, sf_dir))
    model = FeatureReducer(1.0, metadata=["code", "o_orderpriority"]).fit(df)
    return rounded(model.transform(df), "PC1", "PC2")


@query(
    "i4_explained_variance",
    f"""WITH {PAIR_SQL} SELECT 1 AS component, {r6_sql("l1 / (l1 + l2)")} AS explained, {r6_sql("l1 / (l1 + l2)")} AS cumulative FROM eig
       UNION ALL SELECT 2, {r6_sql("l2 / (l1 + l2)")}, {r6_sql("1e0")} FROM eig""",
)
def explained_variance(spark, sf_dir):
    model = FeatureReducer(1.0, metadata=["code", "o_orderpriority"]).fit(stage(pair_input(spark, sf_dir)))
    return rounded(variance_table(spark, model), "explained", "cumulative")


@query(
    "l21_plane",
    f"""WITH {PAIR_SQL} SELECT {r6_sql("s1 * (u * (x - mx) + w * (y - my))")} AS PC1,
       {r6_sql("s2 * (-w * (x - mx) + u * (y - my))")} AS PC2,
       CAST(list_position({PRIORITIES!r}, o_orderpriority) - 1 AS INTEGER) AS class_code FROM src, vec""",
)
def projected_plane(spark, sf_dir):
    return plane(pca_project(spark, sf_dir), "o_orderpriority", PRIORITIES)


